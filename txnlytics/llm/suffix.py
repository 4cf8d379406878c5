"""Removal of long repeated strings: suffixes at content-chosen places, sorted by a common-prefix-aware merge sort."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from txnlytics.llm.common import mix, slices
from txnlytics.session import discard, materialise


def _stored(df: DataFrame, label: str) -> DataFrame:
    """A table of texts, written once in the session's shared folder."""
    return materialise(df, label, compression="zstd")


@dataclass(frozen=True)
class Repeats:
    """Strings of ``length`` bytes count; places are chosen by the smallest hash among the ``gram``-byte strings in them."""

    length: int = 400
    gram: int = 64
    slice_bytes: int = 16 << 20
    part_items: int = 40_000
    run_items: int = 30_000
    bucket_places: int = 2_000_000
    broadcast_places: int = 4_000_000


# --- places ---------------------------------------------------------------------------

_BYTE = np.random.Generator(np.random.PCG64(7_031_999)).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_BLOCK = 1 << 20


def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes from each position on (a power of two), by doubling."""
    h, width = _BYTE[raw], 1
    while width < gram:
        h = h[:-width] * np.uint64(pow(_BASE, width, 1 << 64)) + h[width:]
        width *= 2
    return mix(h)


def places(texts: list[bytes], rules: Repeats) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, position, gram hash) of the chosen places.

    Every string of ``length`` bytes chooses its gram of smallest hash, the leftmost if
    several tie. Equal strings choose alike, so strings that repeat are found at places
    whose grams repeat. About one place per length / 2 bytes results, in any text.
    """
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    starts = ends - [len(t) for t in texts]
    raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
    width = rules.length - rules.gram + 1
    position, key = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    low = np.uint64((1 << 24) - 1)
    for begin in range(0, len(raw) - rules.length + 1, _BLOCK):
        part = raw[begin : begin + _BLOCK + rules.length - 1]
        h = gram_hashes(part, rules.gram)
        least = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        span = 1
        while 2 * span <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
        begins = begin + np.arange(len(least))
        text = np.searchsorted(ends, begins, side="right")
        inside = (text < len(ends)) & (begins + rules.length <= ends[np.minimum(text, len(ends) - 1)])
        at = np.unique((least[inside] & low).astype(np.int64))
        position.append(begin + at)
        key.append(h[at])
    where = np.concatenate(position)
    where, first = np.unique(where, return_index=True)
    text = np.searchsorted(ends, where, side="right")
    return text, where - starts[text], np.concatenate(key)[first]


def _repeated_places(docs: DataFrame, rules: Repeats) -> tuple[DataFrame, DataFrame]:
    """(row, pos) of the places whose gram occurs at least twice, and the table behind them.

    A slice settles the grams that repeat within it and reports each gram once, so a gram
    that most documents share costs its bucket one entry per slice.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0))).first()[0]
    buckets = int(max(8, size // (rules.length // 2) // rules.bucket_places + 1))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "row", "pos", "keys", "rows", "places"]
        for batch in batches:
            bodies, numbers = batch.column("body").to_pylist(), batch.column("row").to_numpy()
            for begin, end in slices(bodies, rules.slice_bytes):
                text, pos, key = places(bodies[begin:end], rules)
                row = numbers[begin:end][text]
                order = np.argsort(key, kind="stable")
                key, row, pos = key[order], row[order], pos[order]
                new = np.ones(len(key), dtype=bool)
                new[1:] = key[1:] != key[:-1]
                first = np.flatnonzero(new)
                times = np.diff(np.append(first, len(key)))
                often = np.repeat(times > 1, times)
                if often.any():
                    n = int(often.sum())
                    blank = pa.nulls(n, pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, -1, np.int32)), pa.array(row[often]), pa.array(pos[often]), blank, blank, blank], names
                    )
                row = np.where(times > 1, -1, row[first])
                key, pos = key[first], pos[first].astype(np.int32)
                bucket = (key % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
                filled = [b for b in range(buckets) if edges[b] < edges[b + 1]]
                cut = lambda x: pa.array([x[order[edges[b] : edges[b + 1]]].tobytes() for b in filled], pa.binary())
                blank = pa.nulls(len(filled), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(filled, pa.int32()), blank, blank, cut(key), cut(row), cut(pos)], names)

    def meet(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        keys = np.frombuffer(b"".join(rows["keys"]), dtype=np.uint64)
        row = np.frombuffer(b"".join(rows["rows"]), dtype=np.int64)
        pos = np.frombuffer(b"".join(rows["places"]), dtype=np.int32)
        _, code, times = np.unique(keys, return_inverse=True, return_counts=True)
        use = (times[code] > 1) & (row >= 0)
        return pd.DataFrame({"row": row[use], "pos": pos[use].astype(np.int64)})

    scanned = materialise(
        docs.select("row", "body").mapInArrow(scan, "bucket int, row long, pos long, keys binary, rows binary, places binary"), "places"
    )
    met = scanned.filter("bucket >= 0").groupBy("bucket").applyInPandas(meet, "row long, pos long")
    return scanned.filter("bucket < 0").select("row", "pos").unionByName(met), scanned


# --- items: a place with the bytes before and after it --------------------------------------


def _side(rows: DataFrame, numbers: int, rules: Repeats) -> DataFrame:
    """A join side to broadcast if the measured numbers are few; else it is shuffled."""
    return F.broadcast(rows) if numbers <= rules.broadcast_places else rows


def _by_row(docs: DataFrame, rows: DataFrame, numbers: int, rules: Repeats, how: str) -> DataFrame:
    """Join documents with (row, array) rows: broadcast if the measured numbers are few, else by shuffling both."""
    return docs.join(_side(rows, numbers, rules), "row", how)


def _items(docs: DataFrame, found: DataFrame, rules: Repeats) -> tuple[DataFrame, DataFrame]:
    """Rows (row, pos, key, after, before, copies) and, for places with equal surroundings in a slice, (row, pos, rep_row, rep_pos).

    ``after`` holds up to ``length`` bytes from the place on, ``before`` those before it, in
    reverse. Places of one slice with equal surroundings become one item with ``copies``. The
    second result is the table of places behind the rows.
    """
    listed = materialise(found.groupBy("row").agg(F.collect_list("pos").alias("list")), "listed")
    numbers = listed.agg(F.coalesce(F.sum(F.size("list") + 4), F.lit(0))).first()[0]
    names = ["row", "pos", "rep_row", "rep_pos", "after", "before", "copies"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, bodies, lists = (batch.column(c).to_pylist() for c in ("row", "body", "list"))
            for begin, end in slices(bodies, rules.slice_bytes):
                seen: dict[tuple[bytes, bytes], list] = {}
                copies = []
                for row, body, positions in zip(rows[begin:end], bodies[begin:end], lists[begin:end]):
                    for pos in sorted(positions):
                        around = (body[pos : pos + rules.length], body[max(0, pos - rules.length) : pos][::-1])
                        known = seen.setdefault(around, [row, pos, 0])
                        known[2] += 1
                        if known[2] > 1:
                            copies.append((row, pos, known[0], known[1]))
                items = [(r, p, r, p, a, b, n) for (a, b), (r, p, n) in seen.items()] + [(*c, None, None, 0) for c in copies]
                kinds = [pa.int64()] * 4 + [pa.binary(), pa.binary(), pa.int32()]
                for at in range(0, len(items), 10_000):
                    columns = list(zip(*items[at : at + 10_000]))
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    joined = _by_row(docs.select("row", "body"), listed, numbers, rules, "inner").select("row", "body", "list")
    items = joined.mapInArrow(
        cut, "row long, pos long, rep_row long, rep_pos long, after binary, before binary, copies int"
    )
    return items, listed


# --- the merge sort -------------------------------------------------------------------------


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes are known to agree."""
    most = min(len(a), len(b))
    if a[known:most] == b[known:most]:
        return most
    while a[known : known + 16] == b[known : known + 16]:
        known += 16
    differ = int.from_bytes(a[known : known + 16].ljust(16, b"\0"), "big") ^ int.from_bytes(b[known : known + 16].ljust(16, b"\0"), "big")
    return min(most, known + (128 - differ.bit_length()) // 8)


def front_code(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """(shared with the one before, further bytes, those bytes joined) of sorted keys."""
    shared, rest, last = [], [], b""
    for key in keys:
        n = common_prefix(last, key)
        shared.append(n)
        rest.append(key[n:])
        last = key
    return np.array(shared, dtype=np.uint16), np.array([len(r) for r in rest], dtype=np.uint16), b"".join(rest)


def front_decode(shared: np.ndarray, length: np.ndarray, joined: bytes) -> Iterator[tuple[bytes, int]]:
    """(key, bytes shared with the key before it), one by one."""
    last, at = b"", 0
    for n, m in zip(shared.tolist(), length.tolist()):
        last = last[:n] + joined[at : at + m]
        at += m
        yield last, n


def merge_runs(runs: list[Iterator[tuple[bytes, int, tuple]]]) -> Iterator[tuple[bytes, int, tuple]]:
    """Merge sorted runs of (key, shared with its predecessor in the run, payload); the second is then that of the merged order.

    A loser tree whose entries carry the length of the prefix they share with the last
    winner. Of two entries the one sharing more comes first, without looking at a byte; only
    equal lengths are compared, from there on. Ties go by the payload's first element.
    """
    heads = [next(run, None) for run in runs]
    n = 1
    while n < len(runs):
        n *= 2
    heads += [None] * (n - len(heads))
    share = [0] * n
    losers = [-1] * n

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's share becomes that with the winner."""
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return (a, b) if y is None else (b, a)
        if share[a] != share[b]:
            return (a, b) if share[a] > share[b] else (b, a)
        k = common_prefix(x[0], y[0], share[a])
        if k == len(x[0]) == len(y[0]):
            first = x[2][0] <= y[2][0]
        else:
            first = k == len(x[0]) or (k < len(y[0]) and x[0][k] < y[0][k])
        winner, loser = (a, b) if first else (b, a)
        share[loser] = k
        return winner, loser

    best = list(range(n))
    level = n
    tree = [-1] * n + best
    while level > 1:
        for node in range(level // 2, level):
            tree[node], losers[node] = play(tree[2 * node], tree[2 * node + 1])
        level //= 2
    winner = tree[1]
    while heads[winner] is not None:
        key, _, payload = heads[winner]
        yield key, share[winner], payload
        heads[winner] = next(runs[winner], None)
        share[winner] = heads[winner][1] if heads[winner] is not None else 0
        node = (winner + n) // 2
        while node >= 1:
            winner, losers[node] = play(winner, losers[node])
            node //= 2


def neighbours(merged: Iterator[tuple[bytes, int, tuple]]) -> Iterator[tuple[tuple, int, int, bool]]:
    """(payload, own, other, again) of each item of a merged order: the best of its two neighbours by common prefix.

    Payloads are (other side, copies, ...). ``own`` is the common prefix of the keys,
    ``other`` that of the other sides; an item with copies has itself as a neighbour.
    ``again`` marks an item that equals the one before it on both sides.
    """
    waiting, best, again = None, (0, 0), False
    for key, shared, payload in merged:
        here, same = ((len(key), len(payload[0])) if payload[1] > 1 else (0, 0)), False
        if waiting is not None:
            pair = (shared, common_prefix(waiting[0], payload[0]))
            same = pair == (len(key), len(payload[0])) == (len(waiting[-1]), len(waiting[0]))
            yield waiting, *max(best, pair), again
            here = max(here, pair)
        waiting, best, again = payload, here, same
    if waiting is not None:
        yield waiting, *best, again


def _sorted_neighbours(items: DataFrame, rules: Repeats) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Items (row, pos, own, other, copies) in the order of (own, other).

    Returns (row, pos, a_own, a_other) with each item's best neighbour, the items
    themselves without those that repeat their predecessor on both sides, and the table behind both.

    Tasks sort their items into runs, cut them at sampled splitters and front-code the
    pieces; a task per range merges its pieces. The last item of a range and the first of
    the next are compared afterwards: every range but the first holds its splitter, so none
    of those is empty. Splitters are at most as many as ranges.
    """
    total = items.count()
    parts = total // rules.part_items + 1
    rows = items.select("row", "pos", "own", "other", "copies")
    sample = rows.select("own", "other").sample(min(1.0, 8 * parts / max(1, total)), seed=11).collect() if parts > 1 else []
    drawn = sorted({(bytes(r["own"]), bytes(r["other"])) for r in sample})
    step = max(1, -(-len(drawn) // parts))
    splitters = drawn[step::step]
    shared = items.sparkSession.sparkContext.broadcast(splitters)
    names = ["part", "shared", "length", "joined", "other", "other_length", "copies", "row", "pos"]

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from bisect import bisect_left

        bounds, squeeze = shared.value, zstandard.ZstdCompressor(level=1).compress

        def pieces(run: list[tuple]) -> pa.RecordBatch:
            run.sort()
            cuts = [0, *[bisect_left(run, s, key=lambda item: item[:2]) for s in bounds], len(run)]
            out = []
            for part, (a, b) in enumerate(zip(cuts, cuts[1:])):
                if a < b:
                    piece = run[a:b]
                    n, m, joined = front_code([x[0] for x in piece])
                    number = lambda k, kind: np.array([x[k] for x in piece], dtype=kind).tobytes()
                    out.append((
                        part, n.tobytes(), m.tobytes(), squeeze(joined), squeeze(b"".join(x[1] for x in piece)),
                        np.array([len(x[1]) for x in piece], dtype=np.uint16).tobytes(),
                        number(2, np.int32), number(3, np.int64), number(4, np.int64),
                    ))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if k == 0 else pa.binary()) for k, c in enumerate(zip(*out))], names
            )

        run: list[tuple] = []
        for batch in batches:  # long runs: fewer pieces to merge, and more shared bytes in each
            run.extend(zip(*(batch.column(c).to_pylist() for c in ("own", "other", "copies", "row", "pos"))))
            if len(run) >= rules.run_items:
                yield pieces(run)
                run = []
        if run:
            yield pieces(run)

    def merge(key: tuple, pieces: pd.DataFrame) -> pd.DataFrame:
        def unpack(piece) -> Iterator[tuple[bytes, int, tuple]]:
            number = lambda name, kind: np.frombuffer(piece[name], dtype=kind)
            lengths = number("other_length", np.uint16)
            ends = np.cumsum(lengths, dtype=np.int64).tolist()
            expand = zstandard.ZstdDecompressor().decompress
            whole, at = expand(piece["other"]), 0
            keys = front_decode(number("shared", np.uint16), number("length", np.uint16), expand(piece["joined"]))
            rest = zip(number("copies", np.int32).tolist(), number("row", np.int64).tolist(), number("pos", np.int64).tolist())
            for (text, n), end, (copies, row, pos) in zip(keys, ends, rest):
                yield text, n, (whole[at:end], copies, row, pos, text)
                at = end

        ordered = merge_runs([unpack(p) for p in pieces.to_dict("records")])
        out, first, last = [], None, None
        for payload, mine, others, again in neighbours(ordered):
            side, copies, row, pos, text = payload
            out.append((row, pos, mine, others, key[0], int(again), None if again else text, None if again else side, copies))
            first, last = first or payload, payload
        out += [(p[2], p[3], 0, 0, key[0], kind, p[4], p[0], p[1]) for kind, p in ((2, first), (3, last))]
        return pd.DataFrame(out, columns=["row", "pos", "a_own", "a_other", "part", "kind", "own", "other", "copies"])

    # kind 0: an item, 1: one that repeats its predecessor, 2 and 3: the ends of a range once more
    schema = "row long, pos long, a_own int, a_other int, part int, kind int, own binary, other binary, copies int"
    pieces = rows.mapInArrow(runs, ", ".join(f"{n} {'int' if n == 'part' else 'binary'}" for n in names))
    merged = _stored(pieces.groupBy("part").applyInPandas(merge, schema), "merged")

    def borders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for x in b.to_dict("records"):
                pair = common_prefix(x["own"], x["own2"]), common_prefix(x["other"], x["other2"])
                out += [(x["row"], x["pos"], *pair), (x["row2"], x["pos2"], *pair)]
            yield pd.DataFrame(out, columns=["row", "pos", "a_own", "a_other"])

    last = merged.filter("kind = 3").select("row", "pos", "own", "other", (F.col("part") + 1).alias("part"))
    first = merged.filter("kind = 2").select(
        F.col("row").alias("row2"), F.col("pos").alias("pos2"), F.col("own").alias("own2"), F.col("other").alias("other2"), "part"
    )
    across = last.join(first, "part").drop("part").mapInPandas(borders, "row long, pos long, a_own int, a_other int")
    found = merged.filter("kind < 2").select("row", "pos", "a_own", "a_other").unionByName(across)
    return found, merged.filter("kind = 0").select("row", "pos", "own", "other", "copies"), merged


#: Open lengths are matched in blocks of so many.
_STEP = 16


# --- what is covered --------------------------------------------------------------------------


def _reaches(items: DataFrame, rules: Repeats) -> DataFrame:
    """(row, pos, left, right) of items: the bytes before and after the place that repeated strings cover.

    A partner that shares l bytes before and r after the place repeats a string there if
    l + r reaches ``length``. All such ranges contain the place, so what matters is the
    largest r and the largest l among such partners. The neighbour in the order of the
    bytes after (before) has the largest r (l) there is. Where a known partner of that kind
    reaches it, that side is settled. Otherwise the strings that could reach further are
    counted: few items ask, and what they may meet is counted once for each way it differs.
    """
    after_sorted, left_over, first = _sorted_neighbours(items.select("row", "pos", F.col("after").alias("own"), F.col("before").alias("other"), "copies"), rules)
    swapped = left_over.select("row", "pos", F.col("other").alias("own"), F.col("own").alias("other"), "copies")
    before_sorted, _, second = _sorted_neighbours(swapped, rules)
    both = after_sorted.withColumn("side", F.lit(0)).unionByName(before_sorted.withColumn("side", F.lit(1)))
    pair = F.struct("a_own", "a_other")
    best = both.groupBy("row", "pos").agg(
        F.max(F.when(F.col("side") == 0, pair)).alias("a"), F.max(F.when(F.col("side") == 1, pair)).alias("b")
    )
    whole = rules.length
    # Of items that repeat each other on both sides only one is in the second order; the first has told all of them.
    most_right, most_left = F.col("a.a_own"), F.greatest("b.a_own", "a.a_other")
    by_right = most_right + F.col("a.a_other") >= whole
    by_left = F.coalesce(F.col("b.a_own") + F.col("b.a_other") >= whole, F.lit(False))
    left = F.greatest(F.when(by_right, F.col("a.a_other")), F.when(by_left, F.col("b.a_own")))
    right = F.greatest(F.when(by_right, most_right), F.when(by_left, F.col("b.a_other")))
    best = materialise(
        best.filter(most_right + most_left >= whole).select(
            "row", "pos", most_left.alias("most_left"), most_right.alias("most_right"), left.alias("left"), right.alias("right")
        ),
        "best",
    )
    discard(first, second)
    sure = best.filter(F.col("left").isNotNull()).select("row", "pos", "left", "right")
    # Lengths before the place that are still open: beyond the known left, or so short that the right would reach further.
    top = F.least("most_left", F.lit(whole - rules.gram))
    bottom = F.greatest(F.lit(whole) - F.col("most_right"), F.lit(0))
    open_ = best.select(
        "row", "pos",
        F.coalesce(F.col("left") + 1, bottom).alias("low"), top.alias("high"),
        bottom.alias("low2"), F.coalesce(F.lit(whole - 1) - F.col("right"), F.lit(-1)).alias("high2"),
    ).filter("low <= high or low2 <= high2")
    open_ = materialise(open_, "open")
    if open_.isEmpty():
        return sure
    gram = F.xxhash64(F.substring("after", 1, rules.gram))
    named = items.select("row", "pos", gram.alias("gram"))
    # Lengths are asked for in blocks. A partner that settles a length of block [u, v] shares
    # the u bytes before the place and the length - v after it, so places are first matched
    # by the names of those strings; the bytes beyond them then tell the lengths apart.
    block = lambda lo, hi: F.when(F.col(lo) <= F.col(hi), F.sequence(F.expr(f"{lo} div {_STEP}"), F.expr(f"{hi} div {_STEP}"))).otherwise(
        F.array().cast("array<bigint>")
    )
    asking = open_.select("row", "pos", F.array_union(block("low", "high"), block("low2", "high2")).cast("array<int>").alias("own"))
    asked = named.join(asking, ["row", "pos"]).select("gram", F.explode("own").alias("k")).distinct()
    asked = materialise(asked.groupBy("gram").agg(F.collect_set("k").alias("asked")), "asked")  # a bounded number of blocks a gram
    # The texts stay where they are: what is asked of a gram is small and comes to them.
    texts = items.withColumn("gram", gram).join(_side(asked, asked.count() * 12, rules), "gram")
    texts = texts.select("row", "pos", "copies", "after", "before", "asked")
    names = ["row", "pos", "copies", "k", "name", "back", "front"]
    most = whole - rules.gram

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        for batch in batches:
            out = []
            for x in batch.to_pylist():
                before, after = x["before"], x["after"]
                for k in x["asked"]:
                    u, v = k * _STEP, min(k * _STEP + _STEP - 1, most)
                    if len(before) >= u and len(after) >= whole - v:
                        name = hashlib.blake2b(before[:u] + b"|" + after[: whole - v], digest_size=16).digest()
                        out.append((x["row"], x["pos"], x["copies"], k, name, before[u:v], after[whole - v : whole - u]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    met = texts.mapInArrow(blocks, "row long, pos long, copies int, k int, name binary, back binary, front binary")
    met = materialise(met, "blocks", compression="zstd")
    asks = open_.select("row", "pos", "low", "high", "low2", "high2").join(
        asking.select("row", "pos", F.explode("own").alias("k")), ["row", "pos"]
    )
    asks = materialise(asks, "asks")
    askers = materialise(met.drop("copies").join(_side(asks, asks.count() * 7, rules), ["row", "pos", "k"]), "askers")
    # Within a block only the few bytes beyond its name tell places apart: those with equal ones become one with a
    # count before any length is looked at, so a large group of near copies costs one row for each way they differ there.
    live = materialise(askers.select("k", "name").distinct(), "live")
    alive = met.join(_side(live, live.count() * 3, rules), ["k", "name"], "left_semi")
    contexts = alive.groupBy("k", "name", "back", "front").agg(F.sum("copies").alias("n"))
    u, v = F.col("k") * _STEP, F.least(F.col("k") * _STEP + _STEP - 1, F.lit(most))

    def spelled(rows: DataFrame, *columns: str) -> DataFrame:
        """A row per length of the block that the row's bytes reach, with those that stand beyond the block's name."""
        each = rows.select("name", "back", "front", *columns, u.alias("u"), v.alias("v"), F.explode(F.sequence(u, v)).alias("d"))
        reached = each.filter("octet_length(back) >= d - u and octet_length(front) >= v - d")
        return reached.select("name", "d", F.expr("concat(substring(back, 1, d - u), substring(front, 1, v - d))").alias("rest"), *columns)

    # One length before the place: places that agree there are different starts of the same string.
    often = spelled(contexts, "n").groupBy("name", "d", "rest").agg(F.sum("n").alias("n")).filter("n > 1").drop("n")
    wanted = spelled(askers, "row", "pos", "low", "high", "low2", "high2").filter("d between low and high or d between low2 and high2")
    exact = wanted.join(often, ["name", "d", "rest"], "left_semi").groupBy("row", "pos").agg(
        F.max("d").alias("left"), (F.lit(whole) - F.min("d")).alias("right")
    )
    return sure.unionByName(exact).groupBy("row", "pos").agg(F.max("left").alias("left"), F.max("right").alias("right"))


def repeated_spans(docs: DataFrame, rules: Repeats = Repeats()) -> DataFrame:
    """(row, spans): the sorted, disjoint, maximal [start, end) byte ranges of (row, body) documents that repeat.

    ``row`` is unique and not null, ``body`` the bytes, not null. Only documents with a
    repeated string have a row.
    """
    found, scanned = _repeated_places(docs, rules)
    items, listed = _items(docs, found, rules)
    items = _stored(items, "items")
    discard(scanned, listed)
    leads = items.filter("copies > 0").select("row", "pos", "after", "before", "copies")
    reaches = materialise(_reaches(leads, rules), "reaches")
    known = items.filter("copies = 0").select("row", "pos", "rep_row", "rep_pos")
    copies = known.join(
        reaches.select(F.col("row").alias("rep_row"), F.col("pos").alias("rep_pos"), "left", "right"), ["rep_row", "rep_pos"]
    ).select("row", "pos", "left", "right")
    spans = reaches.select("row", "pos", "left", "right").unionByName(copies)
    spans = spans.select("row", (F.col("pos") - F.col("left")).alias("start"), (F.col("pos") + F.col("right")).alias("end"))
    listed = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("s"))
    merged = F.aggregate(
        F.slice("s", 2, 1 << 30),
        F.slice("s", 1, 1),
        lambda done, x: F.when(
            x["start"] <= F.element_at(done, -1)["end"],
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], x["end"]).alias("end"))),
            ),
        ).otherwise(F.concat(done, F.array(x))),
    )
    return listed.select("row", merged.alias("spans"))


def remove_repeats(
    df: DataFrame, rules: Repeats = Repeats(), key: str = "doc_id", text: str = "text", with_bytes: bool = False
) -> DataFrame:
    """One row per row of ``df``: key, n_bytes, n_removed, n_spans, kept_sha256, spans (and the kept bytes on demand).

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere else,
    in another row or in the same one, overlaps included; strings are those of the input and
    never cross rows. Null texts are empty. Repeated rows repeat each other, so they lose
    all of their bytes if they have ``length`` at least. Keys are not looked at and may be
    null; other columns are not read; an empty table gives an empty table.
    """
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    docs = _stored(df.select(F.col(key).alias("key"), body.alias("body"), F.monotonically_increasing_id().alias("row")), "texts")
    spans = materialise(repeated_spans(docs, rules), "spans")
    numbers = spans.agg(F.coalesce(F.sum(2 * F.size("spans") + 4), F.lit(0))).first()[0]
    joined = _by_row(docs, spans, numbers, rules, "left")
    kind = df.schema[key].dataType.simpleString()
    names = ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"] + ["kept"] * with_bytes

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for data, found in zip(batch.column("body").to_pylist(), batch.column("spans").to_pylist()):
                found = [(x["start"], x["end"]) for x in found or ()]
                kept = data
                if found:
                    edges = [0, *[n for pair in found for n in pair], len(data)]
                    kept = b"".join(data[a:b] for a, b in zip(edges[0::2], edges[1::2]))
                spans = [{"start": a, "end": b} for a, b in found]
                out.append((len(data), len(data) - len(kept), len(found), hashlib.sha256(kept).hexdigest(), spans) + (kept,) * with_bytes)
            kinds = [pa.int64()] * 3 + [pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))] + [pa.binary()] * with_bytes
            columns = [[row[k] for row in out] for k in range(len(kinds))]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names)

    schema = f"key {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>"
    done = joined.select("key", "body", "spans").mapInArrow(remove, schema + ", kept binary" * with_bytes)
    return done.withColumnRenamed("key", key)
