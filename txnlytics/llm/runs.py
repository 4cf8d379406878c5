"""Periodic runs of words: suffix classes united by decreasing common prefix (Kruskal's order) over ordered position sets."""

from __future__ import annotations

from bisect import bisect
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from txnlytics.llm.common import mix, renamed_free, slices

RUN_TYPE = "array<struct<start: bigint, length: bigint, period: bigint>>"
_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


@dataclass(frozen=True)
class Runs:
    """A run has at least ``min_words`` words and ``exponent`` times its period; ``slice_bytes`` of text are worked on at once."""

    min_words: int = 6
    exponent: int = 4
    slice_bytes: int = 4 << 20

    def __post_init__(self) -> None:
        if self.exponent < 2:
            raise ValueError("a run repeats its period at least twice")

    @property
    def window(self) -> int:
        """Words that a run's start surely has in common with the place one period on."""
        return min(max(self.min_words - q, (self.exponent - 1) * q) for q in range(1, max(self.min_words, 1) + 1))


# --- one slice of texts ---------------------------------------------------------------


def _repeated(words: np.ndarray, owner: np.ndarray, window: int) -> np.ndarray:
    """Places whose next ``window`` words also start elsewhere in the same text (and perhaps a few more)."""
    m = len(words) - window + 1
    if m < 2:
        return np.zeros(0, dtype=np.int64)
    value = mix(words.astype(np.uint64) + np.uint64(1))
    key = mix(owner[:m].astype(np.uint64) + np.uint64(1 << 40))
    for t in range(window):
        key = key + value[t : m + t] * np.uint64(2 * t + 3) * np.uint64(0x9E3779B97F4A7C15)
    key = mix(key)
    inside = np.flatnonzero(owner[:m] == owner[window - 1 :])
    ordered = np.sort(key[inside])
    again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(again):
        return np.zeros(0, dtype=np.int64)
    at = np.minimum(np.searchsorted(again, key[inside]), len(again) - 1)
    return inside[again[at] == key[inside]]


def _suffix_order(symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of all suffixes and the common prefix of neighbours in it, by rank doubling; the last symbol is unique."""
    n = len(symbol)
    rank = np.unique(symbol, return_inverse=True)[1].astype(np.int64)
    levels, width = [rank.astype(np.int32)], 1
    while rank.max() < n - 1:
        behind = np.zeros(n, dtype=np.int64)
        behind[: n - width] = rank[width:] + 1
        rank = np.unique(rank * (n + 1) + behind, return_inverse=True)[1].astype(np.int64)
        levels.append(rank.astype(np.int32))
        width *= 2
    order = np.empty(n, dtype=np.int64)
    order[rank] = np.arange(n)
    left, right = order[:-1], order[1:]
    common = np.zeros(n - 1, dtype=np.int64)
    for k in reversed(range(len(levels))):
        same = levels[k][np.minimum(left + common, n - 1)] == levels[k][np.minimum(right + common, n - 1)]
        common += same.astype(np.int64) << k
    return order, common


def find_runs(words: np.ndarray, owner: np.ndarray, rules: Runs) -> Iterator[tuple[int, int, int]]:
    """(place of the first word, length, period) of every run in numbered words; ``owner`` tells texts apart.

    Only stretches that hold a repeated window are ordered, with a symbol of its own between
    any two, so common prefixes of ``window`` words or more are those of the whole text. Pairs
    of neighbours in suffix order unite classes, longest common prefix first. A class keeps
    its places in order, the smaller class is put into the larger. Places that become
    neighbours at a distance d with a common prefix l >= (exponent - 1) * d start a stretch of
    d + l words with smallest period d (a smaller one would have put a place between them);
    it is a run if it can't be extended to the left.
    """
    start = _repeated(words, owner, rules.window)
    if not len(start):
        return
    covered = np.zeros(len(words) + 1, dtype=np.int32)
    np.add.at(covered, start, 1)
    np.add.at(covered, start + rules.window, -1)
    place = np.flatnonzero(np.cumsum(covered)[:-1] > 0)
    fresh = np.ones(len(place), dtype=bool)
    fresh[1:] = (np.diff(place) > 1) | (owner[place[1:]] != owner[place[:-1]])
    # A separator stands before every stretch and at the end.
    at = np.arange(len(place)) + np.cumsum(fresh)
    symbol = -1 - np.arange(len(place) + int(fresh.sum()) + 1, dtype=np.int64)
    symbol[at] = owner[place] * (int(words.max()) + 1) + words[place]
    origin = np.full(len(symbol), -1, dtype=np.int64)
    origin[at] = place
    order, common = _suffix_order(symbol)
    edge = np.flatnonzero(common >= rules.window)
    edge = edge[np.argsort(-common[edge], kind="stable")]

    position, text = origin.tolist(), symbol.tolist()
    class_of: dict[int, list[int]] = {}
    ratio, least = rules.exponent - 1, rules.min_words
    for a, b, l in zip(order[edge].tolist(), order[edge + 1].tolist(), common[edge].tolist()):
        big = class_of.get(a) or class_of.setdefault(a, [a])
        small = class_of.get(b) or class_of.setdefault(b, [b])
        if len(big) < len(small):
            big, small = small, big
        for m, x in enumerate(small, 1):
            k = bisect(big, x)
            # Neighbours of the other class, unless one that comes with x stands between.
            before = big[k - 1] if k and class_of[big[k - 1]] is big else x
            behind = big[k] if k < len(big) and (m == len(small) or big[k] < small[m]) else x
            for i, j in ((before, x), (x, behind)):
                d = position[j] - position[i]
                if 0 < d and d * ratio <= l and d + l >= least and text[i - 1] != text[j - 1]:
                    yield position[i], d + l, d
            big.insert(k, x)
        for x in small:
            class_of[x] = big


def runs_of_texts(texts: list[bytes], rules: Runs) -> tuple[list[list[dict]], list[bytes]]:
    """The runs of each text, by start and period, and each text's words without repetitions."""
    split = [t.split() for t in texts]  # bytes split at the six blanks only
    number: dict[bytes, int] = defaultdict(count().__next__)
    sizes = np.array([len(w) for w in split], dtype=np.int64)
    words = np.fromiter((number[w] for part in split for w in part), dtype=np.int64, count=int(sizes.sum()))
    owner = np.repeat(np.arange(len(texts)), sizes)
    first = np.cumsum(sizes) - sizes
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for at, length, period in find_runs(words, owner, rules):
        k = int(owner[at])
        found[k].append((at - int(first[k]), period, length))
    kept = []
    for part, runs in zip(split, found):
        runs.sort()
        if runs:
            edge = np.zeros(len(part) + 1, dtype=np.int64)
            for at, period, length in runs:
                edge[at + period] += 1
                edge[at + length] -= 1
            part = [w for w, cover in zip(part, np.cumsum(edge).tolist()) if not cover]
        kept.append(b" ".join(part))
    return [[{"start": s, "length": n, "period": q} for s, q, n in runs] for runs in found], kept


# --- tables ---------------------------------------------------------------------------


def periodic_runs(df: DataFrame, rules: Runs = Runs(), text: str = "text") -> DataFrame:
    """Rows of ``df`` with ``n_words``, ``runs`` (start, length, period; by start, then period) and ``collapsed``.

    A run is a stretch of consecutive words with smallest period q, of at least
    ``rules.min_words`` and ``rules.exponent`` * q words, that no neighbouring word extends.
    ``collapsed`` has the text's words, joined by one space, without those that any run holds
    after its first q. Row-local: no shuffle, and no row waits for another. A null or blank
    text has no words, no runs and an empty ``collapsed``; a text of any length is one slice;
    repeated rows are judged alike; an empty table gives an empty table; columns named like
    the three results are replaced.
    """
    out = renamed_free(df, "n_words", "runs", "collapsed")
    rest = [c for c in out.columns if c != text]
    body_name = "_" * (1 + max(map(len, rest), default=0)) + "body"  # a name no column has

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column(len(rest)).to_pylist()
            for begin, end in slices(bodies, rules.slice_bytes):
                runs, kept = runs_of_texts(bodies[begin:end], rules)
                sizes = [len(t.split()) for t in bodies[begin:end]]
                columns = [batch.column(k).slice(begin, end - begin) for k in range(len(rest))]
                new = [batch.column(len(rest)).slice(begin, end - begin), pa.array(sizes, pa.int64()), pa.array(runs, _RUN), pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays([*columns, *new], [*rest, body_name, "n_words", "runs", "collapsed"])

    body = F.coalesce(F.col(text), F.lit("")).cast("binary").alias(body_name)
    carried = out.select(*(F.col(f"`{c}`") for c in rest), body)
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in carried.schema] + ["n_words bigint", f"runs {RUN_TYPE}", "collapsed binary"]
    )
    found = carried.mapInArrow(judge, schema)
    return found.select(
        *(F.col(f"`{c}`") for c in rest), "n_words", "runs", F.col("collapsed").cast("string").alias("collapsed")
    )
