"""Language-model scores: a hierarchical Pitman-Yor model whose Chinese restaurants are seated by Gibbs sweeps."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from txnlytics.llm.common import WordHasher, mix, slices
from txnlytics.session import checkpoint_dir, materialise


@dataclass(frozen=True)
class Restaurants:
    """Discounts and strengths from the root down; ``sweeps`` Gibbs sweeps, the first ``burn`` of which are not averaged.

    A context is the word before, by its whole hash; its parent is that word's ending (two
    bytes). ``busy`` tokens of a word in a slice make it one whose tokens stay there.
    """

    discounts: tuple[float, float, float] = (0.6, 0.7, 0.8)
    strengths: tuple[float, float, float] = (1.0, 1.0, 1.0)
    sweeps: int = 3
    burn: int = 1
    seed: int = 5
    slice_bytes: int = 3 << 20
    bucket_bytes: int = 8 << 20
    busy: int = 128


END = np.uint64(0xE4D0E4D0E4D0E4D1)  # the end of a text, and the empty context before its first word
_END_ENDING = np.uint32(1 << 17)


# --- tokens ---------------------------------------------------------------------------


def tokens(texts: list[bytes], hasher: WordHasher) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word, context, the context's ending, text number) of every token: the words in order, then the end of the text."""
    word, start, end, owner, low = hasher.words(texts)
    long = (end - start > 1).astype(np.uint32)
    own = low[end - 1].astype(np.uint32) | long * (low[np.maximum(end - 2, 0)].astype(np.uint32) << np.uint32(8) | np.uint32(1 << 16))
    n = len(word) + len(texts)
    text = np.full(n, -1, dtype=np.int64)
    at = np.arange(len(word)) + owner
    last = np.cumsum(np.bincount(owner, minlength=len(texts))) + np.arange(len(texts)) if len(texts) else np.zeros(0, np.int64)
    value, ending = np.full(n, END, dtype=np.uint64), np.full(n, _END_ENDING, dtype=np.uint32)
    value[at], ending[at], text[at], text[last] = word, own, owner, np.arange(len(texts))
    before = lambda array, empty: np.concatenate([np.full(min(n, 1), empty, array.dtype), array[:-1]])
    return value, before(value, END), before(ending, _END_ENDING), text


def bucket_of(word: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket by a word's leading bits, so that words in order are buckets in order."""
    return ((word >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)


def _runs(changed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, length) of runs, given where a new one begins."""
    first = np.flatnonzero(changed)
    return first, np.diff(np.append(first, len(changed)))


def _new(*columns: np.ndarray) -> np.ndarray:
    out = np.ones(len(columns[0]), dtype=bool)
    if len(out):
        out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return out


# --- seating ----------------------------------------------------------------------------


def seat(customers: np.ndarray, base: np.ndarray, opening: np.ndarray, discount: float, draw: np.random.Generator) -> np.ndarray:
    """Tables of each dish after its customers have been removed and seated again, given everything else.

    ``base`` is the parent's probability of the dish, ``opening`` the weight of a new
    table. The first customer opens a table; customer k + 1 opens one with probability
    opening * base / (opening * base + k - discount * tables). From the 33rd customer on,
    k // 16 customers at a time are seated with the probability of the first of them.
    """
    tables = (customers > 0).astype(np.float64)
    order = np.argsort(-customers, kind="stable")
    number, weight = customers[order], (base * opening)[order]
    seated, k = tables[order], 1
    while True:
        n = int(np.searchsorted(-number, -k, side="left"))  # dishes with more than k customers
        if not n:
            break
        chance = weight[:n] / (weight[:n] + k - discount * seated[:n])
        block = 1 if k < 32 else k // 16
        if block == 1:
            seated[:n] += draw.random(n) < chance
        else:
            seated[:n] += draw.binomial(np.minimum(block, number[:n] - k), chance)
        k += block
    tables[order] = seated
    return tables


@dataclass
class Totals:
    """Customers and tables of restaurants: of the root, per parent, per context, as a bucket numbers them."""

    customers: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)


@dataclass
class Dishes:
    """A bucket's words: pairs (word, context) sorted by both, their counts, and the words and parents they belong to."""

    word: np.ndarray  # of each pair, numbered in the bucket
    context: np.ndarray  # of each pair, numbered in the bucket
    count: np.ndarray
    endings: np.ndarray | None = None  # of each context; without them all contexts have one parent

    def __post_init__(self) -> None:
        if self.endings is None:
            self.endings = np.zeros(int(self.context.max(initial=0)) + 1, np.uint32)
        self.parents, under = np.unique(self.endings, return_inverse=True)
        both = self.word.astype(np.int64) * len(self.parents) + under[self.context]
        found, self.parent_of = np.unique(both, return_inverse=True)  # (word, parent) of each pair
        self.word_of, self.parent = np.divmod(found, max(1, len(self.parents)))
        self.words = int(self.word[-1]) + 1 if len(self.word) else 0


def start(dishes: Dishes) -> list[np.ndarray]:
    """One table for every dish that is served."""
    lowest = (dishes.count > 0).astype(np.float64)
    middle = (np.bincount(dishes.parent_of, lowest, len(dishes.parent)) > 0).astype(np.float64)
    top = (np.bincount(dishes.word_of, middle, dishes.words) > 0).astype(np.float64)
    return [top, middle, lowest]


def served(dishes: Dishes, tables: list[np.ndarray]) -> list[np.ndarray]:
    """Customers at each level: a child's tables are its parent's customers."""
    return [
        np.bincount(dishes.word_of, tables[1], dishes.words),
        np.bincount(dishes.parent_of, tables[2], len(dishes.parent)),
        dishes.count.astype(np.float64),
    ]


def totals_of(dishes: Dishes, tables: list[np.ndarray]) -> Totals:
    customers = served(dishes, tables)
    where = [np.zeros(dishes.words, np.int64), dishes.parent, dishes.context.astype(np.int64)]
    sizes = [1, len(dishes.parents), len(dishes.endings)]
    add = lambda values: [np.bincount(w, v, s) for w, v, s in zip(where, values, sizes)]
    return Totals(add(customers), add(tables))


def probabilities(dishes: Dishes, tables: list[np.ndarray], totals: Totals, vocabulary: int, rules: Restaurants) -> list[np.ndarray]:
    """Predictive probability of each word, (word, parent) and (word, context)."""
    customers = served(dishes, tables)
    where = [np.zeros(dishes.words, np.int64), dishes.parent, dishes.context.astype(np.int64)]
    up = [None, dishes.word_of, dishes.parent_of]
    base, out = np.full(dishes.words, 1.0 / (vocabulary + 1)), []
    for level, (d, s) in enumerate(zip(rules.discounts, rules.strengths)):
        if level:
            base = out[-1][up[level]]
        here = where[level]
        opening = s + d * totals.tables[level][here]
        out.append((customers[level] - d * tables[level] + opening * base) / (s + totals.customers[level][here]))
    return out


def sweep(dishes: Dishes, tables: list[np.ndarray], totals: Totals, vocabulary: int, rules: Restaurants, seed: list[int]) -> list[np.ndarray]:
    """One Gibbs sweep: from the contexts up, each dish's customers are seated anew given the rest."""
    draw = np.random.Generator(np.random.PCG64(seed))
    known = probabilities(dishes, tables, totals, vocabulary, rules)
    opening = [s + d * t for d, s, t in zip(rules.discounts, rules.strengths, totals.tables)]
    lowest = seat(dishes.count, known[1][dishes.parent_of], opening[2][dishes.context], rules.discounts[2], draw)
    guests = np.bincount(dishes.parent_of, lowest, len(dishes.parent)).astype(np.int64)
    middle = seat(guests, known[0][dishes.word_of], opening[1][dishes.parent], rules.discounts[1], draw)
    guests = np.bincount(dishes.word_of, middle, dishes.words).astype(np.int64)
    top = seat(guests, np.full(dishes.words, 1.0 / (vocabulary + 1)), np.full(dishes.words, opening[0][0]), rules.discounts[0], draw)
    return [top, middle, lowest]


def chain(dishes: Dishes, history: list[Totals], vocabulary: int, rules: Restaurants, bucket: int) -> Iterator[list[np.ndarray]]:
    """The seatings after 0, 1, ... sweeps. They are redrawn from the seed, so none is stored and a lost task repeats them."""
    tables = start(dishes)
    yield tables
    for number, totals in enumerate(history):
        tables = sweep(dishes, tables, totals, vocabulary, rules, [rules.seed, bucket, number])
        yield tables


# --- slices and buckets -------------------------------------------------------------------

_MAPPED = (
    "bucket int, slice long, places binary, endings binary, words binary, pairs binary, contexts binary, texts binary, times binary, "
    "busy_words binary, busy_pairs binary, busy_contexts binary, busy_counts binary, keys array<string>, train array<boolean>"
)
_STATE = (
    "slot long, slice long, places binary, endings binary, words binary, contexts binary, counts binary, "
    "slices binary, firsts binary, pair binary, text binary, times binary, busy_firsts binary, busy_pair binary, "
    "keys array<string>, train array<boolean>"
)


def _pack(array: np.ndarray, kind) -> bytes:
    """Numbers as compressed bytes, all first bytes first, since most high bytes are zero."""
    flat = np.ascontiguousarray(array).astype(kind).ravel()
    planes = flat.view(np.uint8).reshape(len(flat), flat.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(raw: bytes | None, kind) -> np.ndarray:
    if not raw:
        return np.zeros(0, dtype=kind)
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def _pack_hashes(sorted_hashes: np.ndarray) -> bytes:
    return _pack(np.diff(sorted_hashes, prepend=np.uint64(0)), np.uint64)


def _unpack_hashes(raw: bytes | None) -> np.ndarray:
    return np.cumsum(_unpack(raw, np.uint64), dtype=np.uint64)


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch one by one; their blobs are large, so only one row is copied at a time."""
    for k in range(batch.num_rows):
        yield {name: column[k].as_py() for name, column in zip(batch.schema.names, batch.columns)}


def _map_slice(bodies: list[bytes], train: np.ndarray, hasher: WordHasher, buckets: int, rules: Restaurants):
    """(rows for buckets, row of the slice) as dicts."""
    word, context, ending, text = tokens(bodies, hasher)
    known, lead, context = np.unique(context, return_index=True, return_inverse=True)
    ending = ending[lead]
    order = np.lexsort((text, context, word))
    word, context, text = word[order], context[order], text[order]
    first, length = _runs(_new(word))
    busy = np.repeat(length >= rules.busy, length)
    first, times = _runs(_new(word, context, text))
    word, context, text, busy = word[first], context[first], text[first], busy[first]
    rare = ~busy
    w, c, t, n = word[rare], context[rare], text[rare], times[rare]
    flagged = t | (train[t].astype(np.int64) << 31)
    bt, bn, new = text[busy], times[busy], _new(word[busy], context[busy])
    pair = np.cumsum(new) - 1
    counts = np.bincount(pair, bn * train[bt], int(new.sum())).astype(np.int64)
    pw, pc = word[busy][new], context[busy][new]
    rows = {}
    edges, busy_edges = (np.searchsorted(bucket_of(values, buckets), np.arange(buckets + 1)) for values in (w, pw))
    for b in range(buckets):
        lo, hi, blo, bhi = edges[b], edges[b + 1], busy_edges[b], busy_edges[b + 1]
        if lo == hi and blo == bhi:
            continue
        here, number = np.unique(np.concatenate([c[lo:hi], pc[blo:bhi]]), return_inverse=True)
        rows[b] = {"places": _pack_hashes(known[here]), "endings": _pack(ending[here], np.uint32)}
        if lo < hi:
            starts, sizes = _runs(_new(w[lo:hi]))
            rows[b].update(
                words=_pack(w[lo:hi][starts], np.uint64), pairs=_pack(sizes, np.uint32), contexts=_pack(number[: hi - lo], np.uint32),
                texts=_pack(flagged[lo:hi], np.uint32), times=_pack(n[lo:hi], np.uint32),
            )
        if blo < bhi:
            starts, sizes = _runs(_new(pw[blo:bhi]))
            rows[b].update(
                busy_words=_pack(pw[blo:bhi][starts], np.uint64), busy_pairs=_pack(sizes, np.uint32),
                busy_contexts=_pack(number[hi - lo :], np.uint32), busy_counts=_pack(counts[blo:bhi], np.uint32),
            )
    own = {"pairs": _pack(pair, np.uint32), "texts": _pack(bt, np.uint32), "times": _pack(bn, np.uint32)}
    return rows, own


def _build_bucket(pdf: pd.DataFrame) -> dict:
    """All slices' tokens of one bucket as numbered pairs, counts, and references to pairs."""
    word, context, count, piece, text, times = [], [], [], [], [], []
    busy_word, busy_context, busy_count, busy_piece = [], [], [], []
    pdf = pdf.sort_values("slice")
    read = _unpack
    named = [_unpack_hashes(raw) for raw in pdf["places"]]
    places, lead = np.unique(np.concatenate(named), return_index=True)
    endings = np.concatenate([read(raw, np.uint32) for raw in pdf["endings"]])[lead]
    for k, row in enumerate(pdf.to_dict("records")):
        flagged = read(row["texts"], np.uint32)
        number = np.searchsorted(places, named[k]).astype(np.uint32)  # of the slice's contexts
        n = read(row["times"], np.uint32).astype(np.int64)
        word.append(np.repeat(read(row["words"], np.uint64), read(row["pairs"], np.uint32)))
        context.append(number[read(row["contexts"], np.uint32)])
        count.append(n * (flagged >> 31))
        text.append(flagged & 0x7FFFFFFF)
        times.append(n)
        piece.append(np.full(len(n), k))
        busy_word.append(np.repeat(read(row["busy_words"], np.uint64), read(row["busy_pairs"], np.uint32)))
        busy_context.append(number[read(row["busy_contexts"], np.uint32)])
        busy_count.append(read(row["busy_counts"], np.uint32).astype(np.int64))
        busy_piece.append(np.full(len(busy_count[-1]), k))
    rare = sum(map(len, word))
    word, context = np.concatenate(word + busy_word), np.concatenate(context + busy_context)
    count, piece = np.concatenate(count + busy_count), np.concatenate(piece + busy_piece)
    order = np.lexsort((context, word))
    new = _new(word[order], context[order])
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    lead = order[new]
    firsts = lambda p: _pack(np.searchsorted(p, np.arange(len(pdf) + 1)), np.int64)
    return {
        "words": _pack(np.diff(np.append(np.flatnonzero(_new(word[lead])), len(lead))), np.uint32),
        "places": _pack_hashes(places), "endings": _pack(endings, np.uint32),
        "contexts": _pack(context[lead], np.uint32),
        "counts": _pack(np.bincount(number, count, len(lead)), np.uint32),
        "slices": _pack(pdf["slice"].to_numpy(), np.int64),
        "firsts": firsts(piece[:rare]), "pair": _pack(number[:rare], np.uint32),
        "text": _pack(np.concatenate(text), np.uint32), "times": _pack(np.concatenate(times), np.uint32),
        "busy_firsts": firsts(piece[rare:]), "busy_pair": _pack(number[rare:], np.uint32),
    }


def _dishes(row: dict) -> Dishes:
    sizes = _unpack(row["words"], np.uint32)
    return Dishes(
        np.repeat(np.arange(len(sizes)), sizes),
        _unpack(row["contexts"], np.uint32),
        _unpack(row["counts"], np.uint32).astype(np.int64),
        _unpack(row["endings"], np.uint32),
    )


def _dealt(df: DataFrame, label: str, column: str, parts: int) -> DataFrame:
    """``df`` written once in ``parts`` buckets of ``column``, so that meeting other rows by it does not shuffle it again.

    Only tables can be bucketed; the name goes at once, the files stay as those of ``materialise``.
    """
    spark, name = df.sparkSession, f"{label}_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(spark)}/txnlytics/{name}"
    df.write.format("parquet").bucketBy(parts, column).option("path", path).option("compression", "snappy").saveAsTable(name)
    written = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return written


def _gather(df: DataFrame, train: Column, key: str, text: str, rules: Restaurants) -> tuple[DataFrame, int]:
    """The state, a row per bucket of words (slot 0, 1, ...) and a row per slice of documents (slot below 0); how many buckets."""
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = df.select(F.col(key).cast("string").alias("key"), F.coalesce(train, F.lit(False)).alias("train"), body.alias("body"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0))).first()[0]
    buckets = int(max(8, size // rules.bucket_bytes + 1))
    names = [part.strip().split(" ")[0] for part in _MAPPED.split(", ")]
    schema = pa.schema(
        [("bucket", pa.int32()), ("slice", pa.int64())] + [(n, pa.binary()) for n in names[2:-2]]
        + [("keys", pa.list_(pa.string())), ("train", pa.list_(pa.bool_()))]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, number = WordHasher(), TaskContext.get().partitionId() << 32
        for batch in batches:
            bodies = batch.column("body").to_pylist()
            flags = np.array(batch.column("train").to_pylist(), dtype=bool)
            for begin, end in slices(bodies, rules.slice_bytes):
                found, own = _map_slice(bodies[begin:end], flags[begin:end], hasher, buckets, rules)
                out = [{"bucket": b, "slice": number, **row} for b, row in found.items()]
                keys = batch.column("key").slice(begin, end - begin).to_pylist()
                out.append({"bucket": -1, "slice": number, **own, "keys": keys, "train": flags[begin:end].tolist()})
                for row in out:  # a row at a time: blobs are large
                    yield pa.RecordBatch.from_pylist([row], schema=schema)
                number += 1

    mapped = rows.mapInArrow(scan, _MAPPED)
    columns = [part.strip().split(" ")[0] for part in _STATE.split(", ")]

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        if key[0] >= 0:
            row = {"slot": key[0], "slice": -1, **_build_bucket(pdf)}
        else:
            own = pdf.iloc[0]
            row = {"slot": key[0], "slice": own["slice"], "pair": own["pairs"], "text": own["texts"], "times": own["times"]}
            row |= {"keys": own["keys"], "train": own["train"]}
        return pd.DataFrame({c: pd.Series([row.get(c)], dtype="int64" if c in ("slot", "slice") else object) for c in columns})

    slot = F.when(F.col("bucket") < 0, -1 - F.col("slice")).otherwise(F.col("bucket").cast("long"))
    return _dealt(mapped.groupBy(slot.alias("slot")).applyInPandas(build, _STATE), "restaurants", "slot", buckets), buckets


# --- totals of restaurants ------------------------------------------------------------------
#
# A restaurant's total is added up at its spot: the root has one, parents and contexts are dealt by hash.
# A bucket names its restaurants to the spots once; then only numbers go there and back, in that order.

_NAMES = "spot int, slot long, level int, names binary"
_SUMS = "spot int, slot long, customers binary, tables binary"
_TOTALS = "slot long, spot int, customers binary, tables binary, sweep int"


def _spots(dishes: Dishes, places: np.ndarray, spots: int) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """(spot, level, the bucket's restaurants dealt to it, their names) in the order of spots."""
    parents = dishes.parents.astype(np.uint64)
    out = [(0, 0, np.zeros(1, np.int64), np.zeros(1, np.uint64))]
    for level, names, hashed in ((1, parents, mix(parents + np.uint64(1))), (2, places, places)):
        at = bucket_of(hashed, spots)
        order = np.argsort(at, kind="stable")
        edges = np.searchsorted(at[order], np.arange(spots + 1))
        for k in range(spots):
            which = order[edges[k] : edges[k + 1]]
            if len(which):
                out.append((1 + (level - 1) * spots + k, level, which, names[which]))
    return out


def _history(dishes: Dishes, dealt: list, found: pd.DataFrame) -> list[Totals]:
    """What came back from the spots for the sweeps so far; the customers of contexts do not change and came once."""
    history: list[Totals] = []
    for _, rows in sorted(found.groupby("sweep"), key=lambda x: x[0]):
        back = {spot: (customers, tables) for spot, customers, tables in zip(rows["spot"], rows["customers"], rows["tables"])}
        sizes = (1, len(dishes.parents), len(dishes.endings))
        totals = Totals([np.zeros(n) for n in sizes], [np.zeros(n) for n in sizes])
        for spot, level, which, _ in dealt:
            customers, tables = back[spot]
            totals.tables[level][which] = _unpack(tables, np.uint64)
            if level < 2 or not history:
                totals.customers[level][which] = _unpack(customers, np.uint64)
        if history:
            totals.customers[2] = history[0].customers[2]
        history.append(totals)
    return history


def _add_up(names: pd.DataFrame, sums: pd.DataFrame) -> pd.DataFrame:
    """Totals of one spot's restaurants, for every bucket that has some of them."""
    both = names.merge(sums, on="slot").sort_values("slot")
    keys = [_unpack_hashes(raw) for raw in both["names"]]
    edges = np.cumsum([0, *map(len, keys)])
    where = np.unique(np.concatenate(keys), return_inverse=True)[1] if keys else np.zeros(0, np.int64)
    out = pd.DataFrame({"slot": both["slot"], "spot": both["spot_x"]})
    for column in ("customers", "tables"):
        if both[column].isna().any():  # sent in the first round only
            out[column] = None
            continue
        values = np.concatenate([_unpack(raw, np.uint32) for raw in both[column]]) if keys else np.zeros(0)
        total = np.bincount(where, values)[where]
        out[column] = [_pack(total[a:b], np.uint64) for a, b in zip(edges[:-1], edges[1:])]
    return out


def _learn(model: DataFrame, vocabulary: int, buckets: int, rules: Restaurants) -> DataFrame:
    """The totals before and after every sweep, per bucket and spot."""
    spots = max(8, buckets // 4)

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                for spot, level, _, names in _spots(_dishes(row), _unpack_hashes(row["places"]), spots):
                    columns = [pa.array([spot], pa.int32()), pa.array([row["slot"]], pa.int64()), pa.array([level], pa.int32())]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array([_pack_hashes(names)], pa.binary())], ["spot", "slot", "level", "names"])

    named = _dealt(model.mapInArrow(name, _NAMES), "restaurant_names", "spot", spots)
    history = model.sparkSession.createDataFrame([], _TOTALS)

    def add(key: tuple, rows: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        row = rows.iloc[0]
        dishes = _dishes(row)
        dealt = _spots(dishes, _unpack_hashes(row["places"]), spots)
        known = _history(dishes, dealt, found)
        for tables in chain(dishes, known, vocabulary, rules, int(row["slot"])):
            last = tables
        mine = totals_of(dishes, last)
        out = []
        for spot, level, which, _ in dealt:
            customers = _pack(mine.customers[level][which], np.uint32) if level < 2 or not known else None
            out.append((spot, row["slot"], customers, _pack(mine.tables[level][which], np.uint32)))
        return pd.DataFrame(out, columns=["spot", "slot", "customers", "tables"])

    for number in range(rules.sweeps + 1):
        sums = model.groupBy("slot").cogroup(history.groupBy("slot")).applyInPandas(add, _SUMS)
        totals = named.groupBy("spot").cogroup(sums.groupBy("spot")).applyInPandas(_add_up, _TOTALS.removesuffix(", sweep int"))
        history = history.unionByName(materialise(totals, "restaurant-totals").withColumn("sweep", F.lit(number)))
    return history


def score_texts(df: DataFrame, train: Column, rules: Restaurants = Restaurants(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``df``: key, train, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    Learns from the rows where ``train`` is true. Tokens are the words (A-Z lowered) and
    the end of the text. ``score`` is the log10 of the averaged predictive probabilities of
    the tokens, ``base_score`` that of the add-one unigram model. An unknown word gets what
    the model leaves to one unknown word. Null texts are empty: their end is scored. A null
    ``train`` is false; keys may be null or repeat; other columns are not read; an empty
    table gives an empty table; with nothing to learn from every probability is 1.

    Tokens are dealt by word. A slice ships each (word, context, text) once; words that are
    busy in a slice ship counts only, and their scores come back to the slice, so no bucket
    gathers a frequent word's tokens. A sweep needs the totals of the restaurants a bucket
    meets; each bucket sends one number per restaurant to where these are added up and gets
    the totals back. Seatings are redrawn from seeds instead of being stored.
    """
    state, buckets = _gather(df, train, key, text, rules)
    parts = ("slot", "words", "places", "endings", "contexts", "counts")
    model = state.filter("slot >= 0").select(*parts)

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                dishes = _dishes(row)
                per_word = np.bincount(dishes.word, dishes.count, dishes.words)
                yield pa.RecordBatch.from_pydict({"v": [int((per_word > 0).sum())], "n": [int(per_word.sum())]})

    found = model.mapInArrow(sizes, "v long, n long").agg(F.coalesce(F.sum("v"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    vocabulary, trained = int(found[0]), int(found[1])
    history = _learn(model, vocabulary, buckets, rules)
    spots = max(8, buckets // 4)

    def answer(key: tuple, rows: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        return _answer_bucket(rows.iloc[0], found, spots, vocabulary, trained, rules)

    refs = state.filter("slot >= 0").select(*parts, "slices", "firsts", "pair", "text", "times", "busy_firsts", "busy_pair")
    answers = refs.groupBy("slot").cogroup(history.groupBy("slot")).applyInPandas(answer, _ANSWERS)
    own = state.filter("slot < 0").select(
        "slice", "pair", "text", "times", "keys", "train", F.lit(-1).alias("bucket"),
        *[F.lit(None).cast("binary").alias(c) for c in ("sums", "logs")],
    )
    both = own.unionByName(answers.select(
        "slice", F.lit(None).cast("binary").alias("pair"), "text", F.lit(None).cast("binary").alias("times"),
        F.lit(None).cast("array<string>").alias("keys"), F.lit(None).cast("array<boolean>").alias("train"), "bucket", "sums", "logs",
    ))
    schema = "key string, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    total = trained

    def finish(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return _finish_slice(pdf, total)

    done = both.groupBy("slice").applyInPandas(finish, schema)
    kind = df.schema[key].dataType.simpleString()
    return done.select(
        F.col("key").cast(kind).alias(key), "train", "n_tokens", "n_known", "train_tokens", "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )


_ANSWERS = "slice long, bucket int, text binary, sums binary, logs binary"


def _answer_bucket(row: pd.Series, found: pd.DataFrame, spots: int, vocabulary: int, trained: int, rules: Restaurants) -> pd.DataFrame:
    """Per slice: sums over the bucket's rare tokens by text, and the logs of its busy pairs."""
    dishes = _dishes(row)
    history = _history(dishes, _spots(dishes, _unpack_hashes(row["places"]), spots), found)
    mean, samples = np.zeros(len(dishes.word)), 0
    for number, tables in enumerate(chain(dishes, history[:-1], vocabulary, rules, int(row["slot"]))):
        if number > rules.burn or rules.sweeps <= rules.burn:
            mean += probabilities(dishes, tables, history[number], vocabulary, rules)[2]
            samples += 1
    log = np.log10(mean / max(samples, 1)) if len(mean) else mean
    per_word = np.bincount(dishes.word, dishes.count, dishes.words)
    base = np.log10((per_word + 1) / (trained + vocabulary + 1))[dishes.word]
    known = (per_word > 0).astype(np.float64)[dishes.word]
    names = _unpack(row["slices"], np.int64)
    firsts, busy_firsts = (_unpack(row[c], np.int64) for c in ("firsts", "busy_firsts"))
    pair, busy_pair, text = (_unpack(row[c], np.uint32) for c in ("pair", "busy_pair", "text"))
    times = _unpack(row["times"], np.uint32).astype(np.float64)
    out = []
    for k, name in enumerate(names):
        a, b = firsts[k], firsts[k + 1]
        ids, where = np.unique(text[a:b], return_inverse=True)
        p, n = pair[a:b], times[a:b]
        sums = np.stack([np.bincount(where, n * v[p], len(ids)) for v in (log, base, known, np.ones(len(log)))]) if len(ids) else np.zeros((4, 0))
        q = busy_pair[busy_firsts[k] : busy_firsts[k + 1]]
        out.append((int(name), int(row["slot"]), _pack(ids, np.uint32), _pack(sums, np.float64), _pack(np.stack([log[q], base[q], known[q]]), np.float64)))
    return pd.DataFrame(out, columns=["slice", "bucket", "text", "sums", "logs"])


def _finish_slice(pdf: pd.DataFrame, trained: int) -> pd.DataFrame:
    """Add up what the buckets answered and the slice's own busy tokens, per text."""
    pdf = pdf.sort_values("bucket")
    own = pdf.iloc[0]
    n = len(own["keys"])
    sums = np.zeros((4, n))
    logs = [np.zeros((3, 0))]
    for row in pdf.iloc[1:].to_dict("records"):
        ids = _unpack(row["text"], np.uint32)
        sums[:, ids] += _unpack(row["sums"], np.float64).reshape(4, -1)
        logs.append(_unpack(row["logs"], np.float64).reshape(3, -1))
    log = np.concatenate(logs, axis=1)  # busy pairs are in bucket order
    pair, text = (_unpack(own[c], np.uint32) for c in ("pair", "text"))
    times = _unpack(own["times"], np.uint32).astype(np.float64)
    for k in range(3):
        sums[k] += np.bincount(text, times * log[k][pair], n)
    sums[3] += np.bincount(text, times, n)
    return pd.DataFrame({
        "key": list(own["keys"]), "train": list(own["train"]),
        "n_tokens": np.rint(sums[3]).astype(np.int64), "n_known": np.rint(sums[2]).astype(np.int64),
        "train_tokens": trained, "base_score": sums[1], "score": sums[0],
    })
