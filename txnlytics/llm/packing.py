"""Best-fit packing by a grouping genetic algorithm, run as islands with elite migration."""

from __future__ import annotations

import os
import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from txnlytics.llm.common import WORD_RUN, slices
from txnlytics.session import materialise


@dataclass(frozen=True)
class Packing:
    """``deme`` pieces evolve together, on each of ``islands`` populations; the end id closes a document."""

    capacity: int = 4096
    vocabulary: str = "word_bpe_49k.json"
    end_id: int = 1
    deme: int = 2048
    islands: int = 2
    population: int = 4
    generations: int = 6
    open_bins: int = 2
    seed: int = 7


# --- documents to pieces ----------------------------------------------------------

#: Units whose ids a worker remembers; beyond that it starts anew, so its memory is bounded.
REMEMBERED = 1_000_000

#: Latin letters and some marks: runs of either are units for any of the vocabulary's split rules.
_UNITS = re.compile("[a-zß-öø-ÿ]+|[.,!?;:|*&%$#]+")
_WORDS = re.compile(WORD_RUN)
_OTHER = re.compile("[^A-Za-zÀ-ÖØ-öø-ÿ.,!?;:|*&%$# \t\n\x0b\x0c\r]")


class Encoder:
    """Token ids of texts.

    The vocabulary drops blanks and never joins across them, nor across the border of
    letters and marks, so a text's ids are those of its units in turn. Words with other
    characters are taken whole. Bytes that are no UTF-8 count as replacement characters.
    """

    def __init__(self, vocabulary: str) -> None:
        import public_tokenizers
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        ends = [number for token, number in self.tokenizer.get_vocab().items() if token.endswith("</w>")]
        self.closes = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.closes[ends] = True
        self.parts: dict[str, bytes] = {}

    def _learn_parts(self, parts: list[str]) -> None:
        """Encode many parts at once; each is one unit of the vocabulary, so it ends with a closing token."""
        for at in range(0, len(parts), 1000):
            some = parts[at : at + 1000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) != len(some):
                raise ValueError("a part of a word was split by the vocabulary")
            raw, begin = ids.tobytes(), 0
            for part, end in zip(some, ends.tolist()):
                self.parts[part] = raw[begin * 4 : end * 4]
                begin = end

    def _split(self, text: str) -> list[str]:
        if not _OTHER.search(text):
            return _UNITS.findall(text.lower())
        out: list[str] = []
        for word in _WORDS.findall(text):
            if _OTHER.search(word):
                out.append(" " + word)  # the blank tells whole words from units
            else:
                out += _UNITS.findall(word.lower())
        return out

    def _learn(self, fresh: set[str]) -> None:
        words = [x for x in fresh if x[0] == " "]
        self._learn_parts([x for x in fresh if x[0] != " "])
        for word, found in zip(words, self.tokenizer.encode_batch_fast(words, add_special_tokens=False)):
            self.parts[word] = np.array(found.ids, dtype="<u4").tobytes()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        split = [self._split(text.decode("utf-8", "replace")) for text in texts]
        units = list(chain.from_iterable(split))
        ids = list(map(self.parts.get, units))
        unknown = [k for k, part in enumerate(ids) if part is None]
        if unknown:
            fresh = {units[k] for k in unknown}
            if len(self.parts) + len(fresh) > REMEMBERED:
                self.parts = {}
            self._learn(fresh)
            for k in unknown:
                ids[k] = self.parts[units[k]]
        out, at = [], 0
        for part in split:
            out.append(b"".join(ids[at : at + len(part)]))
            at += len(part)
        return out


_ENCODERS: dict[str, Encoder] = {}


def _encoder(vocabulary: str) -> Encoder:
    """One encoder a worker process, with what it remembers from earlier tasks."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = Encoder(vocabulary)
    return _ENCODERS[vocabulary]


def cut_pieces(df: DataFrame, rules: Packing = Packing(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, piece, start, length, ids) of every document: ids as bytes, the end id included.

    Null text is empty: one piece with the end id alone. Only a document of more than
    ``capacity`` ids is cut, into full pieces and a last one. A null key stays null;
    repeated rows give repeated pieces; an empty table gives none.
    """
    end = np.array([rules.end_id], dtype="<u4").tobytes()
    step = rules.capacity * 4

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(rules.vocabulary)
        for batch in batches:
            keys, bodies = batch["key"].tolist(), batch["body"].tolist()
            for begin, stop in slices(bodies, 1 << 20):
                out = []
                for k, ids in enumerate(encoder.encode(bodies[begin:stop]), begin):
                    ids += end
                    out.extend((keys[k], at // step, at // 4, ids[at : at + step]) for at in range(0, len(ids), step))
                columns = list(zip(*out))
                yield pd.DataFrame({
                    "key": pd.Series(columns[0], dtype=object),
                    "piece": np.array(columns[1], dtype=np.int32),
                    "start": np.array(columns[2], dtype=np.int64),
                    "length": np.array([len(x) // 4 for x in columns[3]], dtype=np.int64),
                    "ids": pd.Series(columns[3], dtype=object),
                })

    kind = df.select(key).schema[0].dataType.simpleString()
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = df.select(F.col(key).alias("key"), body.alias("body"))
    if kind in ("bigint", "int"):
        # Whole numbers with nulls would turn into floats in pandas.
        rows = rows.withColumn("key", F.col("key").cast("string"))
        pieces = rows.mapInPandas(cut, "key string, piece int, start long, length long, ids binary")
        return pieces.withColumn("key", F.col("key").cast(kind)).withColumnRenamed("key", key)
    return rows.mapInPandas(cut, f"key {kind}, piece int, start long, length long, ids binary").withColumnRenamed("key", key)


# --- the genetic algorithm on one deme ---------------------------------------------

Bins = list[list[int]]


def best_fit(items: list[int], size: list[int], capacity: int, bins: Bins) -> Bins:
    """Put the items, in the given order, into the fullest bin with room, else into a new one."""
    bins = [list(b) for b in bins]
    room = sorted((capacity - sum(size[i] for i in b), k) for k, b in enumerate(bins))
    for i in items:
        at = bisect_left(room, (size[i], -1))
        if at == len(room):
            left, k = capacity, len(bins)
            bins.append([])
        else:
            left, k = room.pop(at)
        bins[k].append(i)
        insort(room, (left - size[i], k))
    return bins


def fitness(bins: Bins, size: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then fuller full ones."""
    return -len(bins), sum((sum(size[i] for i in b) / capacity) ** 2 for b in bins)


def crossover(host: Bins, donor: Bins, size: list[int], capacity: int, draw: np.random.Generator) -> Bins:
    """Inject whole well-filled bins of the donor, drop the host's bins that repeat their items, best-fit the displaced."""
    full = sorted(donor, key=lambda b: -sum(size[i] for i in b))
    most = max(1, len(full) // 2)
    injected = [full[k] for k in range(most) if draw.random() < 0.7] or full[:1]
    inside = {i for b in injected for i in b}
    kept, displaced = [], []
    for b in host:
        if inside.isdisjoint(b):
            kept.append(b)
        else:
            displaced.extend(i for i in b if i not in inside)
    displaced.sort(key=lambda i: -size[i])
    return best_fit(displaced, size, capacity, injected + kept)


def mutate(bins: Bins, size: list[int], capacity: int, draw: np.random.Generator) -> Bins:
    """Empty the least filled bins and a few random ones, best-fit their items."""
    order = sorted(range(len(bins)), key=lambda k: sum(size[i] for i in bins[k]))
    gone = set(order[:2]) | {int(k) for k in draw.integers(0, len(bins), 3)}
    loose = sorted((i for k in gone for i in bins[k]), key=lambda i: -size[i])
    return best_fit(loose, size, capacity, [b for k, b in enumerate(bins) if k not in gone])


def evolve(size: list[int], start: list[Bins], rules: Packing, seed: int) -> Bins:
    """The best grouping of one population; ends early at the lower bound of total size over capacity."""
    draw = np.random.Generator(np.random.PCG64(seed))
    capacity, least = rules.capacity, -(-sum(size) // rules.capacity)
    rank = lambda b: fitness(b, size, capacity)
    falling = sorted(range(len(size)), key=lambda i: -size[i])
    crowd = [*start, best_fit(falling, size, capacity, [])]
    while len(crowd) < rules.population:
        noise = draw.random(len(size)) * 0.2 + 0.9
        crowd.append(best_fit(sorted(falling, key=lambda i: -size[i] * noise[i]), size, capacity, []))
    crowd.sort(key=rank, reverse=True)
    for _ in range(rules.generations):
        if len(crowd[0]) <= least:
            break
        a, b = draw.permutation(len(crowd))[:2]
        young = [crossover(crowd[0], crowd[max(a, b)], size, capacity, draw), crossover(crowd[a], crowd[b], size, capacity, draw)]
        young.append(mutate(young[0], size, capacity, draw))
        crowd = sorted(crowd + young, key=rank, reverse=True)[: rules.population]
    return crowd[0]


# --- islands ------------------------------------------------------------------------

_ELITE = "deme long, island int, n_bins int, fit double, items array<long>, sizes array<int>, bins array<int>"


def _elite(deme: int, island: int, items, sizes: list[int], bins: Bins, capacity: int) -> pd.DataFrame:
    place = np.zeros(len(sizes), dtype=np.int32)
    for k, b in enumerate(bins):
        place[b] = k
    return pd.DataFrame({
        "deme": [deme], "island": [island], "n_bins": [len(bins)], "fit": [fitness(bins, sizes, capacity)[1]],
        "items": [np.asarray(items, dtype=np.int64)], "sizes": [np.asarray(sizes, dtype=np.int32)], "bins": [place],
    })


def _grouping(numbers) -> Bins:
    found: dict[int, list[int]] = {}
    for i, k in enumerate(numbers):
        found.setdefault(int(k), []).append(i)
    return list(found.values())


def _settle(items: DataFrame, rules: Packing, level: int) -> DataFrame:
    """(item, size, home) -> (deme, item, size, bin): one epoch per island, migration, a second epoch, the best island."""
    demes = max(1, -(-items.count() // rules.deme))
    deme = F.pmod(F.xxhash64("item", F.lit(rules.seed + level)), F.lit(demes))
    spread = items.select("item", "size", "home", deme.alias("deme"))
    islands = spread.withColumn("island", F.explode(F.array(*[F.lit(k) for k in range(rules.islands)])))

    def first(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("item")
        sizes = rows["size"].tolist()
        homes = [_grouping(rows["home"])] if level else []
        best = evolve(sizes, homes, rules, hash((key, level, rules.seed)) & 0xFFFFFFFF)
        return _elite(*key, rows["item"], sizes, best, rules.capacity)

    def second(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        sizes = rows["sizes"].iloc[0].tolist()
        best = evolve(sizes, [_grouping(b) for b in rows["bins"]], rules, hash((key, level, rules.seed, 2)) & 0xFFFFFFFF)
        return _elite(*key, rows["items"].iloc[0], sizes, best, rules.capacity)

    elites = materialise(islands.groupBy("deme", "island").applyInPandas(first, _ELITE), "elites")
    arrived = elites.withColumn("island", (F.col("island") + 1) % rules.islands)
    evolved = elites.unionByName(arrived).groupBy("deme", "island").applyInPandas(second, _ELITE)
    best = evolved.groupBy("deme").agg(
        F.max_by(F.struct("items", "sizes", "bins"), F.struct((-F.col("n_bins")).alias("n"), "fit", (-F.col("island")).alias("i"))).alias("b")
    )
    zipped = F.arrays_zip(F.col("b.items").alias("item"), F.col("b.sizes").alias("size"), F.col("b.bins").alias("bin"))
    return best.select("deme", F.inline(zipped))


def pack(pieces: DataFrame, rules: Packing = Packing(), length: str = "length") -> DataFrame:
    """Rows of ``pieces`` with ``sequence_id`` and ``offset``: gapless sequences of at most ``capacity``.

    Pieces are dealt at random to demes of bounded size. Each deme evolves on several
    islands; every island's elite migrates to the next one before a second epoch; the best
    island's grouping is taken. The few least filled sequences of all demes are then dealt
    to fewer demes and packed again, so that rounding up costs little however many demes
    there are. Pieces that fill a sequence alone are left out of the search.

    No piece is lost or cut here: a length above ``capacity`` or below 1 (or null) is an
    error. Repeated rows are packed one by one. An empty table gives an empty table.
    Columns named ``sequence_id`` or ``offset`` are replaced, ``_item`` and ``_placed`` dropped.
    """
    kept = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset", "_item", "_placed")]
    rows = materialise(pieces.select(*kept).withColumn("_item", F.monotonically_increasing_id()), "pieces")
    bad = F.col(length).isNull() | (F.col(length) > rules.capacity) | (F.col(length) < 1)
    if not rows.filter(bad).isEmpty():
        raise ValueError(f"every length must be between 1 and {rules.capacity}")
    part = rows.filter(F.col(length) < rules.capacity)
    items = part.select(F.col("_item").alias("item"), F.col(length).cast("int").alias("size"), F.lit(0).alias("home"))
    first = materialise(_settle(items, rules, 0), "settled")
    fills = first.groupBy("deme", "bin").agg(F.sum("size").alias("fill"))
    # One row per sequence of a deme of bounded size: the demes' least filled sequences.
    least = fills.groupBy("deme").agg(
        F.slice(F.array_sort(F.collect_list(F.struct("fill", "bin"))), 1, rules.open_bins).alias("worst")
    ).select("deme", F.inline("worst"), F.lit(True).alias("open")).drop("fill")
    marked = materialise(first.join(least, ["deme", "bin"], "left"), "marked")
    number = F.col("deme") * (1 << 16) + F.col("bin")
    closed = marked.filter(F.col("open").isNull()).select("item", "size", (number * 4).alias("sequence_id"))
    loose = marked.filter("open").select("item", "size", number.alias("home"))
    again = _settle(loose, rules, 1).select("item", "size", (number * 4 + 1).alias("sequence_id"))
    alone = rows.filter(F.col(length) == rules.capacity).select(
        F.col("_item").alias("item"), F.col(length).cast("int").alias("size"), (F.col("_item") * 4 + 2).alias("sequence_id")
    )
    inside = Window.partitionBy("sequence_id").orderBy("item").rowsBetween(Window.unboundedPreceding, -1)
    placed = closed.unionByName(again).unionByName(alone).select(
        F.col("item").alias("_placed"), "sequence_id", F.coalesce(F.sum("size").over(inside), F.lit(0)).cast("long").alias("offset")
    )
    return rows.join(placed, F.col("_item") == F.col("_placed")).select(*(F.col(f"`{c}`") for c in kept), "sequence_id", "offset")


def pack_documents(df: DataFrame, rules: Packing = Packing(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per piece: key, piece, start, length, ids_crc32, sequence_id, offset. The ids themselves come from ``cut_pieces``."""
    pieces = cut_pieces(df, rules, key, text)
    digests = pieces.select(key, "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(digests, rules)
