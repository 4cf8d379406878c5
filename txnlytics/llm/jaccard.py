"""Exact n-gram Jaccard join in metric space: pivots, Voronoi regions, triangle-inequality windows, recursion."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from txnlytics.llm.common import WordHasher, carried, mix, restored, slices
from txnlytics.llm.components import components
from txnlytics.session import discard, materialise


@dataclass(frozen=True)
class Join:
    """Documents of ``words``-grams link at ``percent`` / 100 Jaccard similarity or more.

    ``region`` is the number of documents that one task compares with each other; larger
    regions are split by ``pivots`` pivots, ``depth`` times at most, and what no pivot can
    split is compared block by block. ``ordered`` bounds the broadcast list of frequent
    n-grams, which only orders them: any order gives the same links.
    """

    words: int = 5
    percent: int = 80
    region: int = 512
    pivots: int = 8
    depth: int = 4
    ordered: int = 65_536
    slice_bytes: int = 2 << 20
    bucket_grams: int = 500_000
    block_grams: int = 4_000_000


HEAVY_BIT = np.uint64(1) << np.uint64(63)


# --- texts to sets --------------------------------------------------------------------


class Shingler:
    """Distinct n-grams of many texts at once, as 63-bit numbers."""

    def __init__(self, words: int) -> None:
        self.n, self.hasher = words, WordHasher()

    def grams(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(n-gram, text number), repeats included, by text; a text of fewer words is one gram, one without words none."""
        word, _, _, owner, _ = self.hasher.words(texts)
        m, k = len(word), self.n
        out = [np.zeros(0, np.uint64)]
        who = [np.zeros(0, np.int64)]
        if m >= k:
            value = np.full(m - k + 1, k, dtype=np.uint64)
            for j in range(k):
                value = mix(value * np.uint64(0x2545F4914F6CDD1D) + word[j : m - k + 1 + j])
            whole = owner[: m - k + 1] == owner[k - 1 :]
            out.append(value[whole])
            who.append(owner[: m - k + 1][whole])
        counts = np.bincount(owner, minlength=len(texts))
        for text in np.flatnonzero((counts > 0) & (counts < k)):
            at = np.searchsorted(owner, text)
            value = np.full(1, counts[text], dtype=np.uint64)
            for j in range(counts[text]):
                value = mix(value * np.uint64(0x2545F4914F6CDD1D) + word[at + j : at + j + 1])
            out.append(value)
            who.append(np.array([text]))
        return np.concatenate(out) >> np.uint64(1), np.concatenate(who)

    def sets(self, texts: list[bytes], heavy: np.ndarray | None = None):
        """(gram, text, first position of each text, size of each text's set): sorted by text, then rarest first."""
        gram, owner = self.grams(texts)
        if heavy is not None and len(heavy[0]):
            values, rank = heavy
            at = np.minimum(np.searchsorted(values, gram), len(values) - 1)
            found = values[at] == gram
            gram = np.where(found, HEAVY_BIT | rank[at], gram)
        order = np.argsort(gram)
        small = owner.astype(np.int16) if len(texts) < 32_000 else owner
        order = order[np.argsort(small[order], kind="stable")]
        gram, owner = gram[order], owner[order]
        new = np.ones(len(gram), dtype=bool)
        new[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
        gram, owner = gram[new], owner[new]
        size = np.bincount(owner, minlength=len(texts)).astype(np.int64)
        first = np.concatenate([[0], np.cumsum(size)[:-1]])
        return gram, owner, first, size


def set_keys(gram: np.ndarray, owner: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set, whatever the order of its grams."""
    total = np.zeros(len(size), dtype=np.uint64)
    np.add.at(total, owner, mix(gram + np.uint64(0x5851F42D4C957F2D)))
    return mix(total + size.astype(np.uint64)).view(np.int64)


#: Pivots that every set is measured against: the universe of grams dealt to so many classes, or a power of two
#: times as many for a set of more than CLASSES * PER_CLASS grams, since the counts of large sets differ too little by chance.
CLASSES, PER_CLASS = 128, 16


def class_levels(size: np.ndarray) -> np.ndarray:
    """A set of ``size`` grams is counted over CLASSES * 2 ** level classes."""
    return np.ceil(np.log2(np.maximum(size / (CLASSES * PER_CLASS), 1))).astype(np.int64)


def class_counts(gram: np.ndarray, owner: np.ndarray, size: np.ndarray) -> list[bytes]:
    """Per text, how many of its grams lie in each class, as the shortest unsigned integers that hold them.

    The symmetric difference of a set and a class is a metric whose only unknown is this
    count, so by the triangle inequality the counts of two sets differ, summed over the
    classes, by no more than the sets do.
    """
    out: list[bytes] = [b""] * len(size)
    level, spread = class_levels(size), mix(gram + np.uint64(17))
    for k in np.unique(level).tolist():
        texts, width = np.flatnonzero(level == k), CLASSES << k
        number = np.full(len(size), -1)
        number[texts] = np.arange(len(texts))
        use = number[owner] >= 0
        place = number[owner[use]] * width + (spread[use] % np.uint64(width)).astype(np.int64)
        for text, row in zip(texts.tolist(), np.bincount(place, minlength=len(texts) * width).reshape(-1, width)):
            out[text] = row.astype(np.min_scalar_type(row.max())).tobytes()
    return out


class Profiles:
    """Class counts of sets, by level: finer counts of a larger set add up to the coarser ones of a smaller."""

    def __init__(self, size: np.ndarray, counts: list[bytes]) -> None:
        self.level = class_levels(size)
        own = [np.frombuffer(c, dtype=f"u{len(c) // (CLASSES << k)}").astype(np.int32) for c, k in zip(counts, self.level.tolist())]
        self.row, self.table = {}, {}
        for k in np.unique(self.level).tolist():
            sets = np.flatnonzero(self.level >= k)
            self.row[k] = np.zeros(len(own), np.int64)
            self.row[k][sets] = np.arange(len(sets))
            self.table[k] = np.stack([own[x].reshape(-1, CLASSES << k).sum(axis=0, dtype=np.int32) for x in sets.tolist()])

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Sum over the classes of how far the counts of sets a and b differ, over the classes of the smaller set."""
        out, level = np.zeros(len(a), np.int64), np.minimum(self.level[a], self.level[b])
        for k in np.unique(level).tolist():
            at, row, table = np.flatnonzero(level == k), self.row[k], self.table[k]
            step = max(1, (2 << 20) // (CLASSES << k))
            for begin in range(0, len(at), step):
                part = at[begin : begin + step]
                out[part] = np.abs(table[row[a[part]]] - table[row[b[part]]]).sum(axis=1)
        return out


def _texts(batch: pa.RecordBatch, name: str = "body") -> list[bytes]:
    return batch.column(name).to_pylist()


def _body(df: DataFrame, text: str):
    return F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body")


def _frequent(df: DataFrame, text: str, rules: Join) -> tuple[np.ndarray, np.ndarray, int]:
    """Frequent n-grams, their rank (rarer first), and the number of n-grams: counted over all documents.

    A slice reports what it holds eight times or more; reports are added up. The list is
    bounded by ``ordered`` and decides only in which order grams are looked at.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(rules.words)
        for batch in batches:
            texts = _texts(batch)
            for begin, end in slices(texts, rules.slice_bytes):
                gram, owner, _, _ = shingler.sets(texts[begin:end])
                order = np.sort(gram)
                edges = np.flatnonzero(np.concatenate([[True], order[1:] != order[:-1]])) if len(order) else np.zeros(0, int)
                times = np.diff(np.append(edges, len(order)))
                often = times >= 8
                grams = np.append(order[edges][often].view(np.int64), np.int64(-1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams), pa.array(np.append(times[often], len(gram)).astype(np.int64))], ["gram", "n"]
                )

    found = df.select(_body(df, text)).mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    found = materialise(found, "frequent")
    total = found.filter("gram = -1").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    top = found.filter("gram >= 0 and n >= 32").orderBy(F.desc("n"), "gram").limit(rules.ordered).toPandas()
    discard(found)
    values = top["gram"].to_numpy(dtype=np.int64).view(np.uint64)
    rank = np.arange(len(values), 0, -1, dtype=np.uint64)
    order = np.argsort(values)
    return values[order], rank[order], int(total)


def _prefix(size: np.ndarray, percent: int) -> np.ndarray:
    """How many of its first grams a set must look at to meet every set that links with it."""
    return np.where(size > 0, size - -(-percent * size // 100) + 1, 0)


def _scan(df: DataFrame, key: str, text: str, rules: Join, heavy, buckets: int) -> DataFrame:
    """One pass: a row (key, set_key, n) per document, and per slice and bucket the first grams of its sets."""
    kind = df.schema[key].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(rules.words)
        names = ["key", "set_key", "n", "classes", "bucket", "grams", "sets", "sizes", "places"]
        for batch in batches:
            texts = _texts(batch)
            for begin, end in slices(texts, rules.slice_bytes):
                gram, owner, first, size = shingler.sets(texts[begin:end], heavy)
                keys = set_keys(gram, owner, size)
                count, none = end - begin, lambda n: pa.nulls(n, pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(begin, count), pa.array(keys), pa.array(size), pa.array(class_counts(gram, owner, size), pa.binary()),
                     pa.array(np.full(count, -1, np.int32)),
                     none(count), none(count), none(count), none(count)], names,
                )
                _, once = np.unique(keys, return_index=True)  # copies within a slice are looked at once
                alone = np.zeros(count, dtype=bool)
                alone[once] = True
                place = np.arange(len(gram)) - first[owner]
                use = alone[owner] & (place < _prefix(size, rules.percent)[owner])
                gram, owner, place = gram[use], owner[use], place[use].astype(np.int32)
                bucket = (mix(gram) % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                gram, owner, place, bucket = gram[order], owner[order], place[order], bucket[order]
                edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else []
                rows = [(int(bucket[a]), a, b) for a, b in zip(edges, np.append(edges[1:], len(bucket)).astype(int))] if len(bucket) else []
                if rows:
                    cut = lambda x: pa.array([x[a:b].tobytes() for _, a, b in rows], pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(len(rows), batch.schema.field("key").type), pa.nulls(len(rows), pa.int64()), pa.nulls(len(rows), pa.int64()), pa.nulls(len(rows), pa.binary()),
                         pa.array([r[0] for r in rows], pa.int32()), cut(gram), cut(keys[owner]), cut(size[owner].astype(np.int32)), cut(place)],
                        names,
                    )

    schema = f"key {kind}, set_key long, n long, classes binary, bucket int, grams binary, sets binary, sizes binary, places binary"
    return df.select(F.col(key).alias("key"), _body(df, text)).mapInArrow(scan, schema)


# --- regions of documents that may link -------------------------------------------------


def _reach(size: np.ndarray, place: np.ndarray, percent: int) -> np.ndarray:
    """Largest partner size with which a set can link if its first common gram stands at ``place``."""
    return (size - place) * (100 + percent) // percent - size


def _partnered(size: np.ndarray, reach: np.ndarray, percent: int) -> np.ndarray:
    """Members of one gram's list (sorted by size) for which some other member passes the size and place bounds.

    y is within bounds of x if size_y lies in [percent * size_x / 100, reach_x] and
    size_x <= reach_y: a range maximum of reach over a run of sizes, by doubling tables.
    """
    m = len(size)
    low = np.searchsorted(size, -(-percent * size // 100), side="left")
    high = np.searchsorted(size, np.minimum(reach, size * 100 // percent), side="right")
    tables = [reach]
    while 2 ** len(tables) <= m:
        half = 2 ** (len(tables) - 1)
        tables.append(np.maximum(tables[-1][:-half], tables[-1][half:]))
    best = np.full(m, -1, dtype=np.int64)
    here = np.arange(m)
    for a, b in ((low, np.minimum(high, here)), (np.maximum(low, here + 1), high)):
        span = b - a
        level = np.where(span > 0, np.int64(np.log2(np.maximum(span, 1)) + 1e-9), 0)
        for k in np.unique(level[span > 0]):
            rows = np.flatnonzero((span > 0) & (level == k))
            top = np.maximum(tables[k][a[rows]], tables[k][b[rows] - 2**k])
            best[rows] = np.maximum(best[rows], top)
    return best >= size


def bucket_members(grams: np.ndarray, sets: np.ndarray, sizes: np.ndarray, places: np.ndarray, percent: int) -> pd.DataFrame:
    """(gram, node, n, place) for the sets that share a first gram with a set within the bounds of size and place."""
    order = np.lexsort((sets, sizes, grams))
    grams, sets, sizes, places = grams[order], sets[order], sizes[order].astype(np.int64), places[order].astype(np.int64)
    keep = np.ones(len(grams), dtype=bool)
    keep[1:] = (grams[1:] != grams[:-1]) | (sets[1:] != sets[:-1])
    grams, sets, sizes, places = grams[keep], sets[keep], sizes[keep], places[keep]
    first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])) if len(grams) else np.zeros(0, np.int64)
    length = np.diff(np.append(first, len(grams)))
    reach = _reach(sizes, places, percent)
    use = np.zeros(len(grams), dtype=bool)
    two = first[length == 2]
    fit = two[(100 * sizes[two] >= percent * sizes[two + 1]) & (sizes[two + 1] <= reach[two]) & (sizes[two] <= reach[two + 1])]
    use[fit] = use[fit + 1] = True
    for at, n in zip(first[length > 2].tolist(), length[length > 2].tolist()):
        use[at : at + n] = _partnered(sizes[at : at + n], reach[at : at + n], percent)
    return pd.DataFrame({"gram": grams[use].view(np.int64), "node": sets[use], "n": sizes[use], "place": places[use]})


def near_in_cell(size: np.ndarray, reach: np.ndarray, profiles: Profiles, member: np.ndarray, lead: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs of one gram's sets that connect all pairs (with a leading set) which the bounds let pass."""
    parent = list(range(len(size)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    found = []
    for x in np.flatnonzero(lead).tolist():
        near = (size <= reach[x]) & (size[x] <= reach)
        near[x] = False
        rows = np.flatnonzero(near)
        apart = profiles.apart(np.full(len(rows), member[x]), member[rows])
        for y in rows[apart * (100 + percent) <= (100 - percent) * (size[rows] + size[x])].tolist():
            a, b = find(x), find(y)
            if a != b:
                parent[a] = b
                found.append((x, y))
    return found


def _candidate_edges(blobs: DataFrame, docs: DataFrame, rules: Join) -> DataFrame:
    """(a, b) pairs of sets that connect all pairs which may be similar.

    Sets that share a first gram meet in its cell. A pair passes if size, place and the
    distances to the class pivots allow it: by the triangle inequality no similar pair is
    lost. Cells of more than ``2 * region`` sets are compared block by block.
    """

    def meet(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        whole = lambda name, kind: np.frombuffer(b"".join(rows[name]), dtype=kind)
        return bucket_members(whole("grams", np.uint64), whole("sets", np.int64), whole("sizes", np.int32), whole("places", np.int32), rules.percent)

    met = materialise(blobs.groupBy("bucket").applyInPandas(meet, "gram long, node long, n long, place long"), "cells")
    counts = docs.filter("n > 0").groupBy("set_key").agg(F.first("classes").alias("classes"))
    most = 2 * rules.region
    large = met.groupBy("gram").agg(F.ceil(F.count("*") / rules.region).cast("int").alias("blocks")).filter(F.col("blocks") > most // rules.region)
    large = materialise(large.withColumnRenamed("gram", "cell"), "large-cells")
    rows = met.join(counts, F.col("node") == F.col("set_key")).select("gram", "node", "n", "place", "classes")
    rows = rows.join(large, F.col("gram") == F.col("cell"), "left")
    block = F.pmod(F.xxhash64("node"), "blocks").cast("int")
    each = F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1)))
    own = F.coalesce(block, F.lit(0))
    leads = rows.select("*", own.alias("i"), each.alias("j"), F.lit(True).alias("lead"))
    others = rows.filter("blocks is not null").select("*", each.alias("i"), own.alias("j"), F.lit(False).alias("lead"))
    groups = max(1, met.count() // 10_000)
    dealt = leads.unionByName(others).withColumn("g", F.when(F.col("blocks").isNull(), F.pmod(F.xxhash64("gram"), F.lit(groups))).otherwise(F.xxhash64("gram", "i", "j")))

    def compare(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["gram", "i", "j", "lead", "node"], ascending=[True, True, True, False, True]).drop_duplicates(["gram", "i", "j", "node"])
        node, size, place = (pdf[c].to_numpy(dtype=np.int64) for c in ("node", "n", "place"))
        gram, lead = pdf["gram"].to_numpy(dtype=np.int64), pdf["lead"].to_numpy(dtype=bool)
        _, one, member = np.unique(node, return_index=True, return_inverse=True)
        profiles = Profiles(size[one], pdf["classes"].iloc[one].tolist())
        reach = _reach(size, place, rules.percent)
        first = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
        length = np.diff(np.append(first, len(gram)))
        two = first[length == 2]
        apart = profiles.apart(member[two], member[two + 1])
        fit = (size[two] <= reach[two + 1]) & (size[two + 1] <= reach[two]) & (lead[two] | lead[two + 1])
        two = two[fit & (apart * (100 + rules.percent) <= (100 - rules.percent) * (size[two] + size[two + 1]))]
        out = [np.stack([node[two], node[two + 1]])]
        for at, n in zip(first[length > 2].tolist(), length[length > 2].tolist()):
            part = slice(at, at + n)
            found = near_in_cell(size[part], reach[part], profiles, member[part], lead[part], rules.percent)
            if found:
                out.append(node[part][np.array(found).T])
        pairs = np.sort(np.concatenate(out, axis=1), axis=0)
        pairs = np.unique(pairs, axis=1)
        return pd.DataFrame({"a": pairs[0], "b": pairs[1]})

    compared = dealt.select("g", "gram", "i", "j", "node", "n", "place", "classes", "lead").groupBy("g").applyInPandas(compare, "a long, b long")
    edges = materialise(compared.distinct(), "edges")
    discard(met, large)
    return edges


# --- joining regions ----------------------------------------------------------------------


_PIECE = 500_000


def _pieces(sets: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """The sets (in order, as unsigned numbers) cut into ranges of about ``_PIECE`` grams, the same ranges for all sets."""
    sets = [np.asarray(s, dtype=np.int64).view(np.uint64) for s in sets]
    count = max(1, sum(map(len, sets)) // _PIECE)
    some = np.sort(np.concatenate([s[:: max(1, len(s) // (4 * count))] for s in sets]))
    bounds = some[np.arange(1, count) * len(some) // count] if count > 1 else some[:0]
    cuts = [[0, *np.searchsorted(s, bounds).tolist(), len(s)] for s in sets]
    for k in range(count):
        yield [s[cut[k] : cut[k + 1]] for s, cut in zip(sets, cuts)]


def region_links(sets: list[np.ndarray], active: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that connect whatever the similar pairs of one region connect; pairs of two passive sets are left out."""
    n, size = len(sets), np.array([len(s) for s in sets])
    lead = np.flatnonzero(active)
    if not len(lead) or n < 2:
        return []
    common = np.zeros((len(lead), n), dtype=np.float32)
    width = max(1, (8 << 20) // n)
    for part in _pieces(sets):
        # Sets as rows of zeros and ones over the grams that at least two of them have.
        _, code, times = np.unique(np.concatenate(part), return_inverse=True, return_counts=True)
        shared = times > 1
        column, columns = np.cumsum(shared) - 1, int(shared.sum())
        use = shared[code]
        owner, code = np.repeat(np.arange(n), [len(s) for s in part])[use], column[code[use]]
        order = np.argsort(code, kind="stable")
        owner, code = owner[order], code[order]
        for begin in range(0, columns, width):
            a, b = np.searchsorted(code, [begin, begin + width])
            table = np.zeros((n, min(width, columns - begin)), dtype=np.float32)
            table[owner[a:b], code[a:b] - begin] = 1
            common += table[lead] @ table.T
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    found = []
    for k, x in enumerate(lead.tolist()):
        shared_with = np.rint(common[k]).astype(np.int64)
        for y in np.flatnonzero(100 * shared_with >= percent * (size[x] + size - shared_with)).tolist():
            a, b = find(x), find(y)
            if a != b:
                parent[a] = b
                found.append((x, y))
    return found


def _join_groups(members: DataFrame, percent: int) -> DataFrame:
    """(a, b) links of rows (g, region, node, active, items): a task takes a group, which holds whole regions."""

    def join(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in rows.groupby("region", sort=False):
            part = part.sort_values(["active", "node"], ascending=False).drop_duplicates("node")
            nodes = part["node"].to_numpy()
            links = region_links(part["items"].tolist(), part["active"].to_numpy(), percent)
            out.extend((nodes[x], nodes[y]) for x, y in links)
        return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

    return members.groupBy("g").applyInPandas(join, "a long, b long")


def _whole(members: DataFrame, rules: Join) -> DataFrame:
    """Links of regions small enough for one task; many of them share one."""
    groups = max(1, members.count() // (4 * rules.region))
    return _join_groups(members.withColumn("g", F.pmod(F.xxhash64("region"), F.lit(groups))), rules.percent)


def _blocks(members: DataFrame, rules: Join) -> DataFrame:
    """Links of regions that no pivot splits: each block of active sets against each block of members, one task a pair.

    Blocks are hash ranges of at most about 2 * ``region`` sets and ``block_grams`` n-grams, so
    long documents don't swell a task; a block of active sets travels once per block of members and the other way round.
    """
    half = 2 * rules.region
    grams = F.size("items")

    def blocks(count, total):
        return F.greatest(F.ceil(count / half), F.ceil(total / rules.block_grams)).cast("int")

    sizes = members.groupBy("region").agg(
        blocks(F.sum(F.col("active").cast("int")), F.sum(F.when(F.col("active"), grams).otherwise(0))).alias("leads"),
        blocks(F.count("*"), F.sum(grams)).alias("blocks"),
    ).filter("leads > 0")
    sized = members.join(sizes, "region")
    draw = F.xxhash64("node", F.lit(3))
    lead, block = F.pmod(draw, "leads").cast("int"), F.pmod(draw, "blocks").cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    first = sized.filter("active").withColumn("i", lead).withColumn("j", each("blocks"))
    second = sized.withColumn("j", block).withColumn("i", each("leads")).withColumn("active", F.lit(False))
    rows = first.unionByName(second).withColumn("g", F.xxhash64("region", "i", "j"))
    return _join_groups(rows.select("g", "region", "node", "active", "items"), rules.percent)


def _split(large: DataFrame, rules: Join, level: int) -> tuple[DataFrame, DataFrame]:
    """(links found, members of the regions that large regions fall into).

    ``pivots`` active sets of each region, those of smallest seeded hash, are compared with
    all its members. Members of a pivot's ball (distance e or less) link with it. Those in
    the largest ball are connected by that, so they turn passive, unless a passive set
    outside of the ball may be within e: from now on only pairs with a set outside of the
    ball count. By the triangle inequality a passive set can be dropped if its distance to
    that pivot is not within e of that of any active set.

    The rest is dealt to the pivots' Voronoi regions. A set is active where its pivot is
    nearest. If x, nearest pivot at distance d, links with y in the region of pivot q, then
    d(x, q) <= d + 2e; so x is replicated, passive, to the pivots in that window and to no
    other. A region stays whole if its windows would replicate its sets more than twice.
    """
    e = 1 - rules.percent / 100 + 1e-9
    order = Window.partitionBy("region").orderBy("rank", "node")
    ranked = large.filter("active").select("region", "node", F.xxhash64("node", F.lit(level)).alias("rank"))
    chosen = ranked.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= rules.pivots).select("region", "node")
    pivots = materialise(
        chosen.join(large, ["region", "node"]).select("region", F.col("node").alias("pivot"), F.col("items").alias("other")), "pivots"
    )
    common = F.size(F.array_intersect("items", "other"))
    distance = 1 - common / (F.size("items") + F.size("other") - common)
    near = large.join(pivots, "region").select("region", "node", "active", "pivot", distance.alias("d"))
    near = materialise(near, "near")
    links = near.filter(F.col("d") <= e).select(F.col("node").alias("a"), F.col("pivot").alias("b"))
    balls = near.groupBy("region", "pivot").agg(F.sum((F.col("d") <= e).cast("int")).alias("inside"))
    balls = balls.groupBy("region").agg(F.max_by("pivot", F.struct("inside", "pivot")).alias("ball"))
    main = near.join(balls, "region").filter(F.col("pivot") == F.col("ball")).select("region", "node", "active", F.col("d").alias("at"))
    main = materialise(main, "main")
    # A set in the ball still has to meet the passive sets outside of it that may be within e.
    outside = main.filter(~F.col("active") & (F.col("at") > e)).groupBy("region").agg(F.min("at").alias("outer"))
    open_ = (F.col("at") > e) | F.coalesce(F.col("at") >= F.col("outer") - e, F.lit(False))
    main = main.join(outside, "region", "left").select("region", "node", (F.col("active") & open_).alias("active"), "at")
    rings = main.filter("active").groupBy("region").agg(F.min("at").alias("low"), F.max("at").alias("high"))
    left = main.join(rings, "region").filter(F.col("active") | F.col("at").between(F.col("low") - e, F.col("high") + e))
    left = materialise(left.select("region", "node", "active"), "left")
    to = near.select("region", "node", "pivot", "d").join(left, ["region", "node"]).groupBy("region", "node").agg(
        F.max("active").alias("active"), F.array_sort(F.collect_list(F.struct("d", "pivot"))).alias("to")
    )
    windows = F.filter("to", lambda t: t["d"] <= F.col("to")[0]["d"] + 2 * e)
    to = materialise(to.select("region", "node", "active", F.col("to")[0]["pivot"].alias("own"), windows.alias("to")), "windows")
    whole = to.groupBy("region").agg((F.sum(F.size("to")) > 2 * F.count("*")).alias("whole"))
    dealt = to.join(whole, "region").select(
        "region", "node", "active", "own", "whole", F.explode(F.when(F.col("whole"), F.array("own")).otherwise(F.col("to.pivot"))).alias("pivot")
    )
    dealt = dealt.select(
        "region", "node",
        F.when(F.col("whole"), F.col("region")).otherwise(F.xxhash64("region", "pivot")).alias("inner"),
        (F.col("active") & (F.col("whole") | (F.col("pivot") == F.col("own")))).alias("active"),
        "whole",
    )
    joined = dealt.join(large.select("region", "node", "items"), ["region", "node"])
    return links, joined.select(F.col("inner").alias("region"), "node", "active", "items", "whole")


def _regions_join(members: DataFrame, rules: Join) -> DataFrame:
    """All links needed to connect similar sets, region by region: (a, b)."""
    found: list[DataFrame] = []
    members = materialise(members.withColumn("whole", F.lit(False)), "members")
    for level in range(rules.depth + 1):
        sizes = members.groupBy("region").agg(F.count("*").alias("n"), F.max("whole").alias("stay"))
        many = materialise(sizes.filter(F.col("n") > rules.region).select(F.col("region").alias("r"), "stay"), "sizes")
        small = members.join(many, F.col("region") == F.col("r"), "left_anti").select("region", "node", "active", "items")
        found.append(materialise(_whole(small, rules), "found"))
        large = members.join(many, F.col("region") == F.col("r")).select("region", "node", "active", "items", "stay")
        if large.isEmpty():
            break
        large = materialise(large, "large")
        last = level == rules.depth
        stay = large if last else large.filter("stay")
        found.append(materialise(_blocks(stay.drop("stay"), rules), "found"))
        if last:
            break
        split = large.filter(~F.col("stay")).drop("stay")
        if split.isEmpty():
            break
        links, members = _split(split, rules, level)
        found.append(materialise(links, "found"))
        members = materialise(members, "members")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _members_of(df: DataFrame, nodes: DataFrame, key: str, text: str, rules: Join, heavy) -> DataFrame:
    """(region, node, active, items): the n-grams of the documents named by ``nodes`` (node, region, rep).

    Sets are computed again from those texts instead of being kept for all documents. The
    two lookups are 16 bytes a row: broadcast up to 500,000 rows, beyond that both sides are
    shuffled. Rows that repeat a document repeat its node.
    """
    few = nodes.count() <= 500_000
    side = F.broadcast if few else (lambda rows: rows)
    names = nodes.select(F.col("rep").alias("_rep")).distinct()
    bodies = df.select(F.col(key).alias("key"), _body(df, text)).join(side(names), F.col("key").eqNullSafe(F.col("_rep")), "left_semi")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(rules.words)
        for batch in batches:
            texts = _texts(batch)
            for begin, end in slices(texts, rules.slice_bytes // 4):
                gram, owner, first, size = shingler.sets(texts[begin:end], heavy)
                items = pa.ListArray.from_arrays(pa.array(np.append(first, len(gram)).astype(np.int32)), pa.array(gram.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(set_keys(gram, owner, size)), items], ["node", "items"])

    found = bodies.select("body").mapInArrow(sets, "node long, items array<long>")
    places = nodes.select(F.col("node").alias("_node"), "region")
    return found.join(side(places), F.col("node") == F.col("_node")).select("region", "node", F.lit(True).alias("active"), "items")


def near_duplicates(df: DataFrame, rules: Join = Join(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: the key, ``n_shingles`` and ``component_id``, the smallest key reachable by links.

    A text's set holds its distinct n-grams of words (A-Z lowered); a text of fewer words is
    one gram; null, empty and blank texts have no set and link with nothing. Sets link at
    ``percent`` Jaccard similarity or more. Equal texts, repeated rows included, share a set
    and a component. Null keys count as largest: a component of null keys only is null. Extra columns are not read; an empty
    table gives an empty table. Grams and sets are told apart by 63 and 64 bit hashes.

    1. Equal sets become one node. 2. Sets whose first grams (rarest first) meet, within
    bounds of size, place and distance to the class pivots, form regions: no link crosses
    a region. 3. Regions are joined
    exactly, large ones by pivots and triangle-inequality windows, recursively. 4. Links
    are connected. Lists, regions and links are never collected: what a task holds is
    bounded by a slice, a bucket of grams or ``region`` sets.
    """
    values, rank, total = _frequent(df, text, rules)
    buckets = max(8, total * (100 - rules.percent) // 100 // rules.bucket_grams + 1)
    scanned = materialise(_scan(df, key, text, rules, (values, rank), buckets), "grams")
    counted = scanned.filter("bucket < 0").select("set_key", "n", "classes")
    edges = _candidate_edges(scanned.filter("bucket >= 0").drop("key", "set_key", "n", "classes"), counted, rules)
    docs = materialise(scanned.filter("bucket < 0").select("key", "set_key", "n"), "sets")
    discard(scanned)
    regions = components(edges)
    classes = docs.filter("n > 0").groupBy("set_key").agg(F.min("key").alias("rep"))
    nodes = materialise(
        regions.join(classes, F.col("node") == F.col("set_key")).select("node", F.col("root").alias("region"), "rep"), "nodes"
    )
    members = _members_of(df, nodes, key, text, rules, (values, rank))
    joined = materialise(components(_regions_join(members, rules)), "joined")
    known = classes.join(joined, F.col("set_key") == F.col("node"), "left").select(
        "set_key", "rep", F.coalesce("root", "set_key").alias("root")
    )
    known = materialise(known, "known")
    lowest = known.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = materialise(known.join(lowest, "root").select(F.col("set_key").alias("name"), "component_id"), "named")
    out = docs.join(named, (F.col("set_key") == F.col("name")) & (F.col("n") > 0), "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key"))
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), own.alias("component_id"))


def keep_one_of_each(df: DataFrame, rules: Join = Join(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` left when of each group of near copies the one with the smallest key (null last) stays.

    All columns stay. Rows are told apart by key and text; of rows that repeat both, one
    stays. Rows without words belong to no group and all stay.
    """
    name = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text"))
    keyed = carried(df, key, text).withColumn("_name", name)
    near = near_duplicates(keyed.select("_name", F.col(text).alias("_text")), rules, "_name", "_text")
    alike = F.col("_name").eqNullSafe(F.col("component_id"))
    stays = near.filter(alike | (F.col("n_shingles") == 0)).groupBy("_name").agg(F.count("*").alias("_n"), F.max("n_shingles").alias("_size"))
    stays = materialise(stays, "stays").withColumnRenamed("_name", "_stay")
    rows = keyed.join(stays, F.col("_name").eqNullSafe(F.col("_stay")))
    single = (F.col("_n") == 1) | (F.col("_size") == 0)
    order = Window.partitionBy("_name").orderBy("_n")
    several = rows.filter(~single).withColumn("_k", F.row_number().over(order)).filter(F.col("_k") == 1)
    back = restored(rows, df.columns, (key, text))
    return rows.filter(single).select(*back).unionByName(several.select(*back))
