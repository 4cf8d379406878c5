"""Near duplicates among embeddings: int8 tile products with rigorous error bounds, full precision only where they leave doubt."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from txnlytics.llm.components import components
from txnlytics.session import materialise


@dataclass(frozen=True)
class Near:
    """Vectors link at a cosine of ``cosine`` or more (above 0).

    A block has about ``block_values`` components (so its bytes are bounded), a tile ``tile``
    vectors, and ``chunk`` doubtful pairs are recomputed at once.
    """

    cosine: float = 0.95
    block_values: int = 1 << 21
    least_block: int = 1 << 17
    tile: int = 1024
    chunk: int = 1 << 14

    def __post_init__(self) -> None:
        if not 0 < self.cosine <= 1:
            raise ValueError("the cosine must be above 0, at most 1")


# --- quantised vectors ------------------------------------------------------------------

_LEVELS = 127
_EXACT_FLOAT = (1 << 24) // (_LEVELS * _LEVELS)  # dimensions whose integer products a float32 holds exactly
#: Room for the rounding of the bounds' own arithmetic in float32 and float64.
_SLACK = 1e-5


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, scale, error) of non-zero finite vectors: x / |x| is within ``error`` (Euclidean) of codes * scale."""
    unit = x / np.abs(x).max(axis=1, keepdims=True)
    unit /= np.sqrt(np.einsum("ij,ij->i", unit, unit))[:, None]
    scale = np.abs(unit).max(axis=1) / _LEVELS
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    rest = unit - codes * scale[:, None]
    return codes, scale, np.sqrt(np.einsum("ij,ij->i", rest, rest)) + 1e-12


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``x`` with the same row of ``y``, in double precision; the scale of a vector does not matter."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    y = y / np.abs(y).max(axis=1, keepdims=True)
    dot = np.einsum("ij,ij->i", x, y)
    return dot / (np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y)))


class Side:
    """The quantised rows of one block."""

    def __init__(self, full: np.ndarray) -> None:
        self.full = full
        codes, self.scale, self.error = quantise(full)
        # Codes are small integers: their products are exact in the float type chosen here.
        self.codes = codes.astype(np.float32 if full.shape[1] <= _EXACT_FLOAT else np.float64)

    def __len__(self) -> int:
        return len(self.full)


def tile_links(a: Side, b: Side, same: bool, rules: Near) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of ``a``, rows of ``b``) that link, tile by tile; within one block (``same``) each pair once.

    With x = s q + e, the cosine of two unit vectors exceeds s s' (q . q') by at most
    |e| + (1 + |e|) |e'|. Where that stays below the threshold the pair can't link; all
    others are computed again from the full vectors.
    """
    for i in range(0, len(a), rules.tile):
        rows = slice(i, i + rules.tile)
        worst = a.error[rows].max()
        for j in range(i if same else 0, len(b), rules.tile):
            columns = slice(j, j + rules.tile)
            product = a.codes[rows] @ b.codes[columns].T
            product *= a.scale[rows, None].astype(product.dtype)
            bound = (rules.cosine - _SLACK - worst - (1 + worst) * b.error[columns]) / b.scale[columns]
            x, y = np.nonzero(product >= bound[None, :].astype(product.dtype))
            x, y = x + i, y + j
            if same:
                x, y = x[x < y], y[x < y]
            for k in range(0, len(x), rules.chunk):
                p, q = x[k : k + rules.chunk], y[k : k + rules.chunk]
                near = cosines(a.full[p], b.full[q]) >= rules.cosine
                if near.any():
                    yield p[near], q[near]


def unite(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Joins the classes of x[k] and y[k]; a class's label is its smallest row."""
    while True:
        a, b = label[x], label[y]
        if (a == b).all():
            return
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not (label[label] == label).all():
            label[:] = label[label]


# --- tables -----------------------------------------------------------------------------


def _compare(rules: Near):
    """Arrow step over the rows of two blocks: link counts per vector and edges that span the classes found."""

    def compare(table: pa.Table) -> pa.Table:
        # Sorted, so that the result does not depend on the order in which rows arrive.
        table = table.combine_chunks().sort_by("ent")
        first = table.column("block").to_numpy() == table.column("lo")[0].as_py()
        ent, copies = table.column("ent").to_numpy(), table.column("copies").to_numpy()
        dim = table.column("dim")[0].as_py()
        flat = table.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dim).astype(np.float64)
        same = table.column("lo")[0].as_py() == table.column("hi")[0].as_py()
        left = np.flatnonzero(first)
        right = left if same else np.flatnonzero(~first)
        links, label = np.zeros(len(ent), dtype=np.int64), np.arange(len(ent))
        if len(left) and len(right):
            a = Side(flat[left])
            b = a if same else Side(flat[right])
            for x, y in tile_links(a, b, same, rules):
                p, q = left[x], right[y]
                np.add.at(links, p, copies[q])
                np.add.at(links, q, copies[p])
                unite(label, p, q)
        counted, moved = np.flatnonzero(links), np.flatnonzero(label != np.arange(len(ent)))
        return pa.table({
            "a": np.concatenate([ent[counted], ent[moved]]),
            "b": pa.array(np.concatenate([np.zeros(len(counted), np.int64), ent[label[moved]]]), mask=np.arange(len(counted) + len(moved)) < len(counted)),
            "n": np.concatenate([links[counted], np.zeros(len(moved), np.int64)]),
        })

    return compare


def near_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", rules: Near = Near()) -> DataFrame:
    """One row (key, n_links, component_id, kept) per row of ``df``; links are exact.

    ``n_links`` counts the other rows at a cosine of ``rules.cosine`` or more, ``component_id``
    is the smallest key reached by links, the row's own included, and ``kept`` tells the rows
    that bear it. Equal vectors are one vector with a count. Distinct ones are dealt to
    blocks by hash; each pair of blocks is one task of bounded size, which compares tiles of
    int8 codes and sends on counts per vector and the edges of a spanning forest, never pairs:
    a group of n near copies costs n rows for each block it meets.

    Vectors that are null, empty, zero or hold null or non-finite components link with
    nothing (their component is their own key). Vectors of different lengths do not link.
    Null keys are passed over for the smallest key unless a group has no other; rows with a
    null or repeated key are rows of their own. Columns of ``df`` other than the two are not
    looked at, so their names can't clash. An empty table gives an empty table.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("key"), F.col(vector).alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False))
    judged = rows.withColumn("usable", usable)
    distinct = materialise(
        judged.filter("usable").groupBy("v").agg(F.count("*").alias("copies"), F.min("key").alias("low"))
        .withColumn("dim", F.size("v")).withColumn("ent", F.monotonically_increasing_id()),
        "vectors",
    )

    # Blocks follow the number of vectors; a small table is cut finer, so that no core is idle.
    sizes = materialise(distinct.groupBy("dim").agg(F.count("*").alias("vectors")), "vector-sizes")
    cores = spark.sparkContext.defaultParallelism
    values = F.col("vectors") * F.col("dim")
    blocks = F.greatest(
        F.ceil(values / rules.block_values), F.least(F.ceil(values / rules.least_block), F.lit(int((2 * cores) ** 0.5) + 1))
    )
    dealt = distinct.join(sizes, "dim").withColumn("blocks", blocks.cast("int"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("ent"), "blocks").cast("int"))
    met = dealt.select(
        "ent", "copies", "dim", "v", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ).select(
        "ent", "copies", "dim", "v", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")
    )
    found = materialise(met.groupBy("dim", "lo", "hi").applyInArrow(_compare(rules), "a long, b long, n long"), "vector-links")

    counts = found.filter(F.col("b").isNull()).groupBy(F.col("a").alias("ent")).agg(F.sum("n").alias("others"))
    roots = components(found.filter(F.col("b").isNotNull()).select("a", "b"))
    grouped = distinct.drop("dim").join(roots.withColumnRenamed("node", "ent"), "ent", "left").withColumn("root", F.coalesce("root", "ent"))
    grouped = materialise(grouped.join(counts, "ent", "left"), "vector-groups")
    lowest = grouped.groupBy("root").agg(F.min("low").alias("component"))
    classes = grouped.join(lowest, "root").select(
        "v", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("links"), "component"
    )
    linked = judged.filter("usable").join(classes, "v").select("key", "links", "component")
    alone = judged.filter(~F.col("usable")).select("key", F.lit(0).cast("long").alias("links"), F.col("key").alias("component"))
    return linked.unionByName(alone).select(
        F.col("key").alias(key), F.col("links").alias("n_links"), F.col("component").alias("component_id"),
        F.col("key").eqNullSafe(F.col("component")).alias("kept"),
    )
