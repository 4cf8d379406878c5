"""Connected components of a large graph, without collecting links or groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from txnlytics.session import discard, materialise


def components(links: DataFrame) -> DataFrame:
    """(a, b) links -> (node, root): the smallest node that each linked node reaches.

    Alternating large-star and small-star rounds: a node hands its larger, then its
    smaller neighbours to the smallest one it knows, which halves path lengths. Minima are
    pre-aggregated, so a node with very many links costs one row per task; the join of a
    node's links with its minimum is one that adaptive execution can split. Rounds end when
    every link points at a node that has no smaller one, so stars are the only shape left.
    """
    edges = materialise(
        links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).distinct(),
        "links",
    )
    while True:
        both = edges.unionByName(edges.select(F.col("m").alias("v"), F.col("v").alias("m")))
        least = both.groupBy("v").agg(F.min("m").alias("low")).select(
            F.col("v").alias("u"), F.least("low", "v").alias("low")
        )
        # Larger neighbours (and the node itself) now point at the smallest one known.
        large = (
            both.join(least, F.col("v") == F.col("u"))
            .filter((F.col("m") > F.col("v")) & (F.col("m") != F.col("low")))
            .select(F.col("m").alias("v"), F.col("low").alias("m"))
            .distinct()
        )
        large = materialise(large, "large")
        lower = large.groupBy("v").agg(F.min("m").alias("low")).withColumnRenamed("v", "u")
        small = large.join(lower, F.col("v") == F.col("u")).select(
            F.explode(F.array(F.struct(F.col("v"), F.col("low").alias("m")), F.struct(F.col("m").alias("v"), F.col("low").alias("m")))).alias("e")
        ).select("e.v", "e.m").filter(F.col("v") != F.col("m")).distinct()
        before, edges = edges, materialise(small, "links")
        discard(before, large)
        targets = edges.select(F.col("m").alias("t")).distinct()
        loose = edges.join(targets, F.col("v") == F.col("t"), "left_semi")
        doubled = edges.groupBy("v").count().filter(F.col("count") > 1)
        if loose.isEmpty() and doubled.isEmpty():
            break
    roots = edges.select(F.col("m").alias("node"), F.col("m").alias("root")).distinct()
    return edges.select(F.col("v").alias("node"), F.col("m").alias("root")).unionByName(roots)
