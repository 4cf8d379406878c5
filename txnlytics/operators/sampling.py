"""Exact, repeatable stratified splits and folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from txnlytics.params import Params
from txnlytics.session import discard, materialise

_P = Params()
_BUCKET_DIGITS = 3  # at least
_BUCKET_GROUPS = 4096  # of the largest stratum in a bucket, on average


def stratum_ranks(df: DataFrame, stratum: str, row_id: str, seed: int) -> DataFrame:
    """``rank`` 1..n of every row within its stratum in hash order, with ``stratum_rows``.

    The rows of an id in one input partition are a group with a count; groups are ranked by
    running counts, in hash buckets whose number follows the largest stratum's groups. A
    window holds one bucket's groups or one group's rows, so neither a stratum nor an id
    with a large share of all rows lands in one task.
    """
    return _ranked(df, stratum, row_id, seed)[0]


def _ranked(df: DataFrame, stratum: str, row_id: str, seed: int, compression: str = "snappy") -> tuple[DataFrame, list[DataFrame]]:
    """``stratum_ranks`` and the tables it is made of."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(row_id).cast("string")))
    rows = materialise(df.withColumn("_hash", digest).withColumn("_part", F.spark_partition_id()), "stratum-rows", compression)
    counted = materialise(rows.groupBy(stratum, "_hash", "_part").agg(F.count("*").alias("_n")), "stratum-groups")
    most = counted.groupBy(stratum).count().agg(F.max("count")).first()[0] or 0
    digits = _BUCKET_DIGITS
    while 16**digits * _BUCKET_GROUPS < most:
        digits += 1
    groups = counted.withColumn("_bucket", F.substring("_hash", 1, digits))
    sizes = groups.groupBy(stratum, "_bucket").agg(F.sum("_n").alias("_rows"))
    whole = Window.partitionBy(stratum)
    earlier = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = materialise(
        sizes.select(
            stratum,
            "_bucket",
            F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
            F.sum("_rows").over(whole).alias("stratum_rows"),
        ),
        "stratum-offsets",
    )
    inside = Window.partitionBy(stratum, "_bucket").orderBy("_hash", "_part").rowsBetween(Window.unboundedPreceding, -1)
    begins = groups.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(buckets, [stratum, "_bucket"])
    offsets = materialise(
        begins.select(stratum, "_hash", "_part", (F.col("_before") + F.col("_inside")).alias("_before"), "stratum_rows"),
        "stratum-begins",
    )
    place = F.row_number().over(Window.partitionBy(stratum, "_hash", "_part").orderBy(row_id))
    ranked = (
        rows.withColumn("_place", place)
        .join(offsets, [stratum, "_hash", "_part"])
        .withColumn("rank", F.col("_before") + F.col("_place"))
        .drop("_hash", "_part", "_place", "_before")
    )
    return ranked, [rows, counted, buckets, offsets]


def _split(p: Params) -> Column:
    train_rows = F.col("stratum_rows") - F.round(F.col("stratum_rows") * p.test_fraction)
    return F.when(F.col("rank") <= train_rows, "train").otherwise("test")


def _fold(p: Params) -> Column:
    return F.pmod(F.col("rank") - 1, F.lit(p.folds)).cast("int")


def stratified_split(df: DataFrame, stratum: str, row_id: str, p: Params = _P) -> DataFrame:
    """``split`` = train or test; each stratum gives round(fraction * n) rows to the test."""
    ranked = stratum_ranks(df, stratum, row_id, p.split_seed)
    return ranked.withColumn("split", _split(p)).drop("rank", "stratum_rows")


def stratified_folds(df: DataFrame, stratum: str, row_id: str, p: Params = _P) -> DataFrame:
    """``fold`` 0..k-1, fold sizes of a stratum differing by at most one."""
    ranked = stratum_ranks(df, stratum, row_id, p.split_seed)
    return ranked.withColumn("fold", _fold(p)).drop("rank", "stratum_rows")


def split_and_folds(df: DataFrame, stratum: str, row_id: str, p: Params = _P) -> DataFrame:
    """``split`` and ``fold`` in place of the row id, from one ranking and written once.

    What the ranking wrote is removed, so one copy of the rows is left.
    """
    ranked, made = _ranked(df, stratum, row_id, p.split_seed, "zstd")
    placed = ranked.withColumn("split", _split(p)).withColumn("fold", _fold(p)).drop("rank", "stratum_rows", row_id)
    stored = materialise(placed, "cells", "zstd")
    discard(*made)
    return stored
