"""Mixing sources to target weights: capped water-filling, then whole and seeded fractional repetitions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from txnlytics.llm.common import WORD_RUN, text_of
from txnlytics.session import materialise


@dataclass(frozen=True)
class Mix:
    """Weights go to sources by code point order, null last, repeating."""

    weights: tuple[int, ...] = (5, 2, 1)
    budget: float = 1.5
    max_epochs: float = 2.0
    seed: str = "mix-1"
    bucket_rows: int = 20_000


def source_targets(sizes: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """(source, source_size, target) from (source, source_size): clamp, reshare the excess by weight, repeat.

    A source is clamped at ``max_epochs`` times its size. The clamped set is found without
    rounds: in order of size per weight, the first k sources are clamped exactly if what is
    left for the others by weight lies above the k-th bound. The table has one row per source.
    """
    position = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in mix.weights]), (position % len(mix.weights) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("bound", F.col("source_size") * mix.max_epochs)
    everything = Window.partitionBy()
    rows = rows.select(
        "*",
        (F.sum("source_size").over(everything) * mix.budget).alias("budget"),
        F.sum("weight").over(everything).alias("weights"),
    )
    fuller = Window.orderBy(F.col("bound") / F.col("weight"), F.col("source").isNull(), "source")
    before = fuller.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select(
        "*",
        F.coalesce(F.sum("bound").over(before), F.lit(0.0)).alias("bound_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("weight_before"),
    )
    level = (F.col("budget") - F.col("bound_before")) / (F.col("weights") - F.col("weight_before"))
    rows = rows.withColumn("level", level)
    # The water level is that of the first source it does not clamp; if all are clamped there is none.
    free = F.min(F.when(F.col("level") * F.col("weight") <= F.col("bound"), F.struct(F.col("bound") / F.col("weight"), "weight_before", "level")))
    rows = rows.withColumn("water", free.over(everything)["level"])
    target = F.least("bound", F.coalesce(F.col("water") * F.col("weight"), F.col("bound")))
    return rows.select("source", "source_size", target.alias("target"))


def mix_sources(
    df: DataFrame,
    mix: Mix = Mix(),
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Per row of ``df``: key, ``carry``, ``size`` (words), ``source_size``, ``target``, ``copies``, ``taken`` words.

    Each document is taken whole ``floor(target / source_size)`` times. The remaining
    fraction is a seeded sample: documents of a source are ordered by the MD5 of seed and
    key, and those whose middle word lies within the fraction of the source's words get one
    copy more, so that a source misses its target by half a document at most.

    Null and empty texts have size 0, are taken 0 words, and have copies like any other; a
    null source is a source (ordered last); a null key is ordered as the word ``null``;
    repeated rows are sampled one by one. A source of size 0 has target 0. An empty table
    gives an empty table. Columns of ``df`` named like an added one are not carried.

    A source is never one window: its rows are split into hash ranges of about
    ``bucket_rows``, whose totals (one row per range, pre-aggregated) give the running
    offset. Columns other than key, source, size and ``carry`` do not travel.
    """
    added = ("size", "source_size", "target", "copies", "taken")
    kept = [key, *[c for c in carry if c != key and c.lower() not in added]]
    hashed = F.md5(F.concat(F.lit(mix.seed + ":"), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    # Carried columns are numbered on the way, so their names can't meet those made here.
    sized = df.select(
        *(F.col(f"`{c}`").alias(f"_in{k}") for k, c in enumerate(kept)),
        F.regexp_count(text_of(text), F.lit(WORD_RUN)).cast("long").alias("size"),
        F.col(source).alias("_source"),
        hashed.alias("_order"),
    )
    return _sample(sized, mix).select(*(F.col(f"_in{k}").alias(c) for k, c in enumerate(kept)), *added)


def _sample(sized: DataFrame, mix: Mix) -> DataFrame:
    sized = materialise(sized, "sized")
    rows = sized.count()
    # Ranges of the first hash digits: 16^d of them per source, as many as the rows call for.
    digits = 0
    while rows > mix.bucket_rows * 16**digits:
        digits += 1
    sized = sized.withColumn("_range", F.substring("_order", 1, digits))
    ranges = materialise(sized.groupBy("_source", "_range").agg(F.sum("size").alias("words")), "ranges")
    sizes = ranges.groupBy(F.col("_source").alias("source")).agg(F.sum("words").alias("source_size"))
    targets = source_targets(sizes, mix)
    before = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.withColumn("start", F.coalesce(F.sum("words").over(before), F.lit(0)))
    known = materialise(
        starts.join(targets, F.col("_source").eqNullSafe(F.col("source"))).select(
            F.col("_source").alias("s"), F.col("_range").alias("r"), "start", "source_size", "target"
        ),
        "targets",
    )
    inside = Window.partitionBy("_source", "_range").orderBy("_order", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("_before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = placed.join(known, F.col("_source").eqNullSafe(F.col("s")) & (F.col("_range") == F.col("r")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(rate)
    middle = F.col("start") + F.col("_before") + F.col("size") / 2
    extra = F.when(middle < (rate - whole) * F.col("source_size"), 1).otherwise(0)
    copies = (whole + extra).cast("long")
    return joined.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))
