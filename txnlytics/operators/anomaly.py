"""Per-category z-score outliers, merging of detections and run counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from txnlytics.functions.labels import fixed, rupees, severity_rank, zscore_severity
from txnlytics.params import UNCATEGORISED, Params
from txnlytics.session import materialise

_P = Params()

DETECTION_COLUMNS = ("txn_id", "method", "severity", "reason", "z_score")


def txn_features(df: DataFrame) -> DataFrame:
    """Calendar parts (Monday is 0) and log(1 + amount) next to every transaction."""
    return df.select(
        "*",
        F.weekday("date").alias("day_of_week"),
        F.dayofmonth("date").alias("day_of_month"),
        F.month("date").alias("month"),
        F.log1p(F.col("amount").cast("double")).alias("amount_log"),
    )


def category_stats(df: DataFrame) -> DataFrame:
    """Rows, mean and population standard deviation of the amount per category label."""
    amount = F.col("amount").cast("double")
    return df.groupBy(F.coalesce("category", F.lit(UNCATEGORISED)).alias("category")).agg(
        F.count("*").alias("n"), F.avg(amount).alias("mean"), F.stddev_pop(amount).alias("std")
    )


def zscores(df: DataFrame, p: Params = _P, moments: DataFrame | None = None) -> DataFrame:
    """Absolute z-score of every row in a category with enough spread and rows.

    ``moments`` are the rows' ``category_stats``, where they are known already.

    Statistics are aggregated first (hot categories fold before the shuffle) and
    joined back as a measured lookup, so the facts are neither shuffled nor gathered
    by category.
    """
    usable = (category_stats(df) if moments is None else moments).filter((F.col("n") >= p.z_min_rows) & (F.col("std") > 0))
    stats = materialise(usable.select("category", "mean", "std"), "category-stats")
    facts = df.withColumn("category", F.coalesce("category", F.lit(UNCATEGORISED)))
    amount = F.col("amount").cast("double")
    return facts.join(stats, "category").select(
        "txn_id",
        "category",
        amount.alias("amount"),
        "mean",
        F.abs((amount - F.col("mean")) / F.col("std")).alias("z"),
    )


def zscore_outliers(df: DataFrame, p: Params = _P, moments: DataFrame | None = None) -> DataFrame:
    """Detections beyond the threshold on either side of the category mean."""
    z, amount, mean = F.col("z"), F.col("amount"), F.col("mean")
    deviation = amount - mean
    reason = F.concat(
        F.lit("Amount "), rupees(amount),
        F.lit(" is "), fixed(z, 1),
        F.lit(" standard deviations above the "), F.col("category"),
        F.lit(" category mean of "), rupees(mean),
        F.lit(". Deviation: Rs "), F.when(deviation >= 0, "+").otherwise(""),
        F.format_number(deviation, 0), F.lit("."),
    )
    return zscores(df, p, moments).filter(z > p.z_threshold).select(
        "txn_id",
        F.lit("zscore").alias("method"),
        zscore_severity(z, p).alias("severity"),
        reason.alias("reason"),
        F.round(z, 2).alias("z_score"),
    )


def merge_detections(first: DataFrame, second: DataFrame) -> DataFrame:
    """One row per transaction from the detections of two methods.

    Found by both: severity high, method ``both``, the first method's reason behind a
    confirmation note and no z-score. Found by one: unchanged; if it reported the
    row more than once, the highest severity counts.
    """
    record = F.struct("method", "severity", "reason", "z_score")
    tagged = first.select(*DETECTION_COLUMNS, F.lit(1).alias("source")).unionByName(
        second.select(*DETECTION_COLUMNS, F.lit(2).alias("source"))
    )

    def best(source: int):
        # Highest severity of the source; the reason text settles equal ranks.
        order = F.struct(-severity_rank(F.col("severity")), F.col("reason"))
        return F.min_by(record, F.when(F.col("source") == source, order)).alias(f"d{source}")

    both = F.col("d1").isNotNull() & F.col("d2").isNotNull()
    note = F.lit("CONFIRMED by both Z-score and Isolation Forest. ")
    one = F.coalesce("d1", "d2")
    return tagged.groupBy("txn_id").agg(best(1), best(2)).select(
        "txn_id",
        F.when(both, "both").otherwise(one["method"]).alias("method"),
        F.when(both, "high").otherwise(one["severity"]).alias("severity"),
        F.when(both, F.concat(note, F.col("d1.reason"))).otherwise(one["reason"]).alias("reason"),
        F.when(both, F.col("d2.z_score")).otherwise(one["z_score"]).alias("z_score"),
    )


def run_summary(merged: DataFrame, facts: DataFrame, stored: DataFrame, rows: int | None = None) -> DataFrame:
    """One row of counts for a detection run.

    ``merged`` is scanned once: its method column already says which detectors
    flagged a row, so the detectors are not run again for their totals. ``rows`` is the
    number of facts, where it is known already.
    """
    total = facts.agg(F.count("*").alias("n")).scalar() if rows is None else F.lit(rows).cast("bigint")
    known = stored.select("txn_id").distinct().withColumn("_known", F.lit(True))
    method = F.col("method")
    return merged.join(known, "txn_id", "left").agg(
        F.count_if(method.isin("zscore", "both")).alias("zscore_flagged"),
        F.count_if(method.isin("isolation_forest", "both")).alias("iforest_flagged"),
        F.count("*").alias("total_flagged"),
        F.count_if(F.col("_known").isNull()).alias("new_records"),
    ).withColumn("total_transactions", total)
