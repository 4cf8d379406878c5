"""File-drop ingest: new statement files, of whatever layouts, are taken up exactly once.

Two plain steps. A stream lists arriving files - names only, so without state - into a
landing table. A batch step then surveys those not in the store's file log, scans them by
layout, appends the rows the store lacks and logs every file with its counts or its
problem. Repeating either step is harmless: the stream's checkpoint remembers its files,
and a file whose rows were stored but not yet logged adds nothing when it is read again.
It does not use ``foreachBatch``, which would open a callback port.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from txnlytics.operators import ingest
from txnlytics.plans import jobs
from txnlytics.session import materialise
from txnlytics.sources.deliveries import Delivery, file_counts, read_deliveries, readable
from txnlytics.sources.store import TableStore

LOAD_DATE = "load_date"

_FILES = "path string, modificationTime timestamp, length bigint, content binary"
_LANDED = f"file string, modified timestamp, bytes bigint, {LOAD_DATE} date"


def arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Streaming frame of the files in a folder that are not empty; their content is not read."""
    found = spark.readStream.format("binaryFile").schema(_FILES).load(folder)
    modified = F.col("_metadata.file_modification_time")
    return found.select(
        F.col("_metadata.file_path").alias("file"),
        modified.alias("modified"),
        F.col("_metadata.file_size").alias("bytes"),
        F.to_date(modified).alias(LOAD_DATE),
    )


def start_file_drop(spark: SparkSession, folder: str, landing: str, checkpoint: str) -> StreamingQuery:
    """Land the name of every file not seen before, then stop."""
    return (
        arrivals(spark, folder)
        .writeStream.format("parquet")
        .partitionBy(LOAD_DATE)
        .option("path", landing)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def _log_rows(spark: SparkSession, files: list, found: Delivery, counts: DataFrame | None) -> DataFrame:
    """One log row per file; a blank file is read with no rows."""
    listed = spark.createDataFrame(
        [(f["file"], f["modified"], found.layout.get(f["file"]), found.problem.get(f["file"])) for f in files],
        "file string, modified timestamp, layout string, problem string",
    )
    if counts is None:
        counts = spark.createDataFrame([], "file string, total_read bigint, total_dropped bigint")
    zero = F.lit(0).cast("bigint")
    return listed.join(counts, "file", "left").select(
        "file", "modified", "layout", "problem",
        F.coalesce("total_read", zero).alias("total_read"), F.coalesce("total_dropped", zero).alias("total_dropped"),
        F.current_timestamp().alias("logged_at"),
    )


def absorb_landing(spark: SparkSession, landing: str, store: TableStore, load_dates: list[str] | None = None) -> DataFrame:
    """Ingest the landed files that the store's log lacks; returns the counts of this run.

    ``load_dates`` limits the scan to those landing partitions. A file that can't be used is
    logged with its problem and does not hold up the others; a changed file is a new one.
    """
    landed = spark.read.schema(_LANDED).parquet(landing)
    if load_dates is not None:
        landed = landed.filter(F.col(LOAD_DATE).isin(*load_dates))
    fresh = landed.select("file", "modified").distinct().join(store.read("file_log"), ["file", "modified"], "left_anti")
    # The names of new files, as any scan of them needs on the driver.
    files = fresh.orderBy("file").collect()
    found = read_deliveries(spark, [readable(f["file"]) for f in files]) if files else Delivery()
    counts = None
    if found.rows is None:
        nothing = spark.createDataFrame([], "date date, description string, amount decimal(12,2), drop_step string")
        summary = ingest.ingest_summary(nothing, nothing.withColumn("copies", F.lit(1)), nothing)
    else:
        cleaned = materialise(ingest.clean_rows(found.rows), "cleaned")
        counts = file_counts(cleaned)
        summary = jobs.store_cleaned(cleaned, store)
    summary = materialise(summary, "ingest-summary")
    if files:
        store.append("file_log", _log_rows(spark, files, found, counts))
    return summary
