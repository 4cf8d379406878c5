"""Durable tables: plain Parquet folders written by Spark's own writer.

The fact table is partitioned by month, saved forecasts by the month they are for. New
rows are appended; changed rows replace the partitions they lie in (dynamic partition
overwrite), so an update rewrites the months it touches and nothing else. One job at a
time may write a table; appends and updates may be repeated after a failure.
"""

from __future__ import annotations

from collections import Counter

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from txnlytics.params import ANOMALIES, CATEGORIES, FILE_LOG, FORECASTS, MONTH_TOTALS, TRANSACTIONS
from txnlytics.session import materialise

MONTH = "year_month"

SCHEMAS = {
    "categories": CATEGORIES,
    "transactions": TRANSACTIONS,
    "anomalies": ANOMALIES,
    "forecasts": FORECASTS,
    "month_totals": MONTH_TOTALS,
    "file_log": FILE_LOG,
}
PARTITION = {"transactions": MONTH, "month_totals": MONTH, "forecasts": "forecast_month"}


class TableStore:
    """The tables below one root folder on any Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str, parts: list | None = None) -> DataFrame:
        """Current rows; ``parts`` restricts a partitioned table to those months.

        A scan of one folder however often the table was written. Frames should be taken
        anew after an update, whose files replace those they were planned on.
        """
        schema = SCHEMAS[table]
        try:
            rows = self.spark.read.schema(schema).parquet(self._path(table))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)
        if parts is not None:
            rows = rows.filter(F.col(PARTITION[table]).isin(*parts))
        return rows.select(*schema.fieldNames())

    def _writer(self, table: str, rows: DataFrame, mode: str):
        rows = rows.select(*SCHEMAS[table].fieldNames())
        part = PARTITION.get(table)
        if part is None:
            return rows.write.mode(mode)
        # Rebalancing splits a hot month over several files and keeps small ones whole.
        return rows.hint("rebalance", part).write.mode(mode).partitionBy(part)

    def append(self, table: str, rows: DataFrame) -> None:
        self._writer(table, rows, "append").parquet(self._path(table))

    def update(self, table: str, rows: DataFrame) -> None:
        """``rows`` become the content of the partitions that occur in them; the others stay as they are."""
        if table not in PARTITION:
            raise ValueError(f"table {table} has no partitions to update")
        # Pinned, since the rows usually derive from the very files that are replaced.
        pinned = materialise(rows.select(*SCHEMAS[table].fieldNames()), f"update-{table}")
        self._writer(table, pinned, "overwrite").option("partitionOverwriteMode", "dynamic").parquet(self._path(table))

    def compact(self, table: str, more_than: int = 16) -> list[str]:
        """Rewrites the partitions of more than ``more_than`` files in fewer; returns their values.

        Small appends leave small files; rows do not change. The count uses the file
        list that every scan has.
        """
        part = PARTITION[table]
        names = (f.rsplit(f"{part}=", 1)[1].split("/", 1)[0] for f in self.read(table).inputFiles())
        parts = sorted(name for name, files in Counter(names).items() if files > more_than)
        if parts:
            self.update(table, self.read(table).filter(F.col(part).cast("string").isin(*parts)))
        return parts


def parts_in(rows: DataFrame, column: str = MONTH) -> list:
    """Distinct values of a partition column; at most 12 per calendar year."""
    return sorted(r[0] for r in rows.select(column).distinct().collect())
