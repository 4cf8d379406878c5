"""Scans of bank-statement and labelled-text CSV files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from txnlytics.functions.cleaning import missing_to_null
from txnlytics.operators.classify import usable_labels
from txnlytics.operators.ingest import ORDER_COLUMN, ValidationError

CORRUPT = "_corrupt"
BOM = "\ufeff"


def statement_options(multiline: bool) -> dict:
    return {
        "header": "true",
        "encoding": "UTF-8",
        "multiLine": str(multiline).lower(),
        "escape": '"',
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        # All cells must be parsed for a row with surplus fields to be noticed.
        "columnPruning": "false",
    }


def read_headers(spark: SparkSession, path, multiline: bool = True) -> list[str]:
    """Header cells of the statement layout at ``path``; reads one row."""
    options = statement_options(multiline) | {"header": "false"}
    options.pop("columnNameOfCorruptRecord")
    try:
        first = spark.read.options(**options).csv(path).limit(1).collect()
    except AnalysisException as error:
        condition = error.getCondition() or ""
        if condition == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"statement not found: {path}") from error
        raise ValidationError(f"cannot read statement {path}: {condition}") from error
    if not first:
        raise ValidationError(f"statement {path} is empty")
    return [(cell or "").lstrip(BOM) for cell in first[0]]


def unique_headers(headers: list[str]) -> list[str]:
    """Repeated headers numbered .1, .2 in order, so that every column has a name."""
    seen: dict[str, int] = {}
    names = []
    for position, header in enumerate(headers):
        header = header or f"column {position}"
        key = header.lower()
        count = seen.get(key, 0)
        seen[key] = count + 1
        names.append(f"{header}.{count}" if count else header)
    return names


def statement_schema(headers: list[str]) -> T.StructType:
    """All cells as text: cleaning decides what is a date or a number."""
    fields = [T.StructField(name, T.StringType()) for name in unique_headers(headers)]
    return T.StructType(fields + [T.StructField(CORRUPT, T.StringType())])


def too_many_fields(raw_line: Column, expected: int) -> Column:
    """True if a raw row has more cells than the header; quoted commas do not count."""
    bare = F.regexp_replace(raw_line, r'"(?:[^"]|"")*"', "")
    return F.length(bare) - F.length(F.regexp_replace(bare, ",", "")) + 1 > expected


def usable_rows(scan: DataFrame, headers: list[str]) -> DataFrame:
    """Rows with surplus fields removed, missing markers nulled; short rows are padded."""
    names = unique_headers(headers)
    columns = [F.col("`" + name.replace("`", "``") + "`") for name in names]
    # Spark refuses to read the raw line alone (as a bare count would), so the
    # condition names a cell as well; it is only looked at where there is a raw line.
    raw_line = F.coalesce(F.col(CORRUPT), columns[0])
    kept = scan.filter(F.col(CORRUPT).isNull() | ~too_many_fields(raw_line, len(headers)))
    cells = [missing_to_null(column).alias(name) for column, name in zip(columns, names)]
    return kept.select(*cells, *(c for c in scan.columns if c.startswith("_") and c != CORRUPT))


def scan_layout(spark: SparkSession, path, headers: list[str], multiline: bool, check: bool = False) -> DataFrame:
    """Raw rows of files that share one header, in file order by the ``_ord`` column.

    ``check`` makes Spark compare every file's header with ``headers``.
    """
    unique = len({h.lower() for h in headers}) == len(headers)
    scan = (
        spark.read.options(**statement_options(multiline))
        .option("enforceSchema", str(not (check and unique and all(headers))).lower())
        .schema(statement_schema(headers))
        .csv(path)
    )
    order = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return usable_rows(scan.withColumn(ORDER_COLUMN, order), headers)


def read_statements(spark: SparkSession, path, multiline: bool = True) -> DataFrame:
    """Raw statement rows of one layout.

    All files must share one header: a file with another one fails the read instead
    of being read by position (``deliveries`` reads several layouts). ``multiline=False``
    lets large files be split, at the price of no line breaks inside quotes.
    """
    return scan_layout(spark, path, read_headers(spark, path, multiline), multiline, check=True)


def read_labels(spark: SparkSession, path) -> DataFrame:
    """(description, category) rows for training; unusable rows left out."""
    headers = read_headers(spark, path)
    missing = {"description", "category"} - set(headers)
    if missing:
        raise ValueError("training data needs 'description' and 'category' columns")
    scan = spark.read.options(**statement_options(True)).schema(statement_schema(headers)).csv(path)
    return usable_labels(usable_rows(scan, headers).select("description", "category"))
