"""Statement files of several layouts in one folder: surveyed in one pass, scanned once per layout."""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from txnlytics.operators import ingest
from txnlytics.operators.ingest import ORDER_COLUMN, ValidationError
from txnlytics.params import REQUIRED_COLUMNS
from txnlytics.sources.statements import BOM, read_headers, scan_layout


@dataclass
class Delivery:
    """``rows`` of all usable files under the common names (None if there are none), the ``layout`` of each of
    these files, and for the others the ``problem`` that keeps them out."""

    rows: DataFrame | None = None
    layout: dict[str, str] = field(default_factory=dict)
    problem: dict[str, str] = field(default_factory=dict)


def readable(uri: str) -> str:
    """A file's URI as a path that readers take literally, blanks and glob signs included."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))


def survey_files(spark: SparkSession, path) -> DataFrame:
    """(file, header, breaks) of every file with a line that is not blank: its first such line, and whether
    a quoted cell may hold a line break.

    One aggregate over the lines as text, split like any text scan. Line breaks inside quotes leave
    a line with an odd number of quotes; a file without one can be split when it is scanned as CSV.
    """
    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"statement not found: {path}") from error
        raise
    quotes = F.length("value") - F.length(F.translate("value", '"', ""))
    order = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    placed = lines.select("value", F.col("_metadata.file_path").alias("file"), order.alias("order"), (quotes % 2 == 1).alias("odd"))
    return placed.filter(F.trim(F.translate("value", f"{BOM}\t\r", "")) != "").groupBy("file").agg(
        F.min_by("value", "order").alias("header"), F.max("odd").alias("breaks")
    )


def header_cells(line: str) -> list[str]:
    return next(csv.reader([line.lstrip(BOM)], strict=False))


def read_deliveries(spark: SparkSession, path) -> Delivery:
    """All files at ``path`` (a name, a folder or a list of names), whatever their layouts.

    The survey's rows are collected: one per file, as the file list of any scan is. Files of one
    layout are one scan; a layout is a header and whether its files can be split, so
    there are as many scans as kinds of files, however many files. A layout without the required columns
    keeps its own files out and no others.
    """
    layouts: dict[tuple[str, bool], list[str]] = defaultdict(list)
    for row in survey_files(spark, path).orderBy("file").collect():
        layouts[row["header"], row["breaks"]].append(row["file"])
    found, scans = Delivery(), []
    for (line, breaks), files in layouts.items():
        # A header whose own cells hold line breaks goes on behind its first line.
        headers = read_headers(spark, readable(files[0])) if line.count('"') % 2 else header_cells(line)
        named = ingest.normalise_columns(scan_layout(spark, [readable(f) for f in files], headers, breaks))
        missing = [c for c in REQUIRED_COLUMNS if c not in named.columns]
        if missing:
            found.problem |= dict.fromkeys(files, f"Missing required columns: {missing}; columns found: {headers}")
            continue
        found.layout |= dict.fromkeys(files, ",".join(headers))
        scans.append(ingest.statement_columns(named))
    if scans:
        found.rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
    return found


def usable_delivery(spark: SparkSession, path) -> Delivery:
    """The same; ValidationError if no file is usable."""
    found = read_deliveries(spark, path)
    if found.rows is None:
        raise ValidationError(next(iter(found.problem.values()), f"statement {path} has no data rows"))
    return found


def file_counts(cleaned: DataFrame) -> DataFrame:
    """(file, total_read, total_dropped) of cleaned rows that still know their file."""
    return cleaned.groupBy(F.col(f"{ORDER_COLUMN}.file").alias("file")).agg(
        F.count("*").alias("total_read"), F.count("drop_step").alias("total_dropped")
    )
