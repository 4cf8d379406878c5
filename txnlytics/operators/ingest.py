"""Statement cleaning: headers, validation, deduplication and counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from txnlytics.functions import cleaning
from txnlytics.functions.keys import month_label, txn_key
from txnlytics.functions.labels import rounded
from txnlytics.params import HEADER_ALIASES, REQUIRED_COLUMNS

KEYS = ("date", "amount", "description")
ORDER_COLUMN = "_ord"


class ValidationError(ValueError):
    """The statement cannot be processed at all."""


def normalise_columns(df: DataFrame, aliases: dict[str, str] = HEADER_ALIASES) -> DataFrame:
    """Trim and lower-case headers, then apply the alias map.

    Several headers may mean the same column (debit and credit amount): the first
    non-missing value in header order is taken. ``raw_text`` keeps the untouched
    description, only where the header itself already reads ``description``.
    Columns of the scan itself (leading underscore) pass through.
    """
    sources: dict[str, list] = {}
    raw_text = None
    for header in df.columns:
        if header.startswith("_"):
            sources.setdefault(header, []).append(F.col(f"`{header}`"))
            continue
        plain = header.strip().lower()
        cell = F.col("`" + header.replace("`", "``") + "`")
        if plain == "description" and raw_text is None:
            raw_text = cell
        sources.setdefault(aliases.get(plain, plain), []).append(cell)
    columns = [
        (cells[0] if len(cells) == 1 else F.coalesce(*(cleaning.missing_to_null(c) for c in cells))).alias(name)
        for name, cells in sources.items()
    ]
    if raw_text is not None and "raw_text" not in sources:
        columns.append(raw_text.alias("raw_text"))
    return df.select(*columns)


def check_required(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> None:
    """Raise unless every required column is there and at least one row."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValidationError(
            f"Missing required columns: {missing}; columns found: {list(df.columns)}; "
            f"needed: {list(required)}"
        )
    if df.isEmpty():
        raise ValidationError("The statement has no data rows; at least one transaction is needed.")


_CELLS = {
    "date": (cleaning.date_text, cleaning.parse_date),
    "amount": (cleaning.amount_text, cleaning.parse_amount),
    "description": (cleaning.description_text, cleaning.parse_description),
}


def _clean(df: DataFrame, *names: str) -> DataFrame:
    """Cells cleaned in place, each read once; null where the cell is not usable."""
    texts = df.select(
        *(c for c in df.columns if c not in names),
        *(_CELLS[n][0](F.col(n).cast("string")).alias(f"_{n}_text") for n in names),
    )
    values = texts.select(
        *(c for c in df.columns if c not in names),
        *(_CELLS[n][1](F.col(f"_{n}_text")).alias(n) for n in names),
    )
    step = F.lit(None).cast("string")
    for name in reversed(names):
        step = F.when(F.col(name).isNull(), name).otherwise(step)
    # The generator keeps later filters above the cleaning. Pushed below it, they
    # would repeat every regular expression just to evaluate their condition.
    row = F.struct(*names, step.alias("drop_step"))
    return values.select(
        *(c for c in df.columns if c not in names), F.inline_outer(F.array(row))
    )


def clean_dates(df: DataFrame) -> DataFrame:
    """``date`` parsed in place, null where it cannot be."""
    return _clean(df, "date").drop("drop_step")


def clean_amounts(df: DataFrame) -> DataFrame:
    """``amount`` as non-negative DECIMAL(12,2), null where it is not a number."""
    return _clean(df, "amount").drop("drop_step")


def clean_descriptions(df: DataFrame) -> DataFrame:
    """``description`` trimmed, lower-case and single-spaced, null where empty."""
    return _clean(df, "description").drop("drop_step")


def clean_rows(df: DataFrame) -> DataFrame:
    """All three cells cleaned, plus ``drop_step``: the first step that rejects the row.

    The steps run in the order date, amount, description, so a row that is bad in
    two ways is counted once. Valid rows have a null ``drop_step``.
    """
    return _clean(df, "date", "amount", "description")


def valid_rows(cleaned: DataFrame) -> DataFrame:
    return cleaned.filter(F.col("drop_step").isNull()).drop("drop_step")


def validation_report(cleaned: DataFrame) -> DataFrame:
    """One row: rows before, after, dropped (also per step) and drop rate in percent."""

    def at(step: str):
        return F.count_if(F.col("drop_step") == step)

    counts = cleaned.agg(
        F.count("*").alias("original_rows"),
        F.count_if(F.col("drop_step").isNull()).alias("clean_rows"),
        F.count("drop_step").alias("dropped_rows"),
        at("date").alias("bad_dates"),
        at("amount").alias("bad_amounts"),
        at("description").alias("bad_descriptions"),
    )
    rate = rounded(F.col("dropped_rows") / F.col("original_rows") * 100, 1)
    return counts.withColumn("drop_rate", F.when(F.col("original_rows") > 0, rate).otherwise(F.lit(0.0)))


def dedupe(df: DataFrame, order: str = ORDER_COLUMN, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per key: the first by ``order``, with ``copies``, the size of its group.

    A grouped minimum, so copies of a hot row are already folded before the
    shuffle and no group is ever held in memory.
    """
    rest = [c for c in df.columns if c not in keys and c != order]
    first = F.min(F.struct(F.col(order).alias("o"), *rest)).alias("first")
    return (
        df.groupBy(*keys)
        .agg(first, F.count("*").alias("copies"))
        .select(*keys, *(F.col(f"first.{c}").alias(c) for c in rest), "copies")
    )


def final_columns(df: DataFrame) -> DataFrame:
    """date, description, amount and, where present, raw_text."""
    wanted = ("date", "description", "amount", "raw_text")
    return df.select(*(c for c in wanted if c in df.columns))


def statement_columns(df: DataFrame) -> DataFrame:
    """The final columns and the file order; rows get their scan order if they have none."""
    if ORDER_COLUMN not in df.columns:
        df = df.withColumn(ORDER_COLUMN, F.monotonically_increasing_id())
    return df.select(*final_columns(df).columns, ORDER_COLUMN)


def new_transactions(clean: DataFrame) -> DataFrame:
    """Stored form of deduplicated clean rows: keyed, uncategorised, not flagged."""
    # Layouts without the plain header have no raw text of their own.
    raw_text = F.coalesce("raw_text", "description") if "raw_text" in clean.columns else F.col("description")
    return clean.select(
        txn_key("date", "amount", "description").alias("txn_id"),
        "date",
        "description",
        "amount",
        F.lit(None).cast("bigint").alias("category_id"),
        F.lit(False).alias("is_anomaly"),
        F.lit(None).cast("double").alias("confidence"),
        raw_text.alias("raw_text"),
        F.current_timestamp().alias("uploaded_at"),
        month_label("date").alias("year_month"),
    )


def append_new(new: DataFrame, stored: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Rows of ``new`` whose key is not stored yet.

    The stored side is reduced to the keys of the delivery first. A small (pinned)
    delivery is broadcast for that, so the store is only scanned; what is shuffled then
    is at most as large as the delivery, each key once.
    """
    wanted = new.select(*keys).distinct()
    known = stored.select(*keys).join(wanted, list(keys), "left_semi").distinct()
    return new.join(known, list(keys), "left_anti")


def ingest_summary(cleaned: DataFrame, unique: DataFrame, inserted: DataFrame | None) -> DataFrame:
    """One row of counts for a whole ingest run.

    ``cleaned`` is the flagged input, ``unique`` the deduplicated valid rows (with
    ``copies``), ``inserted`` the rows that were not stored yet. Without ``inserted``
    nothing was to be saved: no row counts as inserted or skipped.
    """
    counts = F.struct(
        F.count("*").alias("total_clean"), F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates_removed")
    )
    counted = unique.agg(counts.alias("c")).scalar()  # one struct, so that both come from one plan
    report = validation_report(cleaned)
    n_clean = counted["total_clean"]
    if inserted is None:
        n_inserted = n_skipped = F.lit(0).cast("bigint")
    else:
        n_inserted = inserted.agg(F.count("*").alias("n")).scalar()
        n_skipped = n_clean - n_inserted
    return report.select(
        F.col("original_rows").alias("total_read"),
        n_clean.alias("total_clean"),
        F.col("dropped_rows").alias("total_dropped"),
        "drop_rate",
        counted["duplicates_removed"].alias("duplicates_removed"),
        n_inserted.alias("db_inserted"),
        n_skipped.alias("db_skipped"),
    )


def preview_profile(df: DataFrame, order: Sequence[str], rows: int = 5) -> DataFrame:
    """The first ``rows`` rows with the table's row and column counts."""
    total = df.agg(F.count("*").alias("n")).scalar()
    return (
        df.orderBy(*order)
        .limit(rows)
        .withColumn("total_rows", total)
        .withColumn("total_columns", F.lit(len(df.columns)))
    )
