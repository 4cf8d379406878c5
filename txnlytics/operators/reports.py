"""Tables behind the dashboard: KPIs, roll-ups, series, filters and top-k lists.

Inputs are report rows: a ``category`` label that may be null, a DATE or ISO
``date`` and a money ``amount``. Sums run on decimals, so they do not depend on
the order of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from txnlytics.functions.keys import month_label
from txnlytics.functions.labels import (
    category_colour,
    is_expense,
    percent,
    rounded,
    rupees,
    severity_colour,
    severity_rank,
    title_case,
)
from txnlytics.functions.text import not_blank
from txnlytics.params import SEVERITIES, UNCATEGORISED, Params

_P = Params()


def _label() -> Column:
    return F.coalesce("category", F.lit(UNCATEGORISED)).alias("category")


def _total(amount: Column | str = "amount") -> Column:
    """Decimal sum as double; zero when there is nothing to add."""
    return F.coalesce(F.sum(amount), F.lit(0)).cast("double")


def expenses(df: DataFrame, p: Params = _P) -> DataFrame:
    """Rows that are neither income nor transfer; all rows if there is no category."""
    return df.filter(is_expense(F.col("category"), p)) if "category" in df.columns else df


def _category_totals(df: DataFrame, p: Params) -> DataFrame:
    return expenses(df, p).groupBy(_label()).agg(F.sum("amount").alias("_sum"))


def spend_by_category(df: DataFrame, p: Params = _P, palette: dict | None = None) -> DataFrame:
    """Expense total, colour and text label per category, largest first."""
    total = F.col("_sum").cast("double")
    return (
        _category_totals(df, p)
        .select(
            "category",
            total.alias("total"),
            category_colour(F.col("category"), palette).alias("color"),
            rupees(total).alias("label"),
        )
        .orderBy(F.desc("total"), "category")
    )


def category_share(df: DataFrame, p: Params = _P, palette: dict | None = None) -> DataFrame:
    """Expense total and percent of all expenses per category (0 if there are none)."""
    totals = _category_totals(df, p)
    grand = totals.agg(F.sum("_sum").alias("g")).scalar().cast("double")
    total = F.col("_sum").cast("double")
    share = F.when(grand > 0, F.round(total / grand * 100, 2)).otherwise(F.lit(0.0))
    return totals.select(
        "category",
        total.alias("total"),
        share.alias("share_pct"),
        category_colour(F.col("category"), palette).alias("color"),
    ).orderBy(F.desc("total"), "category")


def monthly_trend(df: DataFrame, p: Params = _P, palette: dict | None = None) -> DataFrame:
    """Expense total per month and category, chronological."""
    return (
        expenses(df, p)
        .groupBy(month_label("date").alias("year_month"), _label())
        .agg(_total().alias("total"))
        .withColumn("color", category_colour(F.col("category"), palette))
        .orderBy("year_month", "category")
    )


def monthly_total(df: DataFrame, p: Params = _P) -> DataFrame:
    """Expense total and text label per month, chronological."""
    return (
        expenses(df, p)
        .groupBy(month_label("date").alias("year_month"))
        .agg(_total().alias("total"))
        .withColumn("label", rupees(F.col("total")))
        .orderBy("year_month")
    )


def kpi_summary(df: DataFrame, p: Params = _P) -> DataFrame:
    """One row of headline numbers, all from a single pass."""
    spent = is_expense(F.col("category"), p)
    one = df.agg(
        _total(F.when(spent, F.col("amount"))).alias("total_expense"),
        _total(F.when(F.col("category") == p.income_category, F.col("amount"))).alias("total_income"),
        F.count("*").alias("transactions"),
        F.count_if(F.col("is_anomaly")).alias("anomalies"),
        F.count_if(spent).alias("_spent_rows"),
    )
    mean = F.when(F.col("_spent_rows") > 0, F.col("total_expense") / F.col("_spent_rows")).otherwise(F.lit(0.0))
    rate = F.when(F.col("transactions") > 0, F.col("anomalies") / F.col("transactions") * 100).otherwise(F.lit(0.0))
    return one.select(
        "total_expense",
        "total_income",
        F.round(F.col("total_income") - F.col("total_expense"), 2).alias("net_balance"),
        "transactions",
        "anomalies",
        F.round(mean, 2).alias("avg_expense"),
        rounded(rate, 1).alias("anomaly_rate"),
    )


def top_category(df: DataFrame, p: Params = _P) -> DataFrame:
    """The category with the largest expense total, ``N/A`` and 0 if there is none."""
    totals = _category_totals(df, p)
    # Largest sum; among equal sums the first label, hence min over (-sum, label).
    best = F.min(F.struct((-F.col("_sum")).alias("neg"), F.col("category").alias("c")))
    return totals.agg(best.alias("b")).select(
        F.coalesce(F.col("b.c"), F.lit("N/A")).alias("category"),
        F.coalesce((-F.col("b.neg")).cast("double"), F.lit(0.0)).alias("total"),
    )


def category_options(df: DataFrame) -> DataFrame:
    """Sorted distinct category labels."""
    return df.select(_label()).distinct().orderBy("category")


_EXPLORER_SORT = {
    "date_newest": lambda: (F.desc("date"), F.asc("txn_id")),
    "amount_highest": lambda: (F.desc("amount"), F.asc("txn_id")),
    "amount_lowest": lambda: (F.asc("amount"), F.asc("txn_id")),
}


def explorer_filter(df: DataFrame, category: str | None = None, status: str = "all") -> DataFrame:
    """Rows of one category label and/or one status (all, normal, anomalies)."""
    if category is not None:
        named = F.col("category") == category
        df = df.filter(named | F.col("category").isNull() if category == UNCATEGORISED else named)
    if status == "normal":
        df = df.filter(~F.col("is_anomaly"))
    elif status == "anomalies":
        df = df.filter(F.col("is_anomaly"))
    elif status != "all":
        raise ValueError(f"unknown status {status!r}")
    return df


def txn_explorer(
    df: DataFrame, category: str | None = None, status: str = "all", sort: str = "date_newest", rows: int = 30
) -> DataFrame:
    """The first ``rows`` matching transactions in display form."""
    top = explorer_filter(df, category, status).orderBy(*_EXPLORER_SORT[sort]()).limit(rows)
    confidence = F.when(F.col("confidence") != 0, percent(F.bround("confidence", 2)))
    return top.select(
        F.date_format("date", "yyyy-MM-dd").alias("Date"),
        F.col("description").alias("Description"),
        rupees(F.col("amount")).alias("Amount"),
        _label().alias("Category"),
        F.coalesce(confidence, F.lit("N/A")).alias("ML Confidence"),
        F.when(F.col("is_anomaly"), "🚨 Anomaly").otherwise("✅ Normal").alias("Status"),
    )


def explorer_footer(
    df: DataFrame, category: str | None = None, status: str = "all", rows: int = 30
) -> DataFrame:
    """How many rows the explorer shows and how many match."""
    return explorer_filter(df, category, status).agg(
        F.least(F.count("*"), F.lit(rows)).alias("shown"), F.count("*").alias("matching")
    )


def top_expenses(df: DataFrame, p: Params = _P, rows: int = 5) -> DataFrame:
    """The largest expenses, ranked; among equals the lower transaction id first."""
    top = expenses(df, p).orderBy(F.desc("amount"), "txn_id").limit(rows)
    # The window only ever sees the few rows of the list.
    rank = F.row_number().over(Window.orderBy(F.desc("amount"), "txn_id"))
    return top.select(
        rank.alias("rank"),
        "txn_id",
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        title_case(F.col("description")).alias("description"),
        _label(),
        F.col("amount").cast("double").alias("amount"),
        rupees(F.col("amount")).alias("label"),
    )


def anomaly_kpis(flagged: DataFrame) -> DataFrame:
    """Counts per severity and suspicious amounts of the flagged rows."""
    severity = F.col("severity")
    money = F.col("amount").cast("decimal(12,2)")
    return flagged.agg(
        F.count("*").alias("flagged"),
        *(F.count_if(severity == s).alias(s) for s in SEVERITIES),
        _total(money).alias("suspicious_amount"),
        _total(F.when(severity == "high", money)).alias("high_amount"),
    )


def anomaly_filter(
    flagged: DataFrame, severities: Sequence[str] = SEVERITIES, search: str = ""
) -> DataFrame:
    """Flagged rows of the chosen severities whose description matches, ignoring case."""
    kept = flagged.filter(F.col("severity").isin(*severities))
    return kept.filter(F.col("description").rlike(f"(?i){search}")) if search else kept


_ANOMALY_SORT = {
    "amount": lambda: (F.desc("amount"), F.asc("txn_id")),
    "date": lambda: (F.desc("date"), F.asc("txn_id")),
    "severity": lambda: (F.desc(severity_rank(F.col("severity"))), F.asc("txn_id")),
}


def anomaly_search(
    flagged: DataFrame, severities: Sequence[str] = SEVERITIES, search: str = "", sort: str = "amount"
) -> DataFrame:
    """The anomaly cards: filtered, sorted, with display fields."""
    return anomaly_filter(flagged, severities, search).orderBy(*_ANOMALY_SORT[sort]()).select(
        "txn_id",
        "date",
        title_case(F.col("description")).alias("title"),
        "amount",
        "category",
        "severity",
        F.upper("severity").alias("badge"),
        "reason",
    )


def anomaly_search_footer(
    flagged: DataFrame, severities: Sequence[str] = SEVERITIES, search: str = ""
) -> DataFrame:
    """Shown and total counts and the shown amount, in one pass."""
    shown = F.col("severity").isin(*severities)
    if search:
        shown = shown & F.col("description").rlike(f"(?i){search}")
    shown = F.coalesce(shown, F.lit(False))
    return flagged.agg(
        F.count_if(shown).alias("shown"),
        F.count("*").alias("total"),
        _total(F.when(shown, F.col("amount").cast("decimal(12,2)"))).alias("shown_amount"),
    )


def anomaly_scatter(df: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Every transaction with its series, severity and colour.

    Severity is looked up by transaction id; flagged rows without a stored severity
    take the medium colour, normal rows are grey.
    """
    severity = anomalies.select("txn_id", F.col("severity").alias("_severity"))
    joined = df.join(severity, "txn_id", "left")
    label = F.coalesce("_severity", F.lit("normal"))
    return joined.select(
        "txn_id",
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        F.col("amount").cast("double").alias("amount"),
        F.when(F.col("is_anomaly"), "Anomaly").otherwise("Normal").alias("series"),
        label.alias("severity"),
        F.when(F.col("is_anomaly"), severity_colour(label)).otherwise("#CCCCCC").alias("color"),
    )


def severity_breakdown(detections: DataFrame) -> DataFrame:
    return detections.groupBy("severity").agg(F.count("*").alias("n")).orderBy("severity")


def label_distribution(df: DataFrame) -> DataFrame:
    """Usable labelled rows per category, most frequent first."""
    usable = df.filter(F.col("category").isNotNull() & not_blank(F.col("description")))
    return usable.groupBy("category").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "category")
