"""Monthly history and least-squares forecast per category."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from txnlytics.functions.keys import month_label
from txnlytics.functions.labels import (
    category_colour,
    is_expense,
    rupees,
    share_band,
    trend,
    trend_note,
    trend_symbol,
)
from txnlytics.params import Params
from txnlytics.session import materialise

_P = Params()


def month_numbers(months: DataFrame) -> DataFrame:
    """Distinct ``year_month`` labels numbered 1..n in calendar order, gaps closed up.

    The unpartitioned window is safe: it ranks distinct calendar months, of which a
    DATE column has at most 12 per year.
    """
    labels = months.select("year_month").distinct()
    return labels.withColumn("month_num", F.row_number().over(Window.orderBy("year_month")))


def monthly_history(txn: DataFrame, p: Params = _P) -> DataFrame:
    """Expense total per month and category with the month's number.

    Rows without a category are left out, unlike in the reports.
    """
    labelled = txn.filter(F.col("category").isNotNull())
    totals = labelled.groupBy(month_label("date").alias("year_month"), "category").agg(
        F.sum("amount").cast("double").alias("total")
    )
    return history_of_totals(totals, p)


def history_of_totals(totals: DataFrame, p: Params = _P) -> DataFrame:
    """The same from (year_month, category, total) rows, one per month and category."""
    spent = totals.filter(is_expense(F.col("category"), p)).select("year_month", "category", "total")
    # One pass over the input; the numbering reads only this small result.
    monthly = materialise(spent, "monthly")
    # Broadcast is bounded by the calendar, see month_numbers.
    return monthly.join(F.broadcast(month_numbers(monthly)), "year_month").select(
        "year_month", "category", "total", "month_num"
    )


def forecast(history: DataFrame, p: Params = _P) -> DataFrame:
    """One forecast row per category with at least ``min_months`` months.

    Least squares over (month number, total), evaluated one step beyond the
    category's own last month and clamped at zero; bounds are one mean absolute
    error wide. ``history`` holds the months used, in order; its length is bounded
    by the calendar.
    """
    x, y = F.col("month_num"), F.col("total")
    fitted = history.groupBy("category").agg(
        F.count("*").alias("history_months"),
        F.max(x).alias("last_num"),
        F.max("year_month").alias("last_month"),
        F.regr_slope(y, x).alias("b"),
        F.regr_intercept(y, x).alias("a"),
        F.regr_r2(y, x).alias("r2"),
        F.array_sort(F.collect_list(F.struct("year_month", "month_num", "total"))).alias("points"),
    ).filter(F.col("history_months") >= p.min_months)
    a, b = F.col("a"), F.col("b")
    absolute_errors = F.aggregate(
        "points",
        F.lit(0.0),
        lambda acc, q: acc + F.abs(q["total"] - (a + b * q["month_num"])),
    )
    measured = fitted.withColumn("mae", absolute_errors / F.col("history_months")).withColumn(
        "predicted", F.greatest(F.lit(0.0), a + b * (F.col("last_num") + 1))
    )
    predicted, mae = F.col("predicted"), F.col("mae")
    return measured.select(
        "category",
        F.round(predicted, 2).alias("predicted"),
        F.round(F.greatest(F.lit(0.0), predicted - mae), 2).alias("lower_bound"),
        F.round(predicted + mae, 2).alias("upper_bound"),
        trend(b, p).alias("trend"),
        trend_note(b, p).alias("trend_note"),
        F.round(b, 2).alias("slope"),
        F.round("r2", 4).alias("r2_score"),
        F.round(mae, 2).alias("mae"),
        F.add_months(F.to_date(F.concat("last_month", F.lit("-01"))), 1).alias("forecast_month"),
        "history_months",
        F.transform("points", lambda q: F.struct(q["year_month"], q["total"])).alias("history"),
    )


def coverage(history: DataFrame, p: Params = _P) -> DataFrame:
    """Months and categories seen, categories forecast and skipped."""
    per_category = history.groupBy("category").agg(F.count("*").alias("n"))
    counts = per_category.agg(
        F.count("*").alias("categories"),
        F.count_if(F.col("n") >= p.min_months).alias("categories_forecast"),
        F.count_if(F.col("n") < p.min_months).alias("categories_skipped"),
    )
    months = history.agg(F.countDistinct("year_month").alias("m")).scalar()
    return counts.withColumn("months_of_data", months)


def _amount(column: str = "predicted"):
    return F.col(column).cast("decimal(18,2)")


def overview(forecasts: DataFrame) -> DataFrame:
    """Total predicted, highest and lowest category, number of forecasts.

    Among equal amounts the first label wins.
    """
    amount, label = F.col("predicted"), F.col("category")
    high = F.min(F.struct((-amount).alias("v"), label.alias("c")))
    low = F.min(F.struct(amount.alias("v"), label.alias("c")))
    return forecasts.agg(
        F.coalesce(F.sum(_amount()), F.lit(0)).cast("double").alias("total_predicted"),
        high.alias("h"),
        low.alias("l"),
        F.count("*").alias("forecasts"),
    ).select(
        "total_predicted",
        F.col("h.c").alias("highest_category"),
        (-F.col("h.v")).alias("highest_amount"),
        F.col("l.c").alias("lowest_category"),
        F.col("l.v").alias("lowest_amount"),
        "forecasts",
    )


def budget_alert(forecasts: DataFrame, p: Params = _P) -> DataFrame:
    """Alert level and message for the predicted total."""
    total, top = F.col("total_predicted"), F.col("highest_category")
    money = rupees(total)
    level = F.when(total > p.alert_high, "high").when(total > p.alert_moderate, "moderate").otherwise("good")
    message = (
        F.when(level == "high", F.concat(
            F.lit("High Spending Alert! Predicted total of "), money, F.lit(" next month is above "),
            rupees(F.lit(p.alert_high)), F.lit(". Consider reviewing your "), top, F.lit(" expenses.")))
        .when(level == "moderate", F.concat(
            F.lit("Moderate Spending: Predicted "), money, F.lit(" next month. Your biggest category is "),
            top, F.lit(".")))
        .otherwise(F.concat(
            F.lit("Good spending pattern! Predicted "), money, F.lit(" next month looks healthy.")))
    )
    return overview(forecasts).select("total_predicted", level.alias("level"), message.alias("message"))


def forecast_cards(forecasts: DataFrame, p: Params = _P, palette: dict | None = None) -> DataFrame:
    """Bars and cards of the forecast page, largest first.

    Share of the predicted total in percent (0 if the total is not positive), its
    band colour, the category colour, and the trend symbol with its note.
    """
    total = forecasts.agg(F.sum(_amount()).alias("t")).scalar().cast("double")
    share = F.when(total > 0, F.col("predicted") / total * 100).otherwise(F.lit(0.0))
    return forecasts.select(
        "category",
        F.upper("category").alias("title"),
        "predicted",
        rupees(F.col("predicted")).alias("label"),
        F.round(share, 1).alias("share_pct"),
        share_band(share, p).alias("band_color"),
        category_colour(F.col("category"), palette).alias("color"),
        F.concat_ws(" ", trend_symbol(F.col("trend")), "trend_note").alias("hover"),
        F.date_format(F.col("forecast_month").cast("date"), "yyyy-MM-dd").alias("forecast_month"),
    ).orderBy(F.desc("predicted"), "category")


def forecast_table(summary: DataFrame) -> DataFrame:
    """Detail table of saved forecasts in display form."""
    return summary.select(
        F.col("category").alias("Category"),
        F.col("forecast_month").alias("Forecast Month"),
        rupees(F.col("predicted")).alias("Predicted Amount"),
        F.coalesce(rupees(F.col("actual")), F.lit("⏳ Pending")).alias("Actual Amount"),
        F.col("created_at").alias("Generated At"),
    )
