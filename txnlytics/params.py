"""Domain constants, tunable parameters and table schemas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- Fixed values: results depend on these being exactly as listed -----------

REQUIRED_COLUMNS = ("date", "description", "amount")

HEADER_ALIASES = {
    "transaction date": "date",
    "trans date": "date",
    "txn date": "date",
    "value date": "date",
    "posting date": "date",
    "dt": "date",
    "transaction description": "description",
    "narration": "description",
    "particulars": "description",
    "remarks": "description",
    "details": "description",
    "memo": "description",
    "debit amount": "amount",
    "credit amount": "amount",
    "transaction amount": "amount",
    "txn amount": "amount",
    "withdrawl": "amount",
    "withdrawal": "amount",
}

STOPWORDS = ("the", "a", "an", "and", "or", "of", "to", "for", "ltd", "pvt")

CATEGORY_COLOURS = {
    "Food & Dining": "#FF6B6B",
    "Transport": "#4ECDC4",
    "Utilities": "#45B7D1",
    "Rent & Housing": "#96CEB4",
    "Shopping": "#FFEAA7",
    "Healthcare": "#DDA0DD",
    "Entertainment": "#98D8C8",
    "Education": "#F7DC6F",
    "Salary & Income": "#82E0AA",
    "Transfer": "#AEB6BF",
    "Other": "#D7DBDD",
}

SEVERITY_COLOURS = {"high": "#E74C3C", "medium": "#F39C12", "low": "#F1C40F"}

TREND_SYMBOLS = {"increasing": "↑", "decreasing": "↓", "stable": "→"}

SEVERITIES = ("high", "medium", "low")

DEFAULT_COLOUR = "#888888"
FALLBACK_COLOUR = "#CCCCCC"
UNCATEGORISED = "Uncategorized"
UNKNOWN = "Unknown"
OTHER = "Other"

MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

# Tokens a CSV cell may hold to mean "missing".
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# --- Tunable parameters ------------------------------------------------------


@dataclass(frozen=True)
class Params:
    """Every threshold an operator uses; the defaults suit rupee statements."""

    income_category: str = "Salary & Income"
    transfer_category: str = "Transfer"

    z_threshold: float = 2.5
    z_medium: float = 3.5
    z_high: float = 5.0
    z_min_rows: int = 3

    contamination: float = 0.05
    trees: int = 100
    tree_rows: int = 256
    forest_seed: int = 42
    forest_min_rows: int = 10
    forest_medium: float = -0.1
    forest_high: float = -0.2

    min_months: int = 3
    trend_band: float = 500.0
    alert_moderate: float = 100_000.0
    alert_high: float = 200_000.0
    share_medium: float = 15.0
    share_high: float = 30.0

    vocabulary: int = 3000
    max_df: float = 0.95
    inverse_penalty: float = 5.0
    max_iter: int = 2000
    centroid_sharpness: float = 20.0
    test_fraction: float = 0.2
    folds: int = 5
    split_seed: int = 42

    @property
    def non_expense(self) -> tuple[str, str]:
        return self.income_category, self.transfer_category


# --- Table schemas -----------------------------------------------------------

MONEY = T.DecimalType(12, 2)
# What is added up over a month, which outgrows a single amount; the type of a sum over MONEY.
TOTAL = T.DecimalType(22, 2)

CATEGORIES = T.StructType([
    T.StructField("category_id", T.LongType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("color_hex", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

TRANSACTIONS = T.StructType([
    T.StructField("txn_id", T.StringType(), False),
    T.StructField("date", T.DateType(), False),
    T.StructField("description", T.StringType(), False),
    T.StructField("amount", MONEY, False),
    T.StructField("category_id", T.LongType()),
    T.StructField("is_anomaly", T.BooleanType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("raw_text", T.StringType()),
    T.StructField("uploaded_at", T.TimestampType()),
    T.StructField("year_month", T.StringType(), False),
])

ANOMALIES = T.StructType([
    T.StructField("txn_id", T.StringType(), False),
    T.StructField("reason", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("detected_at", T.TimestampType()),
])

FORECASTS = T.StructType([
    T.StructField("category_id", T.LongType(), False),
    T.StructField("forecast_month", T.DateType(), False),
    T.StructField("predicted_amount", TOTAL),
    T.StructField("actual_amount", TOTAL),
    T.StructField("created_at", T.TimestampType()),
])

MONTH_TOTALS = T.StructType([
    T.StructField("category_id", T.LongType()),
    T.StructField("total", TOTAL),
    T.StructField("n", T.LongType()),
    T.StructField("year_month", T.StringType(), False),
])

FILE_LOG = T.StructType([
    T.StructField("file", T.StringType(), False),
    T.StructField("modified", T.TimestampType()),
    T.StructField("layout", T.StringType()),
    T.StructField("problem", T.StringType()),
    T.StructField("total_read", T.LongType()),
    T.StructField("total_dropped", T.LongType()),
    T.StructField("logged_at", T.TimestampType()),
])
