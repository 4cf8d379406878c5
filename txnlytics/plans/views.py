"""The operators' input shapes as views over the TPC-H-like benchmark tables.

Every view covers its whole tables. Modulo rules only decide which *kind* of cell a
row gets (a bad date, a missing category), never whether the row takes part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from txnlytics.functions.keys import category_key
from txnlytics.functions.labels import lookup
from txnlytics.operators.ingest import ORDER_COLUMN
from txnlytics.params import MONEY, Params
from txnlytics.session import materialise, run_folder

# Income and transfer stand-ins among the market segments.
SEGMENT_PARAMS = Params(income_category="HOUSEHOLD", transfer_category="MACHINERY")

# FURNITURE is left out on purpose: it takes the fallback colour.
SEGMENT_COLOURS = {
    "AUTOMOBILE": "#FF6B6B",
    "BUILDING": "#4ECDC4",
    "HOUSEHOLD": "#82E0AA",
    "MACHINERY": "#AEB6BF",
}

FIXED_TIME = "2024-06-30 12:00:00"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fixed_time():
    return F.lit(FIXED_TIME).cast("timestamp")


def txn(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with their customer's market segment as category; every tenth has none."""
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    key, segment = F.col("o_orderkey"), F.col("c_mktsegment")
    category = F.when(key % 10 != 0, segment)
    return orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).select(
        key.alias("txn_id"),
        F.to_date("o_orderdate").alias("date"),
        F.concat(F.upper(segment), F.lit(" "), F.col("o_orderpriority")).alias("description"),
        F.col("o_totalprice").cast(MONEY).alias("amount"),
        category.alias("category"),
        category_key(category).alias("category_id"),
        (key % 37 == 0).alias("is_anomaly"),
        ((key % 100).cast("double") / 100).alias("confidence"),
    )


def segments(spark: SparkSession, folder: str) -> DataFrame:
    """Category dimension: the distinct market segments."""
    names = table(spark, folder, "customer").select(F.col("c_mktsegment").alias("name")).distinct()
    # Pinned, as a stored dimension would be: its size is then known to every join.
    return materialise(names, "segments").select(
        category_key("name").alias("category_id"),
        "name",
        lookup(F.col("name"), SEGMENT_COLOURS, "#888888").alias("color_hex"),
        fixed_time().alias("created_at"),
    )


#: Shapes of statement dates, by the last digit of the order key.
DATE_SHAPES = (
    "dd/MM/yyyy", "dd-MMM-yy", "d MMM yyyy", "yyyy-MM-dd", "MMM dd, yyyy",
    "yyyyMMdd", "dd.MM.yyyy", "EEE, dd MMM yyyy", "dd MMMM yyyy", "dd/MM/yyyy, HH:mm",
)


def _written_date(k):
    text = F.when(k % 97 == 0, "not-a-date")
    for digit, shape in enumerate(DATE_SHAPES):
        text = text.when(k % len(DATE_SHAPES) == digit, F.date_format("o_orderdate", shape))
    return text


def raw_txn(spark: SparkSession, folder: str, copies: bool = False) -> DataFrame:
    """Orders as messy statement text; with ``copies`` some rows occur twice.

    The second copy differs in case and spacing only and comes later in file order.
    """
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    k = F.col("o_orderkey")
    money = F.col("o_totalprice").cast(MONEY)
    rows = orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).select(
        k.alias("k"),
        _written_date(k).alias("date"),
        F.when(k % 53 == 0, "")
        .otherwise(F.concat(
            F.lit("  "), F.upper("c_mktsegment"), F.lit("   STORE REF"), k.cast("string"), F.lit(" ")))
        .alias("description"),
        F.when(k % 41 == 0, "abc")
        .when(k % 7 == 0, F.concat(F.lit("("), money.cast("string"), F.lit(")")))
        .when(k % 5 == 0, F.concat(F.lit("Rs "), F.format_number(money, 2)))
        .when(k % 11 == 0, F.concat(F.lit("₹"), money.cast("string"), F.lit(" K")))
        .when(k % 13 == 0, F.concat(F.lit("-$ "), money.cast("string")))
        .when(k % 17 == 0, F.concat(F.lit("Rs. "), (k % 1000).cast("string")))  # the dot stays
        .when(k % 19 == 0, F.concat(money.cast("string"), F.lit("5")))  # a third decimal, half-way
        .otherwise(money.cast("string"))
        .alias("amount"),
    )
    if copies:
        number = F.explode(F.when(F.col("k") % 20 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
        rows = rows.withColumn("copy", number).withColumn(
            "description", F.when(F.col("copy") == 1, F.lower("description")).otherwise(F.col("description"))
        )
    else:
        rows = rows.withColumn("copy", F.lit(0))
    return rows.withColumn(ORDER_COLUMN, F.struct("k", "copy"))


def statement(spark: SparkSession, folder: str, copies: bool = False) -> DataFrame:
    """``raw_txn`` reduced to what a statement file holds, plus the file order."""
    return raw_txn(spark, folder, copies).drop("k", "copy")


def two_column_statement(spark: SparkSession, folder: str, rows: DataFrame | None = None) -> DataFrame:
    """Orders (or some of their rows) under foreign headers, with debit and credit amounts apart."""
    rows = raw_txn(spark, folder) if rows is None else rows
    debit = F.col("k") % 2 == 0
    return rows.select(
        F.col("date").alias(" Transaction Date "),
        F.col("description").alias("NARRATION"),
        F.when(debit, F.col("amount")).otherwise("").alias("Debit Amount"),
        F.when(debit, F.lit("N/A")).otherwise(F.col("amount")).alias("Credit Amount"),
        F.when(debit, "Debit").otherwise("Credit").alias("Type"),
    )


def statement_files(spark: SparkSession, folder: str) -> str:
    """Orders, copies included, as CSV files of two layouts in one folder; every third is in the foreign layout."""
    path = run_folder(spark, "statements")
    rows = raw_txn(spark, folder, copies=True)
    foreign = F.col("k") % 3 == 0
    layouts = [
        rows.filter(~foreign).select("date", "description", "amount"),
        two_column_statement(spark, folder, rows.filter(foreign)),
    ]
    for layout in layouts:
        layout.write.mode("append").options(
            header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        ).csv(path)
    return path


def evt(spark: SparkSession, folder: str) -> DataFrame:
    """Events as transactions of skewed size; the type is the category."""
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        F.col("event_id").alias("txn_id"),
        F.to_date("ts").alias("date"),
        F.concat(kind, F.lit(" "), F.col("props")).alias("description"),
        F.col("value").cast(MONEY).alias("amount"),
        kind.alias("category"),
        category_key(kind).alias("category_id"),
        (F.col("event_id") % 37 == 0).alias("is_anomaly"),
    )


def event_kinds(spark: SparkSession, folder: str) -> DataFrame:
    """Category dimension of the events; ``error`` is missing from it."""
    names = table(spark, folder, "events").select(F.col("event_type").alias("name")).distinct()
    return materialise(names, "event-kinds").filter(F.col("name") != "error").select(
        category_key("name").alias("category_id"), "name", F.lit("#4ECDC4").alias("color_hex")
    )


def rule_detections(spark: SparkSession, folder: str) -> DataFrame:
    """Stand-in for the second detector that SQL can repeat: large events."""
    amount = F.col("amount")
    return evt(spark, folder).filter(amount > 150).select(
        "txn_id",
        F.lit("isolation_forest").alias("method"),
        F.when(amount > 300, "high").when(amount > 220, "medium").otherwise("low").alias("severity"),
        F.concat(F.lit("large value "), amount.cast("string")).alias("reason"),
        F.lit(None).cast("double").alias("z_score"),
    )


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as labelled text: language is the category."""
    return table(spark, folder, "documents").select(
        "doc_id", F.col("text").alias("description"), F.col("lang").alias("category")
    )


def gappy_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The same with missing categories and missing or blank texts."""
    k = F.col("doc_id")
    return documents(spark, folder).select(
        "doc_id",
        F.when(k % 13 == 0, F.lit(None).cast("string")).when(k % 17 == 0, "   ")
        .otherwise(F.col("description")).alias("description"),
        F.when(k % 19 != 0, F.col("category")).alias("category"),
    )


def label_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """(label, prediction): quality, predicted to be the opposite of toxic."""
    return table(spark, folder, "labels").select(
        F.col("quality").cast("string").alias("label"), (1 - F.col("toxic")).cast("string").alias("prediction")
    )
