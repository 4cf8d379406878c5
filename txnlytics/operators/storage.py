"""State changes as pure functions: (new rows, old rows) -> rows to write."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from txnlytics.functions.keys import category_key
from txnlytics.params import DEFAULT_COLOUR, SEVERITIES, TOTAL, UNCATEGORISED, UNKNOWN


def attach_category(
    facts: DataFrame, categories: DataFrame, label: str = UNCATEGORISED, colour: str = DEFAULT_COLOUR
) -> DataFrame:
    """Category name and colour on every row, defaults where there is none.

    The dimension should be a plain or materialised scan: the optimiser then
    broadcasts it by its measured size. A larger one is shuffled, and a hot or null
    key on the fact side is split by the adaptive skew handling.
    """
    dimension = categories.select("category_id", F.col("name").alias("_name"), F.col("color_hex").alias("_colour"))
    return (
        facts.join(dimension, "category_id", "left")
        .withColumn("category", F.coalesce("_name", F.lit(label)))
        .withColumn("category_color", F.coalesce("_colour", F.lit(colour)))
        .drop("_name", "_colour")
    )


def transaction_rows(enriched: DataFrame) -> DataFrame:
    """Report form of enriched facts; a zero confidence counts as none."""
    uploaded = [F.date_format("uploaded_at", "yyyy-MM-dd HH:mm:ss").alias("uploaded_at")]
    return enriched.select(
        "txn_id",
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        "description",
        F.col("amount").cast("double").alias("amount"),
        "category",
        "category_color",
        "is_anomaly",
        F.when(F.col("confidence") != 0, F.bround("confidence", 2)).alias("confidence"),
        *(uploaded if "uploaded_at" in enriched.columns else []),
    )


def anomaly_summary(anomalies: DataFrame, facts: DataFrame, categories: DataFrame) -> DataFrame:
    """Flagged transactions with their details; anomalies without a fact are skipped."""
    joined = anomalies.join(facts.select("txn_id", "date", "description", "amount", "category_id"), "txn_id")
    return attach_category(joined, categories, label=UNKNOWN).select(
        "txn_id",
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        "description",
        F.col("amount").cast("double").alias("amount"),
        "category",
        "severity",
        "reason",
        F.date_format("detected_at", "yyyy-MM-dd HH:mm:ss").alias("detected_at"),
    )


def forecast_summary(forecasts: DataFrame, categories: DataFrame) -> DataFrame:
    """Saved forecasts by category name; missing predicted is 0, zero actual is none."""
    return attach_category(forecasts, categories, label=UNKNOWN).select(
        "category",
        F.date_format("forecast_month", "yyyy-MM-dd").alias("forecast_month"),
        F.coalesce(F.col("predicted_amount").cast("double"), F.lit(0.0)).alias("predicted"),
        F.nullif(F.col("actual_amount").cast("double"), F.lit(0.0)).alias("actual"),
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
    )


def save_anomalies(detections: DataFrame, stored: DataFrame, now=None) -> DataFrame:
    """Anomaly rows to insert: detections whose transaction has none yet."""
    known = stored.select("txn_id").distinct()
    return detections.join(known, "txn_id", "left_anti").select(
        "txn_id", "reason", "severity", (F.current_timestamp() if now is None else now).alias("detected_at")
    )


def mark_anomalous(facts: DataFrame, inserted: DataFrame) -> DataFrame:
    """Facts with ``is_anomaly`` switched on where a detection was inserted; never off."""
    hits = inserted.select("txn_id").distinct().withColumn("_hit", F.lit(True))
    return (
        facts.join(hits, "txn_id", "left")
        .withColumn("is_anomaly", F.coalesce("_hit", "is_anomaly"))
        .drop("_hit")
        .select(*facts.columns)
    )


def upsert_forecasts(new: DataFrame, old: DataFrame, categories: DataFrame, now=None) -> DataFrame:
    """Full new state of saved forecasts, with ``action`` telling what happened to each row.

    Key is (category, month). An update changes the predicted amount only; new
    forecasts of categories outside the dimension are skipped.
    """
    ids = categories.select(F.col("name").alias("category"), "category_id")
    incoming = new.join(ids, "category").select(
        "category_id", "forecast_month", F.col("predicted").cast(TOTAL).alias("_new")
    )
    created = F.current_timestamp() if now is None else now
    return incoming.join(old, ["category_id", "forecast_month"], "full_outer").select(
        "category_id",
        "forecast_month",
        F.coalesce("_new", "predicted_amount").alias("predicted_amount"),
        "actual_amount",
        F.when(F.col("created_at").isNull() & F.col("_new").isNotNull(), created)
        .otherwise(F.col("created_at"))
        .alias("created_at"),
        F.when(F.col("_new").isNull(), "kept")
        .when(F.col("created_at").isNull(), "inserted")
        .otherwise("updated")
        .alias("action"),
    )


def apply_predictions(scored: DataFrame, categories: DataFrame) -> DataFrame:
    """Scored facts with the predicted category's id (null if unknown) and confidence."""
    ids = categories.select(F.col("name").alias("predicted_category"), F.col("category_id").alias("_id"))
    return (
        scored.drop("category_id", "confidence")
        .join(ids, "predicted_category", "left")
        .withColumnRenamed("_id", "category_id")
        .withColumnRenamed("predicted_confidence", "confidence")
        .drop("predicted_category")
    )


def uncategorised(facts: DataFrame) -> DataFrame:
    return facts.filter(F.col("category_id").isNull())


def month_totals(facts: DataFrame) -> DataFrame:
    """(year_month, category_id, total, n): folded before the shuffle, so hot categories are cheap."""
    return facts.groupBy("year_month", "category_id").agg(
        F.sum("amount").cast(TOTAL).alias("total"), F.count("*").alias("n")
    )


def missing_categories(new: DataFrame, old: DataFrame, now=None) -> DataFrame:
    """Dimension rows to add: the (name, colour) rows whose name the dimension lacks."""
    missing = new.groupBy("name").agg(F.min("color_hex").alias("color_hex")).join(
        old.select("name"), "name", "left_anti"
    )
    return missing.select(
        category_key("name").alias("category_id"),
        "name",
        F.coalesce("color_hex", F.lit(DEFAULT_COLOUR)).alias("color_hex"),
        (F.current_timestamp() if now is None else now).alias("created_at"),
    )


def merge_categories(new: DataFrame, old: DataFrame, now=None) -> DataFrame:
    """Dimension after adding the (name, colour) rows whose name it lacks."""
    added = missing_categories(new, old, now)
    return old.select("category_id", "name", "color_hex", "created_at").unionByName(added)


def store_profile(categories: DataFrame, facts: DataFrame) -> DataFrame:
    """One row: categories, transactions, flagged transactions."""
    return facts.agg(
        F.count("*").alias("transactions"),
        F.count_if(F.col("is_anomaly")).alias("anomalies"),
    ).withColumn("categories", categories.agg(F.count("*").alias("n")).scalar())


def integrity_report(
    facts: DataFrame, categories: DataFrame, anomalies: DataFrame, forecasts: DataFrame
) -> DataFrame:
    """(rule, violations) for every declared constraint; zero rows never fail a rule.

    Each table is scanned once. A row says what it means for every rule it takes part in: a
    tag (rule, kind of rule, key, whether it is a parent). All tags meet in one
    grouped count, folded before the shuffle, so one heavily repeated key costs one row per
    task. A key breaks a uniqueness rule by its surplus rows and a reference rule by its children
    if no parent has it; null and domain rules have tags of violating rows only.
    """
    schema = "struct<rule string, kind string, key string, parent boolean>"

    def tag(rule: str, kind: str, key=None, parent: bool = False, when=None):
        key = F.lit("") if key is None else key
        made = F.struct(F.lit(rule), F.lit(kind), key.cast("string"), F.lit(parent)).cast(schema)
        return made if when is None else F.when(when, made)

    def null(rule: str, column: str):
        return tag(rule, "never", when=F.col(column).isNull())

    def child(rule: str, column: str):
        return tag(rule, "exists", F.col(column), when=F.col(column).isNotNull())

    def parent(rule: str, column: str):
        return tag(rule, "exists", F.col(column), parent=True, when=F.col(column).isNotNull())

    def unique(rule: str, *columns: str):
        # Nulls are equal to each other, and to nothing else.
        return tag(rule, "unique", F.to_json(F.struct(*columns)))

    references = ("transaction category exists", "forecast category exists", "anomaly transaction exists")
    tagged = [
        (facts, [
            null("transaction date not null", "date"),
            null("transaction description not null", "description"),
            null("transaction amount not null", "amount"),
            child(references[0], "category_id"),
            parent(references[2], "txn_id"),
        ]),
        (categories, [
            null("category name not null", "name"),
            unique("category name unique", "name"),
            parent(references[0], "category_id"),
            parent(references[1], "category_id"),
        ]),
        (anomalies, [
            null("anomaly transaction not null", "txn_id"),
            tag("anomaly severity in domain", "never", when=F.col("severity").isNotNull() & ~F.col("severity").isin(*SEVERITIES)),
            unique("one anomaly per transaction", "txn_id"),
            child(references[2], "txn_id"),
        ]),
        (forecasts, [
            null("forecast category not null", "category_id"),
            null("forecast month not null", "forecast_month"),
            unique("one forecast per category and month", "category_id", "forecast_month"),
            child(references[1], "category_id"),
        ]),
    ]
    rules = [
        "transaction date not null", "transaction description not null", "transaction amount not null", "category name not null",
        "anomaly transaction not null", "anomaly severity in domain", "forecast category not null", "forecast month not null",
        "category name unique", "one anomaly per transaction", "one forecast per category and month", *references,
    ]
    counts = None
    for table, tags in tagged:
        rows = table.select(F.inline(F.array_compact(F.array(*tags))))
        counts = rows if counts is None else counts.unionByName(rows)
    keys = counts.groupBy("rule", "kind", "key").agg(
        F.count_if(~F.col("parent")).alias("n"), F.max("parent").alias("found")
    )
    broken = (
        F.when(F.col("kind") == "unique", F.col("n") - 1)
        .when(F.col("kind") == "exists", F.when(F.col("found"), 0).otherwise(F.col("n")))
        .otherwise(F.col("n"))
    )
    found = keys.groupBy("rule").agg(F.sum(broken).alias("violations"))
    every = facts.sparkSession.createDataFrame([(rule,) for rule in rules], "rule string")
    return every.join(found, "rule", "left").select("rule", F.coalesce("violations", F.lit(0).cast("bigint")).alias("violations"))
