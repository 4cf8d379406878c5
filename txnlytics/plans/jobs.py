"""Jobs over the durable store: ingest, categorise, detect, forecast."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from txnlytics.operators import anomaly, classify, forecast, iforest, ingest, storage
from txnlytics.params import CATEGORY_COLOURS, OTHER, UNCATEGORISED, Params
from txnlytics.session import materialise
from txnlytics.sources.deliveries import usable_delivery
from txnlytics.sources.statements import read_labels
from txnlytics.sources.store import TableStore, parts_in

_P = Params()

ALL_STEPS = ("classify", "detect", "forecast")


def seed_categories(spark: SparkSession, store: TableStore, colours: dict[str, str] = CATEGORY_COLOURS) -> DataFrame:
    """The fixed categories, added where missing; returns the dimension."""
    rows = spark.createDataFrame(list(colours.items()), "name string, color_hex string")
    added = materialise(storage.missing_categories(rows, store.read("categories")), "categories")
    if not added.isEmpty():
        store.append("categories", added)
    return store.read("categories")


def refresh_totals(store: TableStore, months: list[str] | None = None) -> None:
    """Month totals of the given months (all without a list) anew from their facts; other months are not read."""
    if months is None or months:
        store.update("month_totals", storage.month_totals(store.read("transactions", months)))


def store_cleaned(cleaned: DataFrame, store: TableStore | None) -> DataFrame:
    """Deduplicate pinned cleaned rows, append the unseen ones, return the run's counts.

    With ``store=None`` nothing is saved. Only months that occur in the new rows are read
    from the store, and only their totals are taken anew.
    """
    unique = materialise(ingest.dedupe(ingest.valid_rows(cleaned)), "unique")
    if store is None:
        return ingest.ingest_summary(cleaned, unique, None)
    rows = ingest.new_transactions(ingest.final_columns(unique))
    months = parts_in(rows)
    fresh = materialise(ingest.append_new(rows, store.read("transactions", months)), "fresh")
    if not fresh.isEmpty():
        store.append("transactions", fresh)
    # Also if nothing was new: a run that died between the two steps is mended by the next.
    refresh_totals(store, months)
    return ingest.ingest_summary(cleaned, unique, fresh)


def ingest_rows(raw: DataFrame, store: TableStore | None) -> DataFrame:
    """Clean raw statement rows of one layout, append the unseen ones, return the run's counts."""
    named = ingest.normalise_columns(raw)
    ingest.check_required(named)
    return store_cleaned(materialise(ingest.clean_rows(ingest.statement_columns(named)), "cleaned"), store)


def ingest_files(spark: SparkSession, path, store: TableStore | None, notes: list[str] | None = None) -> DataFrame:
    """Ingest statement files of any layouts; files that can't be used are named in ``notes``."""
    found = usable_delivery(spark, path)
    if notes is not None:
        notes += [f"{file} skipped: {problem}" for file, problem in found.problem.items()]
    cleaned = materialise(ingest.clean_rows(found.rows), "cleaned")
    if cleaned.isEmpty():
        raise ingest.ValidationError(f"statement {path} has no data rows; at least one transaction is needed.")
    return store_cleaned(cleaned, store)


def categorise(store: TableStore, model: classify.TextModel) -> DataFrame:
    """Category and confidence for every stored row without one; returns the count.

    Only months that hold such rows are rewritten; rows already categorised in them
    are carried over untouched.
    """
    spark = store.spark
    months = parts_in(storage.uncategorised(store.read("transactions")))
    if not months:
        return spark.createDataFrame([(0,)], "updated bigint")
    facts = store.read("transactions", months)
    open_rows = storage.uncategorised(facts)
    scored = classify.predict(open_rows, model).drop("top3")
    assigned = storage.apply_predictions(scored, store.read("categories"))
    updated = open_rows.agg(F.count("*").alias("updated"))
    counted = materialise(updated, "updated")
    closed = facts.filter(F.col("category_id").isNotNull())
    store.update("transactions", closed.unionByName(assigned.select(*closed.columns)))
    refresh_totals(store, months)
    return counted


def labelled_facts(store: TableStore) -> DataFrame:
    """Facts with their category name; null where there is none."""
    names = store.read("categories").select("category_id", F.col("name").alias("category"))
    return store.read("transactions").join(names, "category_id", "left")


def category_totals(store: TableStore) -> DataFrame:
    """(year_month, category, total) from the maintained month totals; no fact is read.

    Rows without a category id are left out; an id that the dimension lacks counts as ``Other``.
    """
    names = store.read("categories").select("category_id", F.col("name").alias("_name"))
    totals = store.read("month_totals").filter(F.col("category_id").isNotNull()).join(names, "category_id", "left")
    return totals.groupBy("year_month", F.coalesce("_name", F.lit(OTHER)).alias("category")).agg(
        F.sum("total").cast("double").alias("total")
    )


@dataclass
class Detection:
    merged: DataFrame
    summary: DataFrame
    breakdown: DataFrame


def find_anomalies(facts: DataFrame, p: Params = _P) -> tuple[DataFrame, int]:
    """Merged detections of both methods, written once, and the number of facts.

    The facts are read once, reduced to the four columns that the detectors use. One aggregate over
    those gives each category's moments, and with them the number of rows that the
    forest's sampling rates need; one scan draws the samples, one scores.
    """
    label = F.coalesce("category", F.lit(UNCATEGORISED)).alias("category")
    slim = materialise(facts.select("txn_id", "date", "amount", label), "slim")
    moments = materialise(anomaly.category_stats(slim), "moments")
    rows = moments.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    merged = anomaly.merge_detections(anomaly.zscore_outliers(slim, p, moments), iforest.forest_outliers(slim, p, rows))
    return materialise(merged, "detections"), rows


def detect(store: TableStore, p: Params = _P) -> Detection:
    """Run both detectors over all facts, save new anomalies and flag their rows."""
    facts = labelled_facts(store)
    merged, rows = find_anomalies(facts, p)
    stored = store.read("anomalies")
    summary = materialise(anomaly.run_summary(merged, facts, stored, rows), "detection-summary")
    breakdown = merged.groupBy("severity").agg(F.count("*").alias("n"))
    added = materialise(storage.save_anomalies(merged, stored), "new-anomalies")
    if not added.isEmpty():
        # Flags first: if the job dies in between, the next run still finds the rows new.
        hit_months = parts_in(store.read("transactions").join(added.select("txn_id"), "txn_id", "left_semi"))
        touched = store.read("transactions", hit_months)
        store.update("transactions", storage.mark_anomalous(touched, added))
        store.append("anomalies", added)
    return Detection(merged, summary, breakdown)


@dataclass
class ForecastRun:
    forecasts: DataFrame
    overview: DataFrame
    coverage: DataFrame


def run_forecast(store: TableStore, p: Params = _P, save: bool = True) -> ForecastRun:
    """Forecast every expense category and, unless told otherwise, save the results.

    The history comes from the month totals; of the saved forecasts only the months
    forecast now are read and replaced.
    """
    history = materialise(forecast.history_of_totals(category_totals(store), p), "history")
    results = materialise(forecast.forecast(history, p), "forecasts")
    if save and not results.isEmpty():
        saved = store.read("forecasts", parts_in(results, "forecast_month"))
        store.update("forecasts", storage.upsert_forecasts(results, saved, store.read("categories")))
    return ForecastRun(results, forecast.overview(results), forecast.coverage(history, p))


def train_classifier(spark: SparkSession, labels_path: str, model_path: str | None, p: Params = _P) -> dict:
    """Train on a labelled CSV file; the description itself serves as row id."""
    labelled = read_labels(spark, labels_path).withColumn("row_id", F.col("description"))
    return classify.train(labelled, "row_id", p, model_path)


@dataclass
class StatementRun:
    ingest: DataFrame
    categorised: DataFrame | None = None
    detection: Detection | None = None
    forecast: ForecastRun | None = None
    notes: list[str] = field(default_factory=list)


def run_statement(
    spark: SparkSession,
    path,
    store: TableStore,
    model_path: str | None = None,
    steps: tuple[str, ...] = ALL_STEPS,
    p: Params = _P,
) -> StatementRun:
    """Ingest files, then the chosen steps over the whole store.

    A missing model only skips categorisation.
    """
    seed_categories(spark, store)
    notes: list[str] = []
    run = StatementRun(ingest=ingest_files(spark, path, store, notes), notes=notes)
    if "classify" in steps:
        try:
            if model_path is None:
                raise FileNotFoundError("no model path given")
            run.categorised = categorise(store, classify.load_model(spark, model_path))
        except FileNotFoundError as error:
            run.notes.append(f"categorisation skipped: {error}")
    if "detect" in steps:
        run.detection = detect(store, p)
    if "forecast" in steps:
        run.forecast = run_forecast(store, p)
    return run
