"""Every operator applied to the benchmark tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from txnlytics.functions.keys import category_key
from txnlytics.functions.labels import lookup
from txnlytics.functions.text import clean_text as clean_text_of
from txnlytics.operators import anomaly, classify, forecast, iforest, ingest, reports, sampling, storage, tfidf
from txnlytics.plans import jobs, views
from txnlytics.plans.views import SEGMENT_COLOURS, SEGMENT_PARAMS
from txnlytics.session import materialise, run_folder
from txnlytics.sources.deliveries import read_deliveries
from txnlytics.sources.store import TableStore

Query = Callable[[SparkSession, str], DataFrame]

P = SEGMENT_PARAMS

_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__.removesuffix("_query")] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _iso(column: str):
    return F.date_format(column, "yyyy-MM-dd").alias(column)


def _double(column: str):
    return F.col(column).cast("double").alias(column)


# --- ingest ------------------------------------------------------------------


@query
def normalise_columns(spark, folder):
    return ingest.normalise_columns(views.two_column_statement(spark, folder))


@query
def validate_dates(spark, folder):
    rows = ingest.clean_dates(views.raw_txn(spark, folder))
    return rows.filter(F.col("date").isNotNull()).select("k", _iso("date"))


@query
def validate_amounts(spark, folder):
    rows = ingest.clean_amounts(views.raw_txn(spark, folder))
    return rows.filter(F.col("amount").isNotNull()).select("k", _double("amount"))


@query
def validate_descriptions(spark, folder):
    rows = ingest.clean_descriptions(views.raw_txn(spark, folder))
    return rows.filter(F.col("description").isNotNull()).select("k", "description")


@query
def validation_report(spark, folder):
    return ingest.validation_report(ingest.clean_rows(views.raw_txn(spark, folder)))


def _cleaned(spark, folder, copies=False):
    named = ingest.normalise_columns(views.statement(spark, folder, copies))
    return ingest.clean_rows(ingest.statement_columns(named))


@query
def ingest_clean(spark, folder):
    clean = ingest.final_columns(ingest.valid_rows(_cleaned(spark, folder)))
    return clean.select(_iso("date"), "description", _double("amount"), "raw_text")


@query
def dedupe(spark, folder):
    unique = ingest.dedupe(ingest.valid_rows(_cleaned(spark, folder, copies=True)))
    return unique.select(_iso("date"), "description", _double("amount"), "raw_text", "copies")


def _stored(spark, folder):
    """Stored transactions: every third order, already ingested."""
    rows = ingest.clean_rows(views.raw_txn(spark, folder))
    third = ingest.valid_rows(rows).filter(F.col("k") % 3 == 0)
    return ingest.new_transactions(ingest.final_columns(third))


def _fresh(spark, folder):
    cleaned = _cleaned(spark, folder, copies=True)
    unique = materialise(ingest.dedupe(ingest.valid_rows(cleaned)), "unique")  # as the job does
    rows = ingest.new_transactions(ingest.final_columns(unique))
    return unique, ingest.append_new(rows, _stored(spark, folder))


@query
def ingest_append(spark, folder):
    _, fresh = _fresh(spark, folder)
    return fresh.select(
        "txn_id", _iso("date"), "description", _double("amount"), "raw_text", "is_anomaly", "year_month"
    )


@query
def ingest_summary(spark, folder):
    unique, fresh = _fresh(spark, folder)
    return ingest.ingest_summary(_cleaned(spark, folder, copies=True), unique, fresh)


@query
def layout_ingest(spark, folder):
    """Statement files of two layouts in one folder, surveyed, scanned by layout and cleaned."""
    found = read_deliveries(spark, views.statement_files(spark, folder))
    clean = ingest.final_columns(ingest.valid_rows(ingest.clean_rows(found.rows)))
    return clean.select(_iso("date"), "description", _double("amount"), "raw_text")


@query
def preview_profile(spark, folder):
    rows = views.raw_txn(spark, folder).select("k", "date", "description", "amount")
    return ingest.preview_profile(rows, ["k"])


# --- store -------------------------------------------------------------------


@query
def txn_enriched(spark, folder):
    facts = views.txn(spark, folder).drop("category")
    return storage.transaction_rows(storage.attach_category(facts, views.segments(spark, folder)))


def _event_anomalies(spark, folder):
    """Saved z-score anomalies of the events plus some without a transaction."""
    found = anomaly.zscore_outliers(views.evt(spark, folder)).select("txn_id", "reason", "severity")
    key = F.col("event_id")
    orphans = views.table(spark, folder, "events").filter(key % 1000 == 0).select(
        (-key - 1).alias("txn_id"), F.lit("orphan").alias("reason"), F.lit("low").alias("severity")
    )
    return found.unionByName(orphans).withColumn("detected_at", views.fixed_time())


def _flagged(spark, folder):
    facts = views.evt(spark, folder)
    return storage.anomaly_summary(_event_anomalies(spark, folder), facts, views.event_kinds(spark, folder))


@query
def anomaly_summary(spark, folder):
    return _flagged(spark, folder)


def _saved_forecasts(spark, folder):
    """Monthly totals as saved forecasts; some amounts missing or zero."""
    totals = forecast.monthly_history(views.txn(spark, folder), P)
    month = F.col("month_num")
    money = F.round("total", 2).cast("decimal(12,2)")
    return totals.filter(F.col("category") != "BUILDING").select(
        category_key("category").alias("category_id"),
        F.to_date(F.concat("year_month", F.lit("-01"))).alias("forecast_month"),
        F.when(month % 3 != 0, money).alias("predicted_amount"),
        F.when(month % 2 == 0, money).otherwise(F.lit(0).cast("decimal(12,2)")).alias("actual_amount"),
        views.fixed_time().alias("created_at"),
    )


@query
def forecast_summary(spark, folder):
    known = views.segments(spark, folder).filter(F.col("name") != "FURNITURE")
    return storage.forecast_summary(_saved_forecasts(spark, folder), known)


@query
def forecast_table(spark, folder):
    saved = storage.forecast_summary(_saved_forecasts(spark, folder), views.segments(spark, folder))
    return forecast.forecast_table(saved)


@query
def forecast_upsert(spark, folder):
    """Forecasts of the last month from all before it: known categories are updated, others inserted."""
    facts = views.txn(spark, folder)
    early = facts.filter(F.col("date") < facts.agg(F.trunc(F.max("date"), "MM")).scalar())
    new = forecast.forecast(forecast.monthly_history(early, P), P)
    known = views.segments(spark, folder).filter(F.col("name") != "FURNITURE")
    state = storage.upsert_forecasts(new, _saved_forecasts(spark, folder), known, views.fixed_time())
    return state.select(
        "category_id", _iso("forecast_month"), _double("predicted_amount"), _double("actual_amount"), "action"
    )


@query
def anomaly_save(spark, folder):
    found = anomaly.zscore_outliers(views.evt(spark, folder))
    stored = views.evt(spark, folder).filter(F.col("txn_id") % 5 == 0).select("txn_id")
    added = storage.save_anomalies(found, stored, views.fixed_time())
    return added.select(
        "txn_id", "reason", "severity", F.date_format("detected_at", "yyyy-MM-dd HH:mm:ss").alias("detected_at")
    )


@query
def flag_update(spark, folder):
    facts = views.txn(spark, folder)
    hits = facts.filter(F.col("amount") > 400_000).select("txn_id")
    return storage.mark_anomalous(facts, hits).select("txn_id", "is_anomaly")


@query
def category_merge(spark, folder):
    names = views.segments(spark, folder)
    old = names.filter(F.col("name").isin("AUTOMOBILE", "BUILDING")).withColumn("color_hex", F.lit("#111111"))
    facts = views.table(spark, folder, "customer")
    incoming = facts.select(
        F.col("c_mktsegment").alias("name"), lookup(F.col("c_mktsegment"), SEGMENT_COLOURS, "#888888").alias("color_hex")
    )
    merged = storage.merge_categories(incoming, old, views.fixed_time())
    return merged.select(
        "category_id", "name", "color_hex", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at")
    )


@query
def uncategorised(spark, folder):
    rows = storage.uncategorised(views.txn(spark, folder))
    return rows.select("txn_id", _iso("date"), "description", _double("amount"))


@query
def store_profile(spark, folder):
    return storage.store_profile(views.segments(spark, folder), views.txn(spark, folder))


@query
def integrity_report(spark, folder):
    """Rules over the orders view with planted violations of most of them."""
    key = F.col("txn_id")
    facts = views.txn(spark, folder).withColumn(
        "description", F.when(key % 101 != 0, F.col("description"))
    ).withColumn("amount", F.when(key % 103 != 0, F.col("amount")))
    dimension = views.segments(spark, folder)
    known = dimension.filter(F.col("name") != "FURNITURE")
    categories = known.unionByName(known.filter(F.col("name") == "BUILDING"))
    found = facts.filter(key % 50 == 0).select(
        key.alias("txn_id"), F.when(key % 150 == 0, "critical").otherwise("low").alias("severity")
    )
    orphans = facts.filter(key % 700 == 0).select((-key - 1).alias("txn_id"), F.lit("high").alias("severity"))
    anomalies = found.unionByName(found.filter(key % 500 == 0)).unionByName(orphans)
    saved = _saved_forecasts(spark, folder)
    forecasts = saved.unionByName(saved.filter(F.month("forecast_month") == 6))
    return storage.integrity_report(facts, categories, anomalies, forecasts)


# --- reports -----------------------------------------------------------------


@query
def spend_by_category(spark, folder):
    return reports.spend_by_category(views.txn(spark, folder), P, SEGMENT_COLOURS)


@query
def category_share(spark, folder):
    return reports.category_share(views.txn(spark, folder), P, SEGMENT_COLOURS)


@query
def monthly_trend(spark, folder):
    return reports.monthly_trend(views.txn(spark, folder), P, SEGMENT_COLOURS)


@query
def monthly_total(spark, folder):
    return reports.monthly_total(views.txn(spark, folder), P)


@query
def kpi_summary(spark, folder):
    return reports.kpi_summary(views.txn(spark, folder), P)


@query
def top_category(spark, folder):
    return reports.top_category(views.txn(spark, folder), P)


@query
def category_options(spark, folder):
    return reports.category_options(views.txn(spark, folder))


@query
def txn_explorer(spark, folder):
    """The explorer under three settings of its filters and sort order."""
    rows = views.txn(spark, folder)
    return (
        reports.txn_explorer(rows)
        .withColumn("view", F.lit("all"))
        .unionByName(
            reports.txn_explorer(rows, status="normal", sort="amount_highest").withColumn("view", F.lit("normal"))
        )
        .unionByName(
            reports.txn_explorer(rows, category="BUILDING", status="anomalies", sort="amount_lowest")
            .withColumn("view", F.lit("building"))
        )
    )


@query
def explorer_footer(spark, folder):
    return reports.explorer_footer(views.txn(spark, folder), category="BUILDING", status="anomalies")


@query
def top5_expenses(spark, folder):
    return reports.top_expenses(views.txn(spark, folder), P)


@query
def anomaly_kpis(spark, folder):
    return reports.anomaly_kpis(_flagged(spark, folder))


@query
def anomaly_search(spark, folder):
    return reports.anomaly_search(_flagged(spark, folder), ["high", "medium"], "CLICK|purch", "severity")


@query
def anomaly_search_footer(spark, folder):
    return reports.anomaly_search_footer(_flagged(spark, folder), ["high", "medium"], "CLICK|purch")


@query
def anomaly_scatter(spark, folder):
    facts = views.evt(spark, folder)
    saved = anomaly.zscore_outliers(facts).select("txn_id", "severity")
    return reports.anomaly_scatter(storage.mark_anomalous(facts, saved), saved)


@query
def label_distribution(spark, folder):
    return reports.label_distribution(views.gappy_documents(spark, folder))


# --- anomalies ---------------------------------------------------------------


@query
def txn_features(spark, folder):
    rows = anomaly.txn_features(views.evt(spark, folder))
    return rows.select("txn_id", "day_of_week", "day_of_month", "month", F.round("amount_log", 6).alias("amount_log"))


@query
def category_stats(spark, folder):
    stats = anomaly.category_stats(views.evt(spark, folder))
    return stats.select("category", "n", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"))


@query
def zscore(spark, folder):
    return anomaly.zscore_outliers(views.evt(spark, folder)).select("txn_id", "method", "severity", "z_score")


@query
def zscore_reason(spark, folder):
    return anomaly.zscore_outliers(views.evt(spark, folder)).select("txn_id", "reason")


def _merged_by_rule(spark, folder):
    first = anomaly.zscore_outliers(views.evt(spark, folder))
    return anomaly.merge_detections(first, views.rule_detections(spark, folder))


@query
def anomaly_merge(spark, folder):
    return _merged_by_rule(spark, folder)


@query
def severity_breakdown(spark, folder):
    return reports.severity_breakdown(_merged_by_rule(spark, folder))


@query
def detection_summary(spark, folder):
    """Counts of a detection run whose second detector is the SQL-repeatable rule."""
    facts = views.evt(spark, folder)
    stored = facts.filter(F.col("txn_id") % 5 == 0).select("txn_id")
    return anomaly.run_summary(_merged_by_rule(spark, folder), facts, stored)


@query
def iforest_query(spark, folder):
    return iforest.forest_outliers(views.evt(spark, folder)).drop("z_score")


@query
def anomaly_run_summary(spark, folder):
    facts = views.evt(spark, folder)
    stored = facts.filter(F.col("txn_id") % 5 == 0).select("txn_id")
    merged, rows = jobs.find_anomalies(facts)
    return anomaly.run_summary(merged, facts, stored, rows)


# --- forecast ----------------------------------------------------------------


def _history(spark, folder):
    return forecast.monthly_history(views.txn(spark, folder), P)


def _forecasts(spark, folder):
    return forecast.forecast(_history(spark, folder), P)


@query
def monthly_history(spark, folder):
    return _history(spark, folder)


@query
def month_number(spark, folder):
    return forecast.month_numbers(_history(spark, folder).select("year_month"))


@query
def forecast_query(spark, folder):
    return _forecasts(spark, folder).withColumn("forecast_month", _iso("forecast_month")).drop("history")


@query
def forecast_coverage(spark, folder):
    return forecast.coverage(_history(spark, folder), P)


@query
def forecast_overview(spark, folder):
    return forecast.overview(_forecasts(spark, folder))


@query
def budget_alert(spark, folder):
    return forecast.budget_alert(_forecasts(spark, folder), P)


@query
def forecast_cards(spark, folder):
    return forecast.forecast_cards(_forecasts(spark, folder), P, SEGMENT_COLOURS)


# --- text and classifier -------------------------------------------------------


@query
def clean_text(spark, folder):
    rows = views.documents(spark, folder)
    return rows.select("doc_id", clean_text_of(F.col("description")).alias("cleaned"))


@query
def ngram_vocab(spark, folder):
    vocab = tfidf.vocabulary(views.documents(spark, folder))
    return vocab.select("term", "n_total", "n_docs", F.round("idf", 6).alias("idf"))


@query
def tfidf_weights(spark, folder):
    weights = tfidf.tfidf_weights(views.documents(spark, folder), "doc_id")
    return weights.select("doc_id", "term", F.round("weight", 6).alias("weight"))


@query
def class_weights(spark, folder):
    weights = classify.class_weights(views.documents(spark, folder))
    return weights.select("category", "n", F.round("weight", 6).alias("weight"))


@query
def stratified_split(spark, folder):
    split = sampling.stratified_split(views.documents(spark, folder), "category", "doc_id")
    return split.select("doc_id", "category", "split")


@query
def cv_folds(spark, folder):
    folds = sampling.stratified_folds(views.documents(spark, folder), "category", "doc_id")
    return folds.select("doc_id", "category", "fold")


@query
def classification_report(spark, folder):
    return classify.classification_report(views.label_predictions(spark, folder))


def _scored(spark, folder, learn=classify.fit_centroids):
    docs = views.documents(spark, folder)
    return classify.predict(docs, learn(docs))


@query
def classify_batch(spark, folder):
    return _scored(spark, folder).select("doc_id", "predicted_category", "predicted_confidence")


@query
def classify_fitted(spark, folder):
    """The same with the fitted model, whose optimiser SQL can't repeat."""
    return _scored(spark, folder, classify.fit).select("doc_id", "predicted_category", "predicted_confidence")


@query
def predict_top3(spark, folder):
    top = _scored(spark, folder).select("doc_id", F.inline("top3"))
    return top.select("doc_id", "category", "probability")


@query
def classify_update(spark, folder):
    """Documents as facts, a fifth of them without a category: state after the update."""
    docs = views.documents(spark, folder)
    facts = docs.select(
        "doc_id",
        "description",
        F.when(F.col("doc_id") % 5 != 0, category_key("category")).alias("category_id"),
        F.lit(None).cast("double").alias("confidence"),
    )
    model = classify.fit_centroids(docs.filter(F.col("doc_id") % 5 != 0))
    known = docs.select(F.col("category").alias("name")).distinct().select(
        category_key("name").alias("category_id"), "name"
    )
    scored = classify.predict(storage.uncategorised(facts), model).drop("top3")
    done = storage.apply_predictions(scored, known)
    rest = facts.filter(F.col("category_id").isNotNull())
    return rest.unionByName(done.select(*rest.columns)).select("doc_id", "category_id", "confidence")


@query
def statement_run(spark, folder):
    """The whole run over statement files: ingest, categorise, detect and forecast on a store of its own; its figures.

    The model learns from the categorised orders.
    """
    store = TableStore(spark, run_folder(spark, "store"))
    model = run_folder(spark, "model")
    classify.save_model(spark, classify.fit_centroids(views.txn(spark, folder).select("description", "category")), model)
    jobs.seed_categories(spark, store, SEGMENT_COLOURS | {"FURNITURE": "#888888"})
    run = jobs.run_statement(spark, views.statement_files(spark, folder), store, model, p=P)

    def figures(step: str, df, *columns: str):
        pairs = [F.struct(F.lit(step).alias("step"), F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns]
        return df.select(F.inline(F.array(*pairs)))

    counts = ("total_read", "total_clean", "total_dropped", "duplicates_removed", "db_inserted", "db_skipped")
    found = run.detection.summary
    parts = [
        figures("ingest", run.ingest, *counts),
        figures("categorise", run.categorised, "updated"),
        figures("detect", found, "zscore_flagged", "iforest_flagged", "total_flagged", "new_records", "total_transactions"),
        figures("store", store.read("transactions").agg(F.count_if("is_anomaly").alias("flagged")), "flagged"),
        run.forecast.forecasts.select(F.lit("forecast").alias("step"), F.col("category").alias("name"), F.col("predicted").alias("value")),
        figures("forecast", run.forecast.coverage, "months_of_data", "categories_forecast"),
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def train_summary(spark, folder):
    return classify.train(views.documents(spark, folder), "doc_id")["summary"]
