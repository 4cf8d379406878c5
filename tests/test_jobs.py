from datetime import date

import pytest
from pyspark.sql import functions as F

from txnlytics.functions.keys import category_key
from txnlytics.operators import classify, storage
from txnlytics.params import CATEGORY_COLOURS, Params
from txnlytics.plans import jobs, pages
from txnlytics.sources.store import TableStore
from txnlytics.streaming import file_drop

FEW_TREES = Params(trees=10)

HEADER = "Transaction Date,Description,Amount,Type\n"
MERCHANTS = ["KFC LUNCH", "LESCO ELECTRICITY BILL", "UBER TRIP"]
NAMES = ["Food & Dining", "Utilities", "Transport"]


def statement(months=4, per_month=12, outlier=True):
    lines = [
        f"{1 + i:02d}/{m:02d}/2024,{MERCHANTS[i % 3]} {'ABCDEFGHIJKL'[i] * 3},{100 * m + i}.50,Debit"
        for m in range(1, months + 1)
        for i in range(per_month)
    ]
    lines += [lines[0], "bad,NOTHING,5,Debit", "01/01/2024,,5,Debit", "01/01/2024,NO AMOUNT,abc,Debit"]
    if outlier:
        lines.append("28/02/2024,UBER TRIP OVERSEAS,900000.00,Debit")
    return HEADER + "\n".join(lines) + "\n"


@pytest.fixture(scope="module")
def model_path(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("model")
    labels = folder / "labels.csv"
    texts = {
        "Food & Dining": ["kfc lunch", "kfc dinner", "burger lunch", "pizza dinner", "kfc meal"],
        "Utilities": ["lesco bill", "electricity bill", "gas bill", "lesco electricity", "water bill"],
        "Transport": ["uber trip", "careem trip", "uber ride", "fuel pump", "uber airport trip"],
    }
    labels.write_text("description,category\n" + "".join(f"{t},{c}\n" for c, ts in texts.items() for t in ts))
    path = str(folder / "saved")
    result = jobs.train_classifier(spark, str(labels), path, Params(folds=2))
    assert result["summary"].first().training_size == 12
    return path


@pytest.fixture(scope="module")
def ran(spark, model_path, tmp_path_factory):
    folder = tmp_path_factory.mktemp("run")
    (folder / "in").mkdir()
    (folder / "in" / "a.csv").write_text(statement())
    store = TableStore(spark, str(folder / "store"))
    return store, jobs.run_statement(spark, str(folder / "in"), store, model_path, p=FEW_TREES), str(folder / "in")


class TestRun:
    def test_ingest_counts(self, ran):
        row = ran[1].ingest.first()
        assert (row.total_read, row.total_dropped, row.duplicates_removed) == (53, 3, 1)
        assert (row.total_clean, row.db_inserted, row.db_skipped, row.drop_rate) == (49, 49, 0, 5.7)

    def test_every_row_is_categorised(self, ran):
        store, run, _ = ran
        assert run.categorised.first().updated == 49
        rows = jobs.labelled_facts(store).select("description", "category", "confidence").collect()
        want = dict(zip(["kfc", "lesco", "uber"], NAMES))
        assert len(rows) == 49 and all(r.category == want[r.description.split()[0]] for r in rows)
        assert all(0 < r.confidence <= 1 for r in rows)

    def test_outlier_is_stored_and_flagged(self, ran):
        store, run, _ = ran
        flagged = store.read("transactions").filter("is_anomaly").collect()
        assert {"uber trip overseas"} <= {r.description for r in flagged}
        assert {r.txn_id for r in flagged} == {r.txn_id for r in store.read("anomalies").collect()}
        summary = run.detection.summary.first()
        assert summary.total_transactions == 49 and summary.new_records == summary.total_flagged == len(flagged)

    def test_forecasts_are_saved(self, ran):
        store, run, _ = ran
        assert run.forecast.coverage.first().categories_forecast == 3
        saved = store.read("forecasts").collect()
        assert {r.forecast_month for r in saved} == {date(2024, 5, 1)} and len(saved) == 3

    def test_dashboard_page(self, ran):
        page = pages.dashboard(ran[0], category="Transport", sort="amount_highest")
        assert page["kpis"].first().transactions == 49
        assert page["top_category"].first().category == "Transport"
        assert page["explorer"].first().Description == "uber trip overseas"
        assert page["explorer_footer"].first().matching == 17
        assert page["top_expenses"].first().label == "Rs 900,000"
        assert page["shares"].count() == 3 and page["rows"].count() == 49

    def test_anomaly_page(self, ran):
        page = pages.anomalies(ran[0], search="OVERSEAS")
        card = page["cards"].first()
        assert (card.title, card.category) == ("Uber Trip Overseas", "Transport")
        assert page["footer"].first().shown == 1
        assert page["kpis"].first().flagged == page["rows"].count()
        assert page["scatter"].filter("series = 'Anomaly'").count() == page["rows"].count()

    def test_forecast_page(self, ran):
        page = pages.forecasts(ran[0])
        overview = page["overview"].first()
        assert overview.forecasts == 3 and page["alert"].first().total_predicted == overview.total_predicted
        cards = page["cards"].collect()
        assert cards[0].hover == "→ Based on historical linear trend" and cards[0].forecast_month == "2024-05-01"
        assert {r["Actual Amount"] for r in page["table"].collect()} == {"⏳ Pending"}
        assert pages.forecasts(ran[0], month="2030-01-01")["overview"].first().forecasts == 0

    def test_second_run_changes_nothing(self, spark, ran, model_path):
        store, _, source = ran
        before = sorted(store.read("transactions").drop("uploaded_at").collect(), key=repr)
        again = jobs.run_statement(spark, source, store, model_path, p=FEW_TREES)
        assert again.ingest.first().db_inserted == 0 and again.ingest.first().db_skipped == 49
        assert again.categorised.first().updated == 0
        assert again.detection.summary.first().new_records == 0
        assert sorted(store.read("transactions").drop("uploaded_at").collect(), key=repr) == before
        assert store.read("forecasts").count() == 3

    def test_categories_are_seeded_once(self, ran):
        rows = ran[0].read("categories").collect()
        assert {r.name: r.color_hex for r in rows} == CATEGORY_COLOURS and len(rows) == 11


def test_missing_model_only_skips_its_step(spark, tmp_path):
    (tmp_path / "a.csv").write_text(statement(months=1, outlier=False))
    store = TableStore(spark, str(tmp_path / "store"))
    run = jobs.run_statement(spark, str(tmp_path / "a.csv"), store, str(tmp_path / "none"), steps=("classify",))
    assert run.categorised is None and "skipped" in run.notes[0]
    assert store.read("transactions").filter("category_id is null").count() == 12


def test_ingest_without_saving(spark, tmp_path):
    (tmp_path / "a.csv").write_text(statement(months=1, outlier=False))
    row = jobs.ingest_files(spark, str(tmp_path / "a.csv"), None).first()
    assert (row.total_clean, row.db_inserted, row.db_skipped) == (12, 0, 0)


def test_uploaded_frame(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    raw = spark.createDataFrame([("1/2/2024", "A", "5"), ("1/2/2024", "a ", "5.00")], "dt string, memo string, withdrawal string")
    row = jobs.ingest_rows(raw, store).first()
    assert (row.total_read, row.duplicates_removed, row.db_inserted) == (2, 1, 1)
    assert store.read("transactions").first().raw_text == "a"


def test_file_drop_picks_up_each_file_once(spark, tmp_path):
    drop, landing, check = (str(tmp_path / n) for n in ("drop", "landing", "check"))
    (tmp_path / "drop").mkdir()
    store = TableStore(spark, str(tmp_path / "store"))

    def take():
        query = file_drop.start_file_drop(spark, drop, landing, check)
        assert query.awaitTermination(120) and query.exception() is None
        return file_drop.absorb_landing(spark, landing, store).first()

    (tmp_path / "drop" / "a.csv").write_text(statement(months=1, outlier=False))
    first = take()
    assert (first.total_read, first.db_inserted, first.duplicates_removed) == (16, 12, 1)
    # Another layout, a name with blanks, and two files that can't be used.
    (tmp_path / "drop" / "b [2].csv").write_text(statement(months=2, outlier=False).replace(HEADER, "Dt,Particulars,Withdrawal,Kind\n"))
    (tmp_path / "drop" / "bad.csv").write_text("when,what\n1/1/2024,x\n")
    (tmp_path / "drop" / "empty.csv").write_text("")
    second = take()
    assert (second.total_read, second.db_inserted, second.db_skipped) == (28, 12, 12)
    assert tuple(take()) == (0, 0, 0, 0.0, 0, 0, 0)
    assert store.read("transactions").count() == 24
    log = {r.file.rsplit("/", 1)[1]: r for r in store.read("file_log").collect()}
    assert {f: (r.total_read, r.total_dropped) for f, r in log.items()} == {
        "a.csv": (16, 3), "b%20%5B2%5D.csv": (28, 3), "bad.csv": (0, 0)
    }  # a scan passes over empty files, so one is taken up when it has content
    assert "Missing required columns" in log["bad.csv"].problem and log["a.csv"].layout == HEADER.strip()


def test_month_totals_follow_appends_and_equal_a_recount(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    jobs.seed_categories(spark, store)

    def total_rows():
        return sorted(((r.year_month, r.category_id, r.total, r.n) for r in store.read("month_totals").collect()), key=repr)

    def recount():
        rows = storage.month_totals(store.read("transactions")).collect()
        return sorted(((r.year_month, r.category_id, r.total, r.n) for r in rows), key=repr)

    (tmp_path / "a.csv").write_text(statement(months=3, outlier=False))
    jobs.ingest_files(spark, str(tmp_path / "a.csv"), store)
    assert total_rows() == recount() and len(total_rows()) == 3
    untouched = [f for f in store.read("month_totals").inputFiles() if "2024-01" in f]
    (tmp_path / "b.csv").write_text(HEADER + "05/03/2024,NEW SHOP,10.00,Debit\n")
    jobs.ingest_files(spark, str(tmp_path / "b.csv"), store)
    assert total_rows() == recount() and sum(n for *_, n in total_rows()) == 37
    assert [f for f in store.read("month_totals").inputFiles() if "2024-01" in f] == untouched

    # Rows of a category that the dimension lacks count as Other; rows without one do not count.
    facts = store.read("transactions")
    some = F.when(F.col("description").startswith("kfc"), category_key(F.lit("Food & Dining"))).when(F.col("description").startswith("uber"), F.lit(-5))
    store.update("transactions", facts.withColumn("category_id", some))
    jobs.refresh_totals(store)
    assert total_rows() == recount()
    run = jobs.run_forecast(store)
    got = {r.category: (r.history_months, [h.total for h in r.history]) for r in run.forecasts.collect()}
    food = [sum(100 * m + i + 0.5 for i in range(0, 12, 3)) for m in (1, 2, 3)]
    rides = [sum(100 * m + i + 0.5 for i in range(2, 12, 3)) for m in (1, 2, 3)]
    assert got == {"Food & Dining": (3, food), "Other": (3, rides)}
    assert store.read("forecasts").count() == 2  # the seeded dimension has an Other of its own


def test_forecasts_beyond_a_single_amount_are_saved(spark, tmp_path):
    """Month totals outgrow DECIMAL(12,2); a store whose forecasts were saved in that type is read and updated."""
    store = TableStore(spark, str(tmp_path / "store"))
    jobs.seed_categories(spark, store)
    key = category_key(F.lit("Transport"))
    saved = spark.range(2).select(
        key.alias("category_id"), F.lit("12.50").cast("decimal(12,2)").alias("predicted_amount"),
        F.lit("7.25").cast("decimal(12,2)").alias("actual_amount"), F.current_timestamp().alias("created_at"),
        F.add_months(F.lit(date(2024, 4, 1)), F.col("id").cast("int")).alias("forecast_month"),
    )
    saved.write.partitionBy("forecast_month").parquet(f"{store.root}/forecasts")
    lines = [f"0{d}/0{m}/2024,UBER TRIP {d},9000000000.25,Debit" for m in (1, 2, 3) for d in (1, 2, 3, 4)]
    (tmp_path / "a.csv").write_text(HEADER + "\n".join(lines) + "\n")
    jobs.ingest_files(spark, str(tmp_path / "a.csv"), store)
    store.update("transactions", store.read("transactions").withColumn("category_id", key))
    jobs.refresh_totals(store)
    run = jobs.run_forecast(store)
    assert run.forecasts.first().predicted == 36000000001.0
    got = {r.forecast_month: (str(r.predicted_amount), str(r.actual_amount)) for r in store.read("forecasts").collect()}
    assert got == {date(2024, 4, 1): ("36000000001.00", "7.25"), date(2024, 5, 1): ("12.50", "7.25")}


def test_model_loads_in_predict(spark, model_path):
    model = classify.load_model(spark, model_path)
    df = spark.createDataFrame([("LESCO BILL 123",)], "description string")
    assert classify.predict(df, model).first().predicted_category == "Utilities"
