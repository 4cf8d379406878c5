from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from txnlytics.functions.labels import title_case
from txnlytics.operators import ingest, reports, storage
from txnlytics.params import FORECASTS, TRANSACTIONS
from txnlytics.sources.store import TableStore

FACTS = "txn_id string, date date, description string, amount decimal(12,2), category string, is_anomaly boolean, confidence double"


@pytest.fixture(scope="module")
def rows(spark):
    d = Decimal
    return spark.createDataFrame([
        ("a", date(2024, 1, 5), "KFC DHA-2", d("100.50"), "Food", False, 0.29),
        ("b", date(2024, 1, 9), "rent", d("900.00"), "Rent", True, None),
        ("c", date(2024, 2, 1), "pay", d("5000.00"), "Salary & Income", False, 0.0),
        ("d", date(2024, 2, 3), "move", d("700.00"), "Transfer", False, 0.5),
        ("e", date(2024, 2, 3), "mystery", d("900.00"), None, False, 0.995),
    ], FACTS).cache()


class TestReports:
    def test_kpis(self, rows):
        row = reports.kpi_summary(rows).first()
        assert (row.total_expense, row.total_income, row.net_balance) == (1900.5, 5000.0, 3099.5)
        assert (row.transactions, row.anomalies, row.avg_expense, row.anomaly_rate) == (5, 1, 633.5, 20.0)

    def test_kpis_of_nothing(self, rows):
        row = reports.kpi_summary(rows.limit(0)).first()
        assert (row.total_expense, row.avg_expense, row.anomaly_rate) == (0.0, 0.0, 0.0)

    def test_top_category_tie_and_none(self, rows):
        assert tuple(reports.top_category(rows).first()) == ("Rent", 900.0)
        assert tuple(reports.top_category(rows.limit(0)).first()) == ("N/A", 0.0)

    def test_category_tables_keep_uncategorised(self, rows):
        assert [r.category for r in reports.spend_by_category(rows).collect()] == ["Rent", "Uncategorized", "Food"]
        shares = {r.category: r.share_pct for r in reports.category_share(rows).collect()}
        assert shares == {"Rent": 47.36, "Uncategorized": 47.36, "Food": 5.29}

    def test_months(self, rows):
        assert [tuple(r) for r in reports.monthly_total(rows).collect()] == [
            ("2024-01", 1000.5, "Rs 1,000"), ("2024-02", 900.0, "Rs 900")
        ]
        assert [r.total for r in reports.monthly_total(rows.drop("category")).collect()] == [1000.5, 6600.0]

    def test_explorer(self, rows):
        first = reports.txn_explorer(rows, sort="amount_lowest").first()
        assert tuple(first) == ("2024-01-05", "KFC DHA-2", "Rs 100", "Food", "29%", "✅ Normal")
        assert reports.txn_explorer(rows, status="anomalies").first()["ML Confidence"] == "N/A"
        assert [r.Category for r in reports.txn_explorer(rows, category="Uncategorized").collect()] == ["Uncategorized"]
        with pytest.raises(ValueError):
            reports.txn_explorer(rows, status="odd")

    def test_footer(self, rows):
        assert tuple(reports.explorer_footer(rows, rows=3).first()) == (3, 5)

    def test_top_expenses(self, rows):
        got = [(r.rank, r.txn_id, r.description) for r in reports.top_expenses(rows, rows=3).collect()]
        assert got == [(1, "b", "Rent"), (2, "e", "Mystery"), (3, "a", "Kfc Dha-2")]

    def test_title_case(self, spark):
        texts = ["KFC dha-2nd floor", "o'neil", "", "éclair bar"]
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        assert [r[0] for r in df.select(title_case(F.col("t"))).collect()] == [t.title() for t in texts]

    def test_top_k_is_not_a_full_sort(self, rows):
        plan = reports.txn_explorer(rows)._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrderedAndProject" in plan


class TestState:
    def test_upsert(self, spark):
        now = datetime(2024, 5, 1)
        old = spark.createDataFrame([
            (1, date(2024, 5, 1), Decimal("10.00"), Decimal("11.00"), now),
            (1, date(2024, 4, 1), Decimal("9.00"), None, now),
        ], FORECASTS)
        new = spark.createDataFrame(
            [("Food", date(2024, 5, 1), 20.0), ("Rent", date(2024, 5, 1), 30.0), ("Gone", date(2024, 5, 1), 5.0)],
            "category string, forecast_month date, predicted double",
        )
        names = spark.createDataFrame([(1, "Food"), (2, "Rent")], "category_id bigint, name string")
        state = storage.upsert_forecasts(new, old, names).orderBy("category_id", "forecast_month").collect()
        got = [(r.category_id, r.predicted_amount, r.actual_amount, r.action) for r in state]
        assert got == [
            (1, Decimal("9.00"), None, "kept"),
            (1, Decimal("20.00"), Decimal("11.00"), "updated"),
            (2, Decimal("30.00"), None, "inserted"),
        ]
        assert state[1].created_at == now

    def test_flags_are_never_cleared(self, spark, rows):
        hits = spark.createDataFrame([("a",), ("a",)], "txn_id string")
        got = {r.txn_id: r.is_anomaly for r in storage.mark_anomalous(rows, hits).collect()}
        assert got == {"a": True, "b": True, "c": False, "d": False, "e": False}

    def test_unknown_prediction_has_no_id(self, spark):
        scored = spark.createDataFrame(
            [("a", None, None, "Food", 0.9), ("b", None, None, "Odd", 0.8)],
            "txn_id string, category_id bigint, confidence double, predicted_category string, predicted_confidence double",
        )
        names = spark.createDataFrame([(7, "Food")], "category_id bigint, name string")
        got = {r.txn_id: (r.category_id, r.confidence) for r in storage.apply_predictions(scored, names).collect()}
        assert got == {"a": (7, 0.9), "b": (None, 0.8)}

    def test_append_new_twice_adds_nothing(self, spark, rows):
        clean = rows.select("date", "description", "amount")
        new = ingest.new_transactions(clean)
        assert ingest.append_new(new, new).count() == 0
        assert ingest.append_new(new, new.filter("description = 'pay'")).count() == 4


class TestStore:
    def facts(self, spark, *dates):
        clean = spark.createDataFrame([(d, f"row {d}", Decimal("1.00")) for d in dates], "date date, description string, amount decimal(12,2)")
        return ingest.new_transactions(clean)

    def test_append_read_and_month_update(self, spark, tmp_path):
        store = TableStore(spark, str(tmp_path / "store"))
        assert store.read("transactions").count() == 0
        store.append("transactions", self.facts(spark, date(2024, 1, 1), date(2024, 2, 1)))
        store.append("transactions", self.facts(spark, date(2024, 2, 2)))
        assert store.read("transactions").count() == 3
        february = store.read("transactions", ["2024-02"])
        assert february.count() == 2
        store.update("transactions", february.withColumn("is_anomaly", F.lit(True)))
        now = {(r.year_month, r.is_anomaly) for r in store.read("transactions").collect()}
        assert now == {("2024-01", False), ("2024-02", True)}
        assert store.read("transactions").columns == TRANSACTIONS.fieldNames()

    def test_an_update_touches_no_other_month(self, spark, tmp_path):
        store = TableStore(spark, str(tmp_path / "store"))
        store.append("transactions", self.facts(spark, date(2024, 1, 1), date(2024, 2, 1)))
        january = [f for f in store.read("transactions").inputFiles() if "2024-01" in f]
        store.update("transactions", store.read("transactions", ["2024-02"]))
        store.update("transactions", store.read("transactions", ["2024-02"]).limit(0))
        assert [f for f in store.read("transactions").inputFiles() if "2024-01" in f] == january
        assert store.read("transactions").count() == 2

    def test_forecasts_are_partitioned_by_their_month(self, spark, tmp_path):
        store = TableStore(spark, str(tmp_path / "store"))
        months = [date(2024, 5, 1), date(2024, 6, 1)]
        rows = spark.createDataFrame([(k, m, Decimal("1.00"), None, None) for k in (1, 2) for m in months], FORECASTS)
        store.append("forecasts", rows)
        store.update("forecasts", store.read("forecasts", months[:1]).withColumn("predicted_amount", F.lit(Decimal("2.00"))))
        got = sorted((r.category_id, r.forecast_month, r.predicted_amount) for r in store.read("forecasts").collect())
        assert got == [(k, m, Decimal(2 if m == months[0] else 1)) for k in (1, 2) for m in months]
        with pytest.raises(ValueError, match="no partitions"):
            store.update("anomalies", store.read("anomalies"))

    def test_many_appends_are_one_path_and_compact_to_few_files(self, spark, tmp_path):
        store = TableStore(spark, str(tmp_path / "store"))
        one = self.facts(spark, date(2024, 1, 1)).coalesce(1)
        for k in range(100):
            one.withColumn("year_month", F.lit("2024-01" if k % 10 else "2024-02")).write.mode("append").partitionBy("year_month").parquet(
                f"{store.root}/transactions"
            )
        frame = store.read("transactions")
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "InMemoryFileIndex(1 paths)" in plan and len(frame.inputFiles()) == 100
        before = sorted(map(tuple, frame.collect()), key=repr)
        assert store.compact("transactions", more_than=10) == ["2024-01"]
        after = store.read("transactions")
        assert len(after.inputFiles()) < 15 and sorted(map(tuple, after.collect()), key=repr) == before
        assert store.compact("transactions", more_than=10) == []

    def test_a_failed_write_leaves_the_rows(self, spark, tmp_path):
        store = TableStore(spark, str(tmp_path / "store"))
        store.append("transactions", self.facts(spark, date(2024, 1, 1)))
        broken = store.read("transactions").withColumn("description", F.raise_error(F.lit("stop")).cast("string"))
        for write in (store.append, store.update):
            with pytest.raises(Exception, match="stop"):
                write("transactions", broken)
        assert [r.description for r in store.read("transactions").collect()] == ["row 2024-01-01"]

    def test_month_pruning_reaches_the_scan(self, spark, tmp_path):
        store = TableStore(spark, str(tmp_path / "store"))
        store.append("transactions", self.facts(spark, date(2024, 1, 1), date(2024, 2, 1)))
        plan = store.read("transactions", ["2024-01"]).select("amount")
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(year_month" in text and "ReadSchema: struct<amount" in text
