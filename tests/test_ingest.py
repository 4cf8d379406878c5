from datetime import date
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from txnlytics.operators import ingest
from txnlytics.operators.ingest import ValidationError
from txnlytics.sources.statements import read_headers, read_labels, read_statements

RAW = "date string, description string, amount string"


def frame(spark, rows, schema=RAW):
    return spark.createDataFrame(rows, schema)


def column(df, name):
    return [r[0] for r in df.select(name).collect()]


@pytest.fixture(scope="module")
def valid(spark):
    return frame(spark, [
        ("15/01/2024", "BAKERY AT THE GATE", "312.40"),
        ("16/01/2024", "WATER BOARD", "1780.25"),
        ("17/01/2024", "NIGHT TRAIN", "95.00"),
    ])


@pytest.fixture(scope="module")
def messy(spark):
    return frame(spark, [
        ("15/01/2024", "  BOOK CORNER  ", "Rs 2,718.28"),
        ("some day", "CINEMA CLUB", "abc"),
        ("17/01/2024", "", "(500.00)"),
    ])


class TestRequiredColumns:
    def test_all_there(self, valid):
        ingest.check_required(valid)

    @pytest.mark.parametrize("name", ["date", "amount", "description"])
    def test_one_missing(self, valid, name):
        with pytest.raises(ValidationError, match=name):
            ingest.check_required(valid.drop(name))

    def test_no_rows(self, valid):
        with pytest.raises(ValidationError, match="no data"):
            ingest.check_required(valid.limit(0))


# One row per rule; None means the date is dropped.
DATES = {
    "15/01/2024": date(2024, 1, 15),
    "01/02/2024": date(2024, 2, 1),
    "1-2-2024": date(2024, 2, 1),
    "15.01.2024": date(2024, 1, 15),
    "2024-02-01": date(2024, 2, 1),
    "2024/2/1": date(2024, 2, 1),
    "20240201": date(2024, 2, 1),
    "01/15/2024": date(2024, 1, 15),
    "15/01/24": date(2024, 1, 15),
    "15/01/75": date(1975, 1, 15),
    "5 Jan 2024": date(2024, 1, 5),
    "05-JAN-2024": date(2024, 1, 5),
    "5 January 2024": date(2024, 1, 5),
    "15-Jan-24": date(2024, 1, 15),
    "15 Jan 24": date(2024, 1, 15),
    "15/Jan/2024": date(2024, 1, 15),
    "15Jan2024": date(2024, 1, 15),
    "15 Sept 2024": date(2024, 9, 15),
    "Jan 15, 2024": date(2024, 1, 15),
    "January 15 2024": date(2024, 1, 15),
    "15 January, 2024": date(2024, 1, 15),
    "Mon, 15 Jan 2024": date(2024, 1, 15),
    "Monday 15/01/2024": date(2024, 1, 15),
    "15/01/2024, 10:30": date(2024, 1, 15),
    "Jan 2024": date(2024, 1, 1),
    "\t15/01/2024\u00a0": date(2024, 1, 15),
    "31 Feb 2024": None,
    "15 Janus 2024": None,
    "Mon": None,
    " 15/01/2024 ": date(2024, 1, 15),
    "15/01/2024 10:30": date(2024, 1, 15),
    "2024-01-15T10:30:00Z": date(2024, 1, 15),
    "31/02/2024": None,
    "30/30/2024": None,
    "not-a-date": None,
    "": None,
    "N/A": None,
    None: None,
    "123": None,
}

AMOUNTS = {
    "1.015": "1.01",
    "1.035": "1.03",
    "Rs 1,234.50": "1234.50",
    "Rs 1234.50": "1234.50",
    "1,234,567.89": "1234567.89",
    "(500.00)": "500.00",
    "(Rs 500)": "500.00",
    "Rs (500)": None,
    "RS 500": None,
    "500 Cr": None,
    "Rs. 500": "0.50",
    "Rs. 1,234.50": None,
    "5K": "5.00",
    "1e3": "1000.00",
    "-12.345": "12.34",
    "1234.5678": "1234.57",
    "1234.565": "1234.56",
    "2.675": "2.68",
    "500d": None,
    "1_000": None,
    "inf": None,
    "99999999999": None,
    "$1,000": "1000.00",
    "€ 12": "12.00",
    ".5": "0.50",
    "5.": "5.00",
    "abc": None,
    "": None,
    "nan": None,
    None: None,
}

TEXTS = {
    "  MCDONALDS LAHORE  ": "mcdonalds lahore",
    "LESCO ELECTRICITY BILL": "lesco electricity bill",
    "KFC   GULBERG\t BRANCH": "kfc gulberg branch",
    "KFC  DHA": "kfc dha",
    " ": None,
    "   ": None,
    "": None,
    "NULL": None,
    "na": "na",
    None: None,
}


class TestCells:
    def test_dates(self, spark):
        df = frame(spark, [(d, "a", "1") for d in DATES])
        assert column(ingest.clean_dates(df), "date") == list(DATES.values())

    def test_amounts(self, spark):
        df = frame(spark, [("1/1/2024", "a", a) for a in AMOUNTS])
        want = [None if v is None else Decimal(v) for v in AMOUNTS.values()]
        assert column(ingest.clean_amounts(df), "amount") == want

    def test_descriptions(self, spark):
        df = frame(spark, [("1/1/2024", t, "1") for t in TEXTS])
        assert column(ingest.clean_descriptions(df), "description") == list(TEXTS.values())

    def test_typed_columns_are_accepted(self, spark):
        df = spark.createDataFrame([(date(2024, 1, 15), "A", 100)], "date date, description string, amount int")
        row = ingest.clean_rows(df).first()
        assert (row.date, row.amount, row.drop_step) == (date(2024, 1, 15), Decimal("100.00"), None)

    @settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.text(max_size=12), min_size=1, max_size=30))
    def test_cleaning_is_idempotent(self, spark, texts):
        once = ingest.clean_descriptions(frame(spark, [("1/1/2024", t, "1") for t in texts]))
        first = [t for t in column(once, "description") if t is not None]
        again = frame(spark, [("1/1/2024", t, "1") for t in first] or [("1/1/2024", "x", "1")])
        # A cleaned text may read like a missing marker ("nan"); those are dropped.
        for before, after in zip(first, column(ingest.clean_descriptions(again), "description")):
            assert after in (before, None)


class TestValidation:
    def test_clean_input(self, valid):
        report = ingest.validation_report(ingest.clean_rows(valid)).first()
        assert (report.original_rows, report.clean_rows, report.dropped_rows, report.drop_rate) == (3, 3, 0, 0.0)

    def test_messy_input_counts_each_row_once(self, messy):
        report = ingest.validation_report(ingest.clean_rows(messy)).first()
        assert (report.clean_rows, report.dropped_rows, report.drop_rate) == (1, 2, 66.7)
        assert (report.bad_dates, report.bad_amounts, report.bad_descriptions) == (1, 0, 1)

    def test_empty_input(self, messy):
        report = ingest.validation_report(ingest.clean_rows(messy.limit(0))).first()
        assert (report.original_rows, report.drop_rate) == (0, 0.0)

    def test_rate_halves_go_to_even(self, spark):
        cleaned = spark.range(400).select(F.when(F.col("id") == 0, "date").alias("drop_step"))
        assert ingest.validation_report(cleaned).first().drop_rate == 0.2

    def test_filter_does_not_repeat_the_cleaning(self, messy):
        plan = ingest.valid_rows(ingest.clean_rows(messy))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("(?U)[RsPKpkr") == 1


class TestHeaders:
    def test_aliases(self, spark):
        df = spark.createDataFrame([("a", "b", "c", "d")], "` Txn Date ` string, PARTICULARS string, Withdrawal string, Type string")
        assert ingest.normalise_columns(df).columns == ["date", "description", "amount", "type"]

    def test_raw_text_only_for_literal_description(self, spark):
        df = spark.createDataFrame([("x", " Ab ")], "dt string, ` Description ` string")
        row = ingest.normalise_columns(df).first()
        assert row.raw_text == " Ab " and row.description == " Ab "
        narrated = spark.createDataFrame([("x", " Ab ")], "dt string, narration string")
        assert "raw_text" not in ingest.normalise_columns(narrated).columns

    def test_debit_and_credit_are_merged(self, spark):
        df = spark.createDataFrame([("5", ""), ("", "7"), ("N/A", "8")], "`Debit Amount` string, `Credit Amount` string")
        assert column(ingest.normalise_columns(df), "amount") == ["5", "7", "8"]


class TestDedupe:
    def test_keeps_the_first_in_file_order(self, spark):
        rows = [(2, "b", "A"), (1, "b", "a "), (3, "c", "C")]
        df = spark.createDataFrame(rows, "_ord int, description string, raw_text string").withColumns(
            {"date": F.lit(date(2024, 1, 1)), "amount": F.lit(1).cast("decimal(12,2)")}
        )
        got = {r.description: (r.raw_text, r.copies) for r in ingest.dedupe(df).collect()}
        assert got == {"b": ("a ", 2), "c": ("C", 1)}

    def test_hot_key_is_folded_before_the_shuffle(self, spark):
        df = spark.range(1000).select(
            F.lit(date(2024, 1, 1)).alias("date"), F.lit("x").alias("description"),
            F.lit(1).cast("decimal(12,2)").alias("amount"), F.col("id").alias("_ord"),
        )
        unique = ingest.dedupe(df)
        assert unique.first().copies == 1000
        assert "partial_count" in unique._jdf.queryExecution().executedPlan().toString()


CSV = """﻿Transaction Date,Description,Amount,Type
15/01/2024,MCDONALDS LAHORE,850.00,Debit
16/01/2024,"TWO, PARTS ""Q"" ",95000.00,Credit
17/01/2024,TOO,MANY,FIELDS,HERE
18/01/2024,SHORT
19/01/2024,"LINE
BREAK",10,Debit
19/01/2024,"line break",10,Debit
20/01/2024,NA,10,Debit
"""


@pytest.fixture(scope="module")
def csv_file(tmp_path_factory):
    path = tmp_path_factory.mktemp("csv") / "statement.csv"
    path.write_text(CSV, encoding="utf-8")
    return str(path)


class TestScan:
    def test_header_without_bom(self, spark, csv_file):
        assert read_headers(spark, csv_file) == ["Transaction Date", "Description", "Amount", "Type"]

    def test_rows(self, spark, csv_file):
        rows = read_statements(spark, csv_file).orderBy("_ord").collect()
        assert [r.Description for r in rows] == [
            "MCDONALDS LAHORE", 'TWO, PARTS "Q" ', "SHORT", "LINE\nBREAK", "line break", None
        ]
        assert [r.Amount for r in rows][2] is None
        assert read_statements(spark, csv_file).count() == 6

    def test_missing_file(self, spark, tmp_path):
        with pytest.raises(FileNotFoundError):
            read_statements(spark, str(tmp_path / "none.csv"))

    def test_repeated_headers(self, spark, tmp_path):
        (tmp_path / "a.csv").write_text("Date,Amount,Amount,Description\n1/1/2024,5,6,x\n")
        named = ingest.normalise_columns(read_statements(spark, str(tmp_path)))
        assert named.select("amount").first()[0] == "5"

    def test_labels(self, spark, tmp_path):
        (tmp_path / "l.csv").write_text("description,category\nkfc,Food\n ,Food\nuber,\nlesco,Utilities\n")
        assert {tuple(r) for r in read_labels(spark, str(tmp_path)).collect()} == {("kfc", "Food"), ("lesco", "Utilities")}
        (tmp_path / "bad").mkdir()
        (tmp_path / "bad" / "l.csv").write_text("text,category\nkfc,Food\n")
        with pytest.raises(ValueError, match="description"):
            read_labels(spark, str(tmp_path / "bad"))
