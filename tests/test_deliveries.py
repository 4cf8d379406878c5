"""Statement files of several layouts."""

from datetime import date
from decimal import Decimal

import pytest

from txnlytics.operators import ingest
from txnlytics.operators.ingest import ValidationError
from txnlytics.plans import jobs
from txnlytics.sources import deliveries
from txnlytics.sources.store import TableStore

PLAIN = "Date,Description,Amount\n"


@pytest.fixture
def folder(tmp_path):
    place = tmp_path / "in"
    place.mkdir()
    (place / "1.csv").write_text("\ufeff" + PLAIN + "01/02/2024,Shop One,10\n02/02/2024,Shop Two,20,surplus\n03/02/2024,Shop\n")
    (place / "2 b.csv").write_text('\n  \nValue Date;x,Narration,Debit Amount,Credit Amount,Value Date\n?,"SHOP, THREE",30,,03/02/2024\n?,pay,,400,04/02/2024\n')
    (place / "3.csv").write_text(PLAIN + '05/02/2024,"two\nlines, ""quoted""",50\n01/02/2024,SHOP  ONE,10.00\n')
    (place / "4.csv").write_text("a,b\n1,2\n")
    (place / "5.csv").write_text("")
    return place


def test_survey_names_header_and_breaks(spark, folder):
    got = {r.file.rsplit("/", 1)[1]: (r.header, r.breaks) for r in deliveries.survey_files(spark, str(folder)).collect()}
    assert {f: b for f, (_, b) in got.items()} == {"1.csv": False, "2%20b.csv": False, "3.csv": True, "4.csv": False}
    assert deliveries.header_cells(got["1.csv"][0]) == ["Date", "Description", "Amount"]
    assert got["2%20b.csv"][0].startswith("Value Date;x")


def test_layouts_become_common_columns(spark, folder):
    found = deliveries.read_deliveries(spark, str(folder))
    assert [f.rsplit("/", 1)[1] for f in found.problem] == ["4.csv"] and len(found.layout) == 3
    cleaned = ingest.clean_rows(found.rows)
    rows = sorted((r.description, r.amount, r.date, r.raw_text) for r in ingest.valid_rows(cleaned).collect())
    d = Decimal
    assert rows == [
        ("pay", d("400.00"), date(2024, 2, 4), None),
        ("shop one", d("10.00"), date(2024, 2, 1), "SHOP  ONE"),
        ("shop one", d("10.00"), date(2024, 2, 1), "Shop One"),
        ("shop, three", d("30.00"), date(2024, 2, 3), None),
        ('two lines, "quoted"', d("50.00"), date(2024, 2, 5), 'two\nlines, "quoted"'),
    ]
    counts = {r.file.rsplit("/", 1)[1]: (r.total_read, r.total_dropped) for r in deliveries.file_counts(cleaned).collect()}
    assert counts == {"1.csv": (2, 1), "2%20b.csv": (2, 0), "3.csv": (2, 0)}


def test_first_copy_in_file_order_stays_across_layouts(spark, folder):
    found = deliveries.read_deliveries(spark, str(folder))
    unique = ingest.dedupe(ingest.valid_rows(ingest.clean_rows(found.rows)))
    assert [r.raw_text for r in unique.filter("description = 'shop one'").collect()] == ["Shop One"]


def test_ingest_of_a_folder_notes_what_it_skips(spark, folder, tmp_path):
    notes = []
    store = TableStore(spark, str(tmp_path / "store"))
    row = jobs.ingest_files(spark, str(folder), store, notes).first()
    assert (row.total_read, row.total_dropped, row.duplicates_removed, row.db_inserted) == (6, 1, 1, 4)
    assert len(notes) == 1 and "4.csv skipped: Missing required columns" in notes[0]
    stored = {r.description: r.raw_text for r in store.read("transactions").collect()}
    assert stored["shop, three"] == "shop, three" and stored["shop one"] == "Shop One"


def test_nothing_usable_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    (tmp_path / "e.csv").write_text("")
    (tmp_path / "h.csv").write_text(PLAIN)
    with pytest.raises(ValidationError, match="Missing required columns"):
        jobs.ingest_files(spark, str(tmp_path / "a.csv"), None)
    for name in ("e.csv", "h.csv"):
        with pytest.raises(ValidationError, match="no data"):
            jobs.ingest_files(spark, str(tmp_path / name), None)
    with pytest.raises(FileNotFoundError):
        jobs.ingest_files(spark, str(tmp_path / "none.csv"), None)


def test_a_header_with_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('date,description,"amount","my\nnote"\n1/2/2024,x,5,n\n')
    row = ingest.clean_rows(deliveries.read_deliveries(spark, str(tmp_path)).rows).first()
    assert (row.description, row.amount) == ("x", Decimal("5.00"))


@pytest.mark.parametrize("breaks", [False, True])
def test_large_files_without_breaks_in_quotes_are_split(spark, tmp_path, breaks):
    lines = [f'{1 + k % 28:02d}/02/2024,"shop {k}, branch",{k}.25' for k in range(3000)]
    if breaks:
        lines[0] = lines[0].replace("shop 0", "shop\n0")
    (tmp_path / "big.csv").write_text(PLAIN + "\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = deliveries.read_deliveries(spark, str(tmp_path)).rows
        assert (rows.rdd.getNumPartitions() == 1) == breaks
        cleaned = ingest.valid_rows(ingest.clean_rows(rows))
        assert cleaned.count() == 3000
        assert sorted(r.amount for r in cleaned.select("amount").collect()) == [Decimal(f"{k}.25") for k in range(3000)]
        first = cleaned.orderBy("_ord").limit(3).select("description").collect()
        assert [r[0] for r in first] == [f"shop {k}, branch" for k in range(3)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
