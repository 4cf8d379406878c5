"""Columns whose names an operator or a stage of the pipeline also makes, and cells that are hard to read."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from txnlytics.llm import chat, language, packing

NAMES = ("n_words", "_t", "_words", "kept", "_n", "_k", "_d", "_c", "_digest", "_name", "_size", "size", "copies", "taken", "_copy", "start", "s", "r", "_order", "_range", "_rest", "Item")


def documents(spark, clashing):
    rows = [(k, " ".join(f"word{k}of{j}" for j in range(60)) + ".", "en", f"src{k % 2}", 0) for k in range(8)]
    rows += [(20, rows[0][1], "en", "src0", 0), (21, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in clashing:
        df = df.withColumn(name, F.concat(F.lit(f"{name} of "), F.col("doc_id").cast("string")))
    return df


@pytest.mark.parametrize("stage", [s[1] for s in corpus_pipeline.STAGES[:-1]], ids=lambda s: s.__name__)
def test_stages_leave_clashing_columns_alone(spark, stage):
    plain, full = documents(spark, ()), documents(spark, NAMES)
    want = sorted(map(tuple, stage(spark, plain, "").collect()), key=repr)
    out = stage(spark, full, "")
    assert out.columns == full.columns
    rows = out.collect()
    assert sorted((tuple(r[: len(plain.columns)]) for r in rows), key=repr) == want and len(want) > 5
    for row in rows:
        assert all(row[name] == f"{name} of {row.doc_id}" for name in NAMES)


def test_pack_keeps_a_column_named_item(spark):
    df = spark.createDataFrame([(k, 100 + k) for k in range(9)], "item long, length long")
    got = packing.pack(df).collect()
    assert sorted((r["item"], r["length"]) for r in got) == [(k, 100 + k) for k in range(9)]


@pytest.mark.parametrize("text,letter", [("\u00bd \u00b2 \u2460", False), ("12 ***", False), ("\u00bda", True), ("\u4e2d", True), ("_", False), ("", False)])
def test_letters_are_category_l_only(text, letter):
    assert language.has_letter(text.encode()) is letter


def test_bytes_that_are_no_text_are_und(spark):
    df = spark.createDataFrame([(1, "ba ba ba", "aa"), (2, "ku ku ku", "bb")], "doc_id long, text string, lang string")
    model = language.fit(df)
    odd = spark.sql("SELECT 1L AS doc_id, CAST(X'ff80' AS STRING) AS text UNION ALL SELECT 2L, '\u00bd'")
    assert [r.lang_pred for r in language.identify(odd, model).collect()] == ["und", "und"]
    assert packing.cut_pieces(odd).count() == 2


SPELLINGS = {
    "1.50": "1.5", "1e2": "100", "-0": "0", "-0.0": "0", "1E+2": "100", "0.00001": "1.0e-5".replace(".0", ""), "12345678901234567890": "12345678901234567890",
    "1e400": "1e400", "2.0": "2", "1.5e300": "1.5e300", "true": "true",
}


def test_numbers_have_one_spelling(spark):
    df = spark.createDataFrame([(t,) for t in SPELLINGS], "t string")
    assert {r.t: r.c for r in df.select("t", chat.canonical_scalar(F.col("t")).alias("c")).collect()} == SPELLINGS


def test_a_line_break_behind_a_number_is_no_number(spark):
    calls = spark.createDataFrame([(1, "a", None, "tool", {"n": "12\n", "m": "1.0"})], "conv_id long, call_id string, after string, name string, arguments map<string,string>")
    results = spark.createDataFrame([], "call_id string, content string")
    schemas = {"tool": {"n": chat.Argument("integer"), "m": chat.Argument("number")}}
    row = chat.link_calls(calls, results, schemas).first()
    assert row.errors == ["not integer: n"]
    assert row.json == '{"arguments":{"m":1,"n":"12\\n"},"id":"a","name":"tool","result":null}'
