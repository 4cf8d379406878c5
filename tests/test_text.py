import math
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnlytics.functions.text import clean_text
from txnlytics.operators import classify, sampling, tfidf
from txnlytics.params import Params
from txnlytics.session import checkpoint_dir, materialise

CLEANED = {
    "MCDONALDS LAHORE": "mcdonalds lahore",
    "UBER TRIP REF123456": "uber trip ref",
    "": "",
    None: "",
    "KFC@GULBERG#BRANCH!": "kfc gulberg branch",
    "KFC   LAHORE   DHA": "kfc lahore dha",
    "the BANK of Punjab Pvt LTD": "bank punjab",
    "there's andy the1 forx": "there andy forx",
    "ab12cd 3f": "",
    "Café au lait": "caf lait",
}

LABELLED = [
    ("mcdonalds lahore dha", "Food"), ("kfc gulberg branch", "Food"), ("pizza hut delivery", "Food"),
    ("burger restaurant dinner", "Food"), ("kfc restaurant lunch", "Food"), ("mcdonalds drive meal", "Food"),
    ("lesco electricity bill", "Utilities"), ("sui gas bill", "Utilities"), ("water bill payment", "Utilities"),
    ("ptcl internet bill", "Utilities"), ("lesco bill online", "Utilities"), ("gas bill monthly", "Utilities"),
    ("uber trip payment", "Transport"), ("careem ride booking", "Transport"), ("pso fuel station", "Transport"),
    ("uber ride airport", "Transport"), ("shell fuel pump", "Transport"), ("careem trip city", "Transport"),
]


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, d, c) for i, (d, c) in enumerate(LABELLED)]
    return spark.createDataFrame(rows, "id int, description string, category string").cache()


@pytest.fixture(scope="module")
def model(labelled):
    return classify.fit(labelled)


def test_clean_text(spark):
    df = spark.createDataFrame([(t,) for t in CLEANED], "t string")
    assert [r[0] for r in df.select(clean_text(F.col("t"))).collect()] == list(CLEANED.values())


def test_ngram_counts_against_plain_python(spark):
    texts = ["kfc kfc lahore", "kfc lahore", "uber", "", None, "kfc kfc kfc"]
    totals, docs = {}, {}
    for text in texts:
        words = (text or "").split()
        terms = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
        for term in terms:
            totals[term] = totals.get(term, 0) + 1
        for term in set(terms):
            docs[term] = docs.get(term, 0) + 1
    df = spark.createDataFrame([(t,) for t in texts], "description string")
    got = {r.term: (r.n_total, r.n_docs) for r in tfidf.ngram_counts(df).collect()}
    assert got == {t: (totals[t], docs[t]) for t in totals}


def test_vocabulary_limit_and_common_terms(spark):
    df = spark.createDataFrame([("kfc alpha",), ("kfc beta",), ("kfc beta",)], "description string")
    kept = [r.term for r in tfidf.vocabulary(df, p=Params(vocabulary=2)).collect()]
    assert kept == ["beta", "kfc beta"]


def test_vectors_have_unit_length(labelled):
    sums = tfidf.tfidf_weights(labelled, "id").groupBy("id").agg(F.sum(F.col("weight") ** 2).alias("s"))
    assert all(abs(r.s - 1) < 1e-9 for r in sums.collect())


def test_split_is_exact_and_repeatable(labelled):
    def split(df):
        return sorted(map(tuple, sampling.stratified_split(df, "category", "id").select("id", "split").collect()))

    first = split(labelled)
    assert first == split(labelled.repartition(7))
    assert sum(s == "test" for _, s in first) == 3


def test_folds_are_balanced(labelled):
    sizes = sampling.stratified_folds(labelled, "category", "id").groupBy("category", "fold").count()
    assert {r["count"] for r in sizes.collect()} <= {1, 2}


def test_ranks_are_dense_per_stratum(spark):
    df = spark.range(5000).withColumn("k", F.when(F.col("id") % 3 == 0, "hot").otherwise("other"))
    ranked = sampling.stratum_ranks(df, "k", "id", 1)
    got = ranked.groupBy("k").agg(F.min("rank"), F.max("rank"), F.countDistinct("rank"), F.count("*")).collect()
    for row in got:
        assert row[1] == 1 and row[2] == row[3] == row[4]


def test_a_text_with_most_of_a_class_is_ranked_in_parts(spark, monkeypatch):
    """The window that numbers rows holds no more of one text than a partition of the input."""
    windows = []
    of = sampling.Window.partitionBy
    monkeypatch.setattr(sampling.Window, "partitionBy", staticmethod(lambda *keys: windows.append(keys) or of(*keys)))
    df = spark.range(0, 4000, 1, 8).select(F.lit("k").alias("k"), F.when(F.col("id") % 10 > 0, "same").otherwise(F.col("id").cast("string")).alias("text"))
    got = sampling.stratum_ranks(df, "k", "text", 1)
    assert sorted(r["rank"] for r in got.collect()) == list(range(1, 4001))
    ranks = sorted(r["rank"] for r in got.filter("text = 'same'").collect())
    assert ranks == list(range(ranks[0], ranks[0] + 3600))  # equal texts stay neighbours
    rows = df.withColumn("_hash", F.md5("text")).withColumn("_bucket", F.substring("_hash", 1, 3)).withColumn("_part", F.spark_partition_id())
    largest = rows.groupBy(*windows[-1]).count().agg(F.max("count")).first()[0]
    assert largest <= 500


def test_class_weights(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)], "category string")
    assert {r.category: r.weight for r in classify.class_weights(df).collect()} == {"a": 4 / 6, "b": 2.0}


def test_predictions(spark, model):
    df = spark.createDataFrame([("MCDONALDS LAHORE DHA",), ("LESCO ELECTRICITY BILL",), ("UBER TRIP",), ("",)], "description string")
    rows = classify.predict(df, model).collect()
    assert [r.predicted_category for r in rows][:3] == ["Food", "Utilities", "Transport"]
    for row in rows:
        assert 0 <= row.predicted_confidence <= 1
        assert len(row.top3) == 3
        assert row.top3[0].probability == row.predicted_confidence
        assert row.top3[0].category == row.predicted_category or row.description == ""


def test_optimum_satisfies_the_penalised_objective(labelled, model):
    """Gradient of C * sum(w * loss) + |W|^2 / 2 vanishes at the fitted coefficients."""
    rows = model.rows(labelled).select("category", "position", "weight").collect()
    labels = list(model.labels)
    x = np.zeros((len(rows), len(model.terms)))
    for k, r in enumerate(rows):
        x[k, r.position] = r.weight
    y = np.array([labels.index(r.category) for r in rows])
    w = model.coefficients
    logits = x @ w.T + np.array(model.intercepts)
    prob = np.exp(logits - logits.max(axis=1, keepdims=True))
    prob /= prob.sum(axis=1, keepdims=True)
    gradient = 5.0 * (prob - np.eye(3)[y]).T @ x + w
    assert np.abs(gradient).max() < 1e-2


def test_model_round_trip(spark, labelled, model, tmp_path):
    path = str(tmp_path / "model")
    classify.save_model(spark, model, path)
    classify.save_model(spark, model, path)
    loaded = classify.load_model(spark, path)
    assert loaded.labels == ("Food", "Transport", "Utilities")
    assert (loaded.coefficients == model.coefficients).all() and loaded.idf == model.idf
    columns = ("id", "predicted_category", "predicted_confidence")
    before = classify.predict(labelled, model).select(*columns).collect()
    assert classify.predict(labelled, loaded).select(*columns).collect() == before


def test_missing_model(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        classify.load_model(spark, str(tmp_path / "none"))


def test_one_class_is_refused(labelled):
    with pytest.raises(ValueError, match="two categories"):
        classify.fit(labelled.filter("category = 'Food'"))


def test_train(labelled):
    result = classify.train(labelled, "id", Params(folds=2))
    summary = result["summary"].first()
    assert (summary.training_size, summary.test_size, summary.categories) == (15, 3, 3)
    assert len(result["cv_scores"]) == 2
    assert {r.name for r in result["report"].collect()} >= {"macro avg", "weighted avg"}


def test_report_without_hits(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "a"), ("c", "b")], "label string, prediction string")
    got = {r.name: (r.precision, r.recall, r.f1, r.support) for r in classify.classification_report(df).collect()}
    assert got["b"] == (0.0, 0.0, 0.0, 0)
    assert got["a"] == (1.0, 0.5, 0.6667, 2)
    assert got["macro avg"][3] == 3


def python_predictions(rows, model):
    """Probabilities by class of each text, from the model's numbers and plain Python."""
    out = []
    for text in rows:
        found = re.findall("[a-z]+", (text or "").lower())
        found = [w for w in found if len(w) > 2 and w not in ("the", "and", "for", "ltd", "pvt")]
        counts = Counter(found + [f"{a} {b}" for a, b in zip(found, found[1:])])
        x = np.array([(1 + math.log(counts[t])) * w if counts[t] else 0.0 for t, w in zip(model.terms, model.idf)])
        x = x / np.linalg.norm(x) if x.any() else x
        e = np.exp((m := model.coefficients @ x + np.array(model.intercepts)) - m.max())
        out.append(e / e.sum())
    return out


@pytest.mark.parametrize("learn", [classify.fit, classify.fit_centroids])
@pytest.mark.parametrize("classes", [2, 3])
def test_scores_equal_plain_python(spark, labelled, learn, classes):
    some = labelled if classes == 3 else labelled.filter("category <> 'Food'")
    model = learn(some, Params(vocabulary=40))
    texts = ["uber uber trip gas bill bill bill", "kfc restaurant", "", None, "nothing known", "LESCO bill"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "_m int, description string")
    got = {r["_m"]: r for r in classify.predict(df, model).collect()}
    for k, want in enumerate(python_predictions(texts, model)):
        order = sorted(range(classes), key=lambda c: (-want[c], c))
        assert [t.category for t in got[k].top3] == [model.labels[c] for c in order]
        assert [t.probability for t in got[k].top3] == pytest.approx([want[c] for c in order], abs=6e-5)
        assert got[k].predicted_category == model.labels[order[0]]


def test_scoring_has_no_python_step(labelled, model):
    plan = classify.predict(labelled, model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_centroids_separate_the_classes(labelled):
    model = classify.fit_centroids(labelled)
    assert np.linalg.norm(model.coefficients, axis=1) == pytest.approx([20.0] * 3)
    assert classify.accuracy(classify.predict(labelled, model)) == 1.0


def test_fold_counts_by_subtraction_equal_a_recount(labelled):
    folded = sampling.stratified_folds(labelled, "category", "id", Params(folds=3))
    counts = tfidf.ngram_counts(folded, by=("fold",))
    for k in range(3):
        outside = folded.filter(F.col("fold") != k)
        want = sorted(map(tuple, tfidf.ngram_counts(outside).collect()))
        assert sorted((r.term, r.n_total, r.n_docs) for r in tfidf.without_fold(counts, k).collect()) == want


def test_fold_vocabulary_and_weights_equal_separate_ones(labelled):
    p = Params(folds=3, vocabulary=20)
    folded = sampling.stratified_folds(labelled, "category", "id", p).cache()
    counts = tfidf.ngram_counts(folded, by=("fold",)).cache()
    for k in range(3):
        outside = folded.filter(F.col("fold") != k)
        got = tfidf.collect_vocabulary(tfidf.top_terms(tfidf.without_fold(counts, k), F.lit(outside.count()), p))
        want = tfidf.collect_vocabulary(tfidf.vocabulary(outside, p=p))
        assert [(v["term"], v["n_total"], v["n_docs"], v["idf"]) for v in got] == [tuple(v) for v in want]
        given = classify.fit(outside, p, got)
        assert np.allclose(given.coefficients, classify.fit(outside, p).coefficients, atol=1e-4)
    scores = classify.cross_validate(labelled, "id", p)
    assert len(scores) == 3 and all(0 <= s <= 1 for s in scores)


@pytest.mark.parametrize("limit", [3, 12, 5000])
def test_vocabularies_of_overlapping_sets_equal_separate_ones(spark, limit):
    """Whether bigrams can be left out (few places), are tied for the last one, or must all be counted."""
    draw = random.Random(7)
    texts = [" ".join(draw.choice(["kfc", "uber", "gas", "bill", "ride", "lunch"][: 2 + k % 5]) for _ in range(k % 9)) for k in range(120)]
    df = spark.createDataFrame([(k % 3, t, t.split()) for k, t in enumerate(texts)], "part int, description string, _words array<string>").cache()
    parts = {f"p{k}": F.col("part") == k for k in range(3)}
    sets = {"all": (list(parts), 120), 0: (["p1", "p2"], 80), 1: (["p0"], 40)}
    p = Params(vocabulary=limit)
    got = tfidf.set_vocabularies(df, parts, sets, p)
    for key, kept in (("all", df), (0, df.filter("part > 0")), (1, df.filter("part = 0"))):
        want = tfidf.collect_vocabulary(tfidf.vocabulary(kept, p=p))
        assert [tuple(v) for v in got[key]] == [tuple(v) for v in want]


def test_train_equals_separate_steps(spark, labelled):
    """One encoding for all fits gives what fits on the texts of each part give."""
    p = Params(folds=3, vocabulary=30)
    split = sampling.stratified_split(labelled, "category", "id", p).cache()
    model = classify.fit(split.filter("split = 'train'"), p)
    result = classify.train(labelled, "id", p)
    assert result["model"].terms == model.terms and result["model"].idf == pytest.approx(model.idf)
    assert result["model"].labels == model.labels
    assert np.allclose(result["model"].coefficients, model.coefficients, atol=1e-4)
    tested = classify.predict(split.filter("split = 'test'"), model)
    assert result["summary"].first().accuracy == round(classify.accuracy(tested), 4)
    folded = sampling.stratified_folds(labelled, "category", "id", p).cache()
    for k, score in enumerate(result["cv_scores"]):
        own = classify.fit(folded.filter(F.col("fold") != k), p)
        assert score == pytest.approx(classify.accuracy(classify.predict(folded.filter(F.col("fold") == k), own)))


def test_training_keeps_no_copies_of_the_texts(spark, monkeypatch, tmp_path):
    """At no time do the tables of a training run take more than three times the input's size."""
    draw = random.Random(3)
    vocabulary = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(400)]
    texts = [(k, " ".join(draw.choices(vocabulary + ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=9))] * 40, k=300)), "ab"[k % 2]) for k in range(600)]
    spark.createDataFrame(texts, "id int, description string, category string").repartition(2).write.parquet(str(tmp_path / "in"))

    def size(folder):
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet"))

    shared = checkpoint_dir(spark).removeprefix("file:")
    before, taken = size(shared), []

    def watched(*args, **kwargs):
        made = materialise(*args, **kwargs)
        taken.append(size(shared) - before)
        return made

    for module in (classify, sampling, tfidf):
        monkeypatch.setattr(module, "materialise", watched, raising=False)
    classify.train(spark.read.parquet(str(tmp_path / "in")), "id", Params(folds=3, max_iter=3))
    whole = size(tmp_path / "in")
    assert max(taken) < 3 * whole and size(shared) - before < whole / 4
