"""Text classifier: class weights, training, prediction and evaluation."""

from __future__ import annotations

from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from txnlytics.functions.text import clean_text, not_blank
from txnlytics.operators.sampling import split_and_folds
from txnlytics.operators.tfidf import (
    collect_vocabulary, damped_counts, numbers, only_words, pinned, set_vocabularies, sparse_rows, vocabulary, weighted_rows
)
from txnlytics.params import Params
from txnlytics.session import discard, materialise

_P = Params()
_AT_ONCE = 2  # fits side by side; each keeps its training rows in memory, or on disk, while it iterates


def usable_labels(df: DataFrame) -> DataFrame:
    """Labelled rows with a category and a non-blank description."""
    return df.filter(F.col("category").isNotNull() & not_blank(F.col("description")))


def class_weights(df: DataFrame) -> DataFrame:
    """(category, n, weight) with the balanced weight rows / (classes * n)."""
    return balanced_weights(df.groupBy("category").agg(F.count("*").alias("n")))


def balanced_weights(counts: DataFrame) -> DataFrame:
    """The same from (category, n) rows."""
    totals = counts.agg(F.struct(F.sum("n").alias("rows"), F.count("*").alias("classes")).alias("t")).scalar()
    return counts.withColumn("weight", totals["rows"] / (totals["classes"] * F.col("n")))


@dataclass(frozen=True, eq=False)
class TextModel:
    """A linear classifier over TF-IDF rows; its size is vocabulary times classes.

    The margin of a class is its intercept plus the dot product of the row with its
    ``coefficients`` (one row per class); probabilities are the softmax of the margins.
    """

    terms: tuple[str, ...]
    idf: tuple[float, ...]
    labels: tuple[str, ...]
    coefficients: np.ndarray
    intercepts: tuple[float, ...]

    def rows(self, df: DataFrame) -> DataFrame:
        """``df`` with the sparse TF-IDF arrays that the model sees."""
        return sparse_rows(df, list(self.terms), list(self.idf))

    def reduced(self, terms: list[str]) -> TextModel:
        """The same over some of its terms, in their order."""
        at = {term: k for k, term in enumerate(self.terms)}
        kept = [at[term] for term in terms]
        idf = tuple(self.idf[k] for k in kept)
        return TextModel(tuple(terms), idf, self.labels, self.coefficients[:, kept], self.intercepts)


def _prepared(df: DataFrame) -> DataFrame:
    """Usable labelled rows, spread evenly once, over as many partitions as their size asks for."""
    spread = usable_labels(df).select("description", "category").hint("rebalance")
    return materialise(spread, "training")


def _classes(weights: DataFrame) -> list:
    classes = weights.orderBy("category").collect()
    if len(classes) < 2:
        raise ValueError("training needs at least two categories")
    return classes


def fit(df: DataFrame, p: Params = _P, vocab: list | None = None, classes: list | None = None) -> TextModel:
    """Multinomial logistic regression on (description, category).

    What reaches the driver is part of the model: the vocabulary (``p.vocabulary`` terms), the
    class list, unless they are given, and the coefficients. Two classes share one coefficient row, as the binomial objective
    has it. The penalty is scaled so that the optimum is that of
    C * sum(weight * loss) + |W|^2 / 2 with a free intercept.
    """
    labelled = _prepared(df)
    classes = classes or _classes(class_weights(labelled))
    vocab = vocab or collect_vocabulary(vocabulary(labelled, p=p))
    terms, idf = [v["term"] for v in vocab], [v["idf"] for v in vocab]
    vector = _vector(terms, F.col("position"), F.col("weight"))
    numbered = sparse_rows(labelled, terms, idf).select(*_targets(classes), vector.alias("features"))
    schema = T.StructType([
        T.StructField("label", T.DoubleType()), T.StructField("weight", T.DoubleType()), T.StructField("features", VectorUDT())
    ])
    coefficients, intercepts = _optimum(materialise(numbered, "features", schema=schema), classes, p)
    return TextModel(tuple(terms), tuple(idf), tuple(c["category"] for c in classes), coefficients, intercepts)


def _vector(terms: list[str], position, values):
    """The stored form of a sparse vector; read back as vectors, so no Python builds them."""
    return F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(len(terms)).alias("size"),
        position.alias("indices"), values.alias("values"),
    )


def _targets(classes: list) -> list:
    """``label`` and ``weight`` of a row by its category."""
    label = F.array_position(F.array(*(F.lit(c["category"]) for c in classes)), F.col("category")) - 1
    weights = F.array(*(F.lit(float(c["weight"])) for c in classes))
    return [label.cast("double").alias("label"), F.get(weights, label.cast("int")).alias("weight")]


def _optimum(numbered: DataFrame, classes: list, p: Params) -> tuple[np.ndarray, tuple[float, ...]]:
    """Coefficients, one row per class, and intercepts of (label, weight, features) rows."""
    rows = sum(c["n"] for c in classes)
    fitted = LogisticRegression(
        family="auto",
        weightCol="weight",
        regParam=1.0 / (p.inverse_penalty * rows),
        standardization=False,
        maxIter=p.max_iter,
    ).fit(numbered)
    coefficients, intercepts = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    if len(coefficients) == 1:
        coefficients, intercepts = np.vstack([0 * coefficients, coefficients]), np.array([0.0, *intercepts])
    return coefficients, tuple(intercepts.tolist())


def fit_centroids(df: DataFrame, p: Params = _P) -> TextModel:
    """Nearest-centroid classifier on (description, category), in closed form.

    A class is the direction of the sum of its rows' TF-IDF vectors, its margin
    ``p.centroid_sharpness`` times the cosine with it. One pass over the rows after the
    vocabulary: sums per class and term, folded before the shuffle. No iterations and
    no random numbers, so SQL repeats it.
    """
    labelled = _prepared(df)
    vocab = collect_vocabulary(vocabulary(labelled, p=p))
    terms, idf = [v["term"] for v in vocab], [v["idf"] for v in vocab]
    labels = [c["category"] for c in _classes(class_weights(labelled))]
    entries = sparse_rows(labelled, terms, idf).select("category", F.inline(F.arrays_zip("position", "weight")))
    sums = entries.groupBy("category", "position").agg(F.sum("weight").alias("s"))
    coefficients = np.zeros((len(labels), len(terms)))
    for row in sums.collect():  # classes times vocabulary, as the model itself
        coefficients[labels.index(row["category"]), row["position"]] = row["s"]
    lengths = np.sqrt((coefficients**2).sum(axis=1, keepdims=True))
    coefficients = p.centroid_sharpness * np.divide(coefficients, lengths, out=np.zeros_like(coefficients), where=lengths > 0)
    return TextModel(tuple(terms), tuple(idf), tuple(labels), coefficients, (0.0,) * len(labels))


def predict(df: DataFrame, model: TextModel, top: int = 3) -> DataFrame:
    """Rows plus ``predicted_category``, ``predicted_confidence`` and the ``top3`` classes.

    Row-local and in the JVM: no shuffle, no Python. Coefficients are array literals that a row's
    positions index. Equal probabilities keep class order.
    """
    # The row's columns are numbered on the way, so their names can't meet those made here.
    numbered = [F.col(f"`{c}`").alias(f"_in{k}") for k, c in enumerate(df.columns)]
    ranked = _ranked(model.rows(df.select(*numbered, "description")), model.coefficients, model.intercepts)
    labels = F.array(*(F.lit(c) for c in model.labels))
    named = F.transform(
        F.slice("_r", 1, top),
        lambda e: F.struct(F.get(labels, e["i"]).alias("category"), F.round(-e["q"], 4).alias("probability")),
    )
    best = F.get("_r", F.lit(0))
    return ranked.select(
        *(F.col(f"_in{k}").alias(c) for k, c in enumerate(df.columns)),
        F.get(labels, best["i"]).alias("predicted_category"),
        F.round(-best["q"], 4).alias("predicted_confidence"),
        named.alias("top3"),
    )


def _ranked(rows: DataFrame, coefficients: np.ndarray, intercepts: tuple[float, ...]) -> DataFrame:
    """Rows of ``position`` and ``weight`` with ``_r``: (-probability, class number), the likeliest class first."""
    entries = pinned(rows, _e=F.arrays_zip("position", "weight")).drop("position", "weight")

    def margin(intercept, row):
        known = numbers(row)
        return F.aggregate("_e", F.lit(float(intercept)), lambda s, e: s + e["weight"] * F.get(known, e["position"]))

    margins = pinned(entries, _m=F.array(*map(margin, intercepts, coefficients))).drop("_e")
    raised = pinned(margins, _x=F.transform("_m", lambda m: F.exp(m - F.array_max("_m")))).drop("_m")
    scored = pinned(raised, _total=F.aggregate("_x", F.lit(0.0), lambda s, x: s + x))
    order = F.sort_array(F.transform("_x", lambda x, i: F.struct((-x / F.col("_total")).alias("q"), i.alias("i"))))
    return pinned(scored, _r=order)


def save_model(spark: SparkSession, model: TextModel, path: str) -> None:
    """Two small tables below ``path``: terms with their idf and coefficients, classes with their intercepts."""
    terms = [(i, t, w, model.coefficients[:, i].tolist()) for i, (t, w) in enumerate(zip(model.terms, model.idf))]
    classes = [(i, c, b) for i, (c, b) in enumerate(zip(model.labels, model.intercepts))]
    for name, rows, schema in (
        ("terms", terms, "position int, term string, idf double, coefficients array<double>"),
        ("classes", classes, "position int, label string, intercept double"),
    ):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")


def load_model(spark: SparkSession, path: str) -> TextModel:
    """The saved classifier; FileNotFoundError if there is none."""
    try:
        terms, classes = (spark.read.parquet(f"{path}/{name}").orderBy("position").collect() for name in ("terms", "classes"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no trained model at {path}; run train() with a model path first") from error
    coefficients = np.array([t["coefficients"] for t in terms]).reshape(len(terms), len(classes)).T
    return TextModel(
        tuple(t["term"] for t in terms), tuple(t["idf"] for t in terms), tuple(c["label"] for c in classes),
        coefficients, tuple(c["intercept"] for c in classes),
    )


def classification_report(df: DataFrame) -> DataFrame:
    """Precision, recall, f1 and support per class with accuracy and averages.

    Takes (label, prediction) rows. Everything after the confusion counts works on
    classes, not rows. A ratio without a denominator is 0.
    """
    n = F.col("n")
    hit = F.col("label") == F.col("prediction")
    confusion = df.groupBy("label", "prediction").agg(F.count("*").alias("n"))
    sides = confusion.select(F.inline(F.array(
        F.struct(F.col("label").alias("class"), F.when(hit, n).otherwise(0).alias("tp"),
                 n.alias("actual"), F.lit(0).cast("bigint").alias("predicted")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("tp"),
                 F.lit(0).cast("bigint").alias("actual"), n.alias("predicted")),
    )))
    per_class = sides.groupBy("class").agg(
        F.sum("tp").alias("tp"), F.sum("actual").alias("support"), F.sum("predicted").alias("predicted")
    )

    def ratio(a, b):
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    precision, recall = ratio(F.col("tp"), F.col("predicted")), ratio(F.col("tp"), F.col("support"))
    measured = per_class.select("class", "tp", "support", precision.alias("precision"), recall.alias("recall"))
    f1 = ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    # Each class counts towards its own line and both averages; a line is a weighted mean.
    one, support = F.lit(1.0), F.col("support").cast("double")
    lines = measured.withColumn("f1", f1).select(
        "tp", "support", "precision", "recall", "f1",
        F.inline(F.array(
            F.struct(F.col("class").alias("name"), one.alias("w")),
            F.struct(F.lit("macro avg").alias("name"), one.alias("w")),
            F.struct(F.lit("weighted avg").alias("name"), support.alias("w")),
        )),
    )

    def mean(c):
        return F.round(ratio(F.sum(F.col(c) * F.col("w")), F.sum("w")), 4).alias(c)

    report = lines.groupBy("name").agg(
        mean("precision"), mean("recall"), mean("f1"), F.sum("support").alias("support")
    )
    accuracy = measured.agg(F.round(ratio(F.sum("tp"), F.sum("support")), 4).alias("a")).scalar()
    return report.withColumn("accuracy", accuracy)


def accuracy(predicted: DataFrame) -> float:
    """Share of rows whose prediction equals the label."""
    return predicted.agg(F.avg((F.col("category") == F.col("predicted_category")).cast("double"))).first()[0]


@dataclass(frozen=True, eq=False)
class TrainingRows:
    """Labelled rows encoded once for the training part of the split and that of every fold.

    ``stored`` has category, split, fold and ``counts``, the damped counts of ``terms``: the terms of any of these parts'
    vocabularies. A part's features are its counts times its own idf, 0 for terms outside its vocabulary, so no fit or
    test reads a text and none writes its features. ``sizes`` counts rows by category, split and fold.
    """

    stored: DataFrame
    sizes: DataFrame
    terms: tuple[str, ...]
    vocabularies: dict
    p: Params

    def idf(self, part) -> list[float]:
        known = {v["term"]: v["idf"] for v in self.vocabularies[part]}
        return [known.get(term, 0.0) for term in self.terms]

    def fit(self, part) -> TextModel:
        """The part's model over all ``terms``; those outside its vocabulary have no weight."""
        classes, idf = _part_classes(self.sizes, part), self.idf(part)
        rows = self.stored.filter(_trains(part)).select(*_targets(classes), F.col("counts"))
        scaled = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="counts", outputCol="scaled").transform(rows)
        features = Normalizer(p=2.0, inputCol="scaled", outputCol="features").transform(scaled)
        coefficients, intercepts = _optimum(features.select("label", "weight", "features"), classes, self.p)
        return TextModel(self.terms, tuple(idf), tuple(c["category"] for c in classes), coefficients, intercepts)

    def tested(self, part, model: TextModel) -> DataFrame:
        """(category, predicted_category) of the rows that the part doesn't train on, by its ``fit``."""
        counts = F.unwrap_udt("counts")
        rows = pinned(self.stored.filter(~_trains(part)).select("category", "counts"), _v=counts).select(
            "category", F.col("_v.indices").alias("position"), F.col("_v.values").alias("damped")
        )
        ranked = _ranked(weighted_rows(rows, list(model.idf)), model.coefficients, model.intercepts)
        labels = F.array(*(F.lit(c) for c in model.labels))
        return ranked.select("category", F.get(labels, F.get("_r", F.lit(0))["i"]).alias("predicted_category"))

    def fold_scores(self) -> list[float]:
        """Held-out accuracy of every fold.

        Folds are submitted some at a time, so the cluster is not idle between the many short jobs of one fit.
        """

        def score(fold: int) -> float:
            return accuracy(self.tested(fold, self.fit(fold)))

        with ThreadPool(_AT_ONCE) as pool:
            return pool.map(inheritable_thread_target(self.stored.sparkSession)(score), range(self.p.folds), 1)


def _trains(part):
    """Whether a row is trained on: in ``train`` of the split, or outside a fold."""
    return F.col("split") == "train" if part == "train" else F.col("fold") != part


def _part_classes(sizes: DataFrame, part) -> list:
    return _classes(balanced_weights(sizes.filter(_trains(part)).groupBy("category").agg(F.sum("n").alias("n"))))


def encode(df: DataFrame, row_id: str, p: Params = _P) -> TrainingRows:
    """Usable labelled rows, split, dealt to folds and encoded.

    Each text is taken apart once. From there on its words go along, in one copy, until the vocabularies are
    known and they have become counts; every table but the counts is removed when nothing reads it any more.
    """
    texts = usable_labels(df).select(row_id, "category", clean_text(F.col("description")).alias("_text"))
    cells = split_and_folds(texts, "category", row_id, p)
    sizes = materialise(cells.groupBy("category", "split", "fold").agg(F.count("*").alias("n")), "training-sizes")
    folds = {k: f"fold{k}" for k in range(p.folds)}
    conditions = {"train": _trains("train")} | {name: F.col("fold") == k for k, name in folds.items()}
    names = {"train": ["train"]} | {k: [n for j, n in folds.items() if j != k] for k in folds}
    rows = {part: sum(c["n"] for c in _part_classes(sizes, part)) for part in names}
    # A text without words is one empty word when split.
    tokens = F.when(F.col("_text") != "", F.split("_text", " ")).otherwise(F.array().cast("array<string>"))
    words = pinned(cells, _words=tokens).drop("_text")
    found = set_vocabularies(words, conditions, {part: (names[part], rows[part]) for part in names}, p)
    terms = sorted({v["term"] for vocab in found.values() for v in vocab})
    known = only_words(words, sorted({word for term in terms for word in term.split(" ")})) if terms else words
    encoded = damped_counts(known, terms, F.col("_words"), gaps=True).select(
        "category", "split", "fold", _vector(terms, F.col("position"), F.col("damped")).alias("counts")
    )
    schema = T.StructType([
        *encoded.select("category", "split", "fold").schema.fields, T.StructField("counts", VectorUDT())
    ])
    stored = materialise(encoded, "training-counts", "zstd", schema)
    discard(cells)
    return TrainingRows(stored, sizes, tuple(terms), found, p)


def train(df: DataFrame, row_id: str, p: Params = _P, model_path: str | None = None) -> dict:
    """Split, fit, evaluate, cross-validate and optionally save.

    Returns the model, the held-out report and a one-row summary DataFrame.
    """
    rows = encode(df, row_id, p)
    fitted = rows.fit("train")
    tested = materialise(rows.tested("train", fitted), "tested")
    scores = rows.fold_scores()
    discard(rows.stored)
    model = fitted.reduced([v["term"] for v in rows.vocabularies["train"]])
    if model_path:
        save_model(df.sparkSession, model, model_path)

    def size(split: str):
        return F.coalesce(F.sum(F.when(F.col("split") == split, F.col("n"))), F.lit(0).cast("bigint"))

    sizes = rows.sizes.agg(size("train").alias("training_size"), size("test").alias("test_size"))
    summary = sizes.select(
        F.lit(round(accuracy(tested), 4)).alias("accuracy"),
        F.lit(round(float(np.mean(scores)), 4)).alias("cv_mean"),
        F.lit(round(float(np.std(scores)), 4)).alias("cv_std"),
        "training_size",
        "test_size",
        F.lit(len(model.labels)).alias("categories"),
    )
    report = classification_report(
        tested.select(F.col("category").alias("label"), F.col("predicted_category").alias("prediction"))
    )
    return {"model": model, "summary": summary, "report": report, "cv_scores": scores}


def cross_validate(df: DataFrame, row_id: str, p: Params = _P) -> list[float]:
    """Held-out accuracy of every fold; vocabulary and weights are refitted per fold."""
    rows = encode(df, row_id, p)
    scores = rows.fold_scores()
    discard(rows.stored)
    return scores
