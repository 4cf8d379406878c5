"""Term counts, vocabulary and TF-IDF weights over unigrams and bigrams."""

from __future__ import annotations

from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, functions as F

from txnlytics.functions.text import words
from txnlytics.params import Params
from txnlytics.session import discard, materialise

_P = Params()
_WORD_LIST = 8  # vocabularies long at most, where words are named to keep bigrams out


def neighbours(tokens: Column) -> Column:
    """Every pair of neighbours, null where either is."""
    pairs = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.zip_with(F.slice(tokens, 1, pairs), F.slice(tokens, 2, pairs), lambda a, b: F.concat(a, F.lit(" "), b))


def with_bigrams(tokens: Column) -> Column:
    """The words followed by every pair of neighbours."""
    return F.concat(tokens, neighbours(tokens))


def _occurrences(df: DataFrame, terms: Column, by: tuple[str, ...]) -> DataFrame:
    """(``by``, term, first) for every term of a row; ``first`` where it is the row's first of that term.

    Terms are sorted inside each row, so a term that differs from its neighbour is
    its first occurrence there and counts the row once; no document is shuffled.
    """
    ordered = df.select(*by, F.sort_array(terms).alias("_sorted"))
    behind = F.slice("_sorted", 1, F.greatest(F.size("_sorted") - 1, F.lit(0)))
    previous = F.concat(F.array(F.lit(None).cast("string")), behind)
    # The outer form stops the optimiser from filtering on the array's size first, which
    # would compute the array twice.
    pairs = ordered.select(
        *by, F.inline_outer(F.arrays_zip(F.col("_sorted").alias("term"), previous.alias("previous")))
    )
    first = F.col("previous").isNull() | (F.col("previous") != F.col("term"))
    return pairs.filter(F.col("term").isNotNull()).select(*by, "term", first.alias("first"))


def ngram_counts(df: DataFrame, text: str = "description", by: tuple[str, ...] = ()) -> DataFrame:
    """(``by``, term, n_total, n_docs) over all rows; one shuffle of map-side totals."""
    tokens = df.select(*by, words(F.col(text)).alias("_words"))
    return _occurrences(tokens, with_bigrams(F.col("_words")), by).groupBy(*by, "term").agg(
        F.count("*").alias("n_total"), F.count_if("first").alias("n_docs")
    )


def top_terms(counts: DataFrame, rows: Column, p: Params = _P) -> DataFrame:
    """The most frequent terms that are not in nearly every row, with their idf.

    At most ``p.vocabulary`` rows; equal counts are settled by the term. idf is
    ln((1 + rows) / (1 + rows with the term)) + 1.
    """
    kept = counts.filter(F.col("n_docs") <= rows * F.lit(p.max_df))
    top = kept.orderBy(F.desc("n_total"), "term").limit(p.vocabulary)
    return top.withColumn("idf", F.log((F.lit(1.0) + rows) / (F.lit(1.0) + F.col("n_docs"))) + 1)


def vocabulary(df: DataFrame, text: str = "description", p: Params = _P) -> DataFrame:
    """``top_terms`` of all rows."""
    rows = df.agg(F.count("*").alias("n")).scalar()
    return top_terms(ngram_counts(df, text), rows, p)


def without_fold(counts: DataFrame, fold: int) -> DataFrame:
    """Term counts of all rows outside a fold: the total less the fold's, from counts kept per fold."""
    outside = [F.sum(F.when(F.col("fold") != fold, F.col(c)).otherwise(0)).alias(c) for c in ("n_total", "n_docs")]
    return counts.groupBy("term").agg(*outside).filter(F.col("n_docs") > 0)


def only_words(df: DataFrame, kept: list[str]) -> DataFrame:
    """``df`` with null in ``_words`` for words not in the list, so that neighbours stay neighbours."""
    # Words are letters only, so they need no escapes.
    known = F.expr(f"transform(_words, w -> if(w in ({', '.join(map(repr, kept))}), w, null))")
    return pinned(df, _known=known).drop("_words").withColumnRenamed("_known", "_words")


def set_vocabularies(df: DataFrame, parts: dict[str, Column], sets: dict, p: Params = _P) -> dict:
    """The collected ``top_terms`` of several overlapping sets of rows, from two counts over all rows.

    ``df`` has the words of each row as ``_words``. ``parts`` are conditions on rows; ``sets`` names for each set the
    parts it consists of and its number of rows. Words are counted first. A bigram is no more frequent than either of
    its words, so one whose words don't both reach the last place that words alone leave open in some
    set cannot enter any vocabulary; it is neither shuffled nor stored. Where words leave places open, or too many are
    tied for the last one, all bigrams are counted.
    """
    flags = [c.alias(k) for k, c in parts.items()]

    def tallied(terms: Column) -> DataFrame:
        found = _occurrences(df.select("_words", *flags), terms, tuple(parts))
        totals = [F.count_if(F.col(k)).alias(f"total_{k}") for k in parts]
        return found.groupBy("term").agg(*totals, *(F.count_if(F.col(k) & F.col("first")).alias(f"docs_{k}") for k in parts))

    def added(what: str, key) -> Column:
        return sum((F.col(f"{what}_{k}") for k in sets[key][0]), F.lit(0))

    def top(counts: DataFrame, key) -> list:
        own = counts.select("term", added("total", key).alias("n_total"), added("docs", key).alias("n_docs"))
        return collect_vocabulary(top_terms(own.filter(F.col("n_docs") > 0), F.lit(sets[key][1]), p))

    single = materialise(tallied(F.col("_words")), "word-counts", "zstd")
    reaching = F.lit(False)
    for key in sets:
        best = top(single, key)
        floor = best[-1]["n_total"] if len(best) == p.vocabulary else 0
        reaching = reaching | (added("total", key) >= floor)
    most = _WORD_LIST * p.vocabulary
    listed = [r["term"] for r in single.filter(reaching).select("term").limit(most + 1).collect()]
    if 0 < len(listed) <= most:
        df = only_words(df, listed)
    pairs = F.array_compact(neighbours(F.col("_words")))
    double = materialise(tallied(pairs).filter(reaching), "bigram-counts", "zstd")
    both = single.unionByName(double)
    found = {key: top(both, key) for key in sets}
    discard(single, double)
    return found


def collect_vocabulary(vocab: DataFrame) -> list:
    """Vocabulary rows in a fixed order; at most ``p.vocabulary`` of them."""
    return vocab.orderBy(F.desc("n_total"), "term").collect()


def pinned(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns computed once per row, however often later expressions name them.

    The generator keeps the optimiser from copying their expressions into those.
    """
    made = F.struct(*(c.alias(name) for name, c in columns.items()))
    return df.select(*(F.col(f"`{c}`") for c in df.columns), F.inline_outer(F.array(made)))


def damped_counts(df: DataFrame, terms: list[str], tokens: Column, gaps: bool = False) -> DataFrame:
    """``df`` with ``position`` and ``damped``: 1 + ln(count) of every known term of a row as two arrays.

    Row-local and in the JVM: terms are counted by hash lookup. A row without known terms has empty arrays.
    ``gaps``: some tokens are null, standing for words of no term.
    """
    grams = with_bigrams(F.col("_tokens"))
    counted = CountVectorizerModel.from_vocabulary(terms, "_terms", "_counts").transform(
        pinned(df, _tokens=tokens).withColumn("_terms", F.array_compact(grams) if gaps else grams)
    )
    own = [F.col(f"`{c}`") for c in df.columns]
    sparse = pinned(counted.select(*own, F.unwrap_udt("_counts").alias("_v")), _u=F.col("_v"))
    return sparse.select(*own, F.col("_u.indices").alias("position"), F.transform("_u.values", lambda n: 1 + F.log(n)).alias("damped"))


def weighted_rows(df: DataFrame, idf: list[float]) -> DataFrame:
    """``weight`` in place of ``damped``: weighted by idf, divided by the row's length; terms of idf 0 have no part."""
    known = numbers(idf)
    raw = pinned(df, _raw=F.zip_with("damped", "position", lambda n, i: n * F.get(known, i))).drop("damped")
    length = F.sqrt(F.aggregate("_raw", F.lit(0.0), lambda s, w: s + w * w))
    scaled = pinned(raw, _length=length)
    weight = F.transform("_raw", lambda w: F.when(F.col("_length") > 0, w / F.col("_length")).otherwise(F.lit(0.0)))
    return scaled.withColumn("weight", weight).drop("_raw", "_length")


def sparse_rows(df: DataFrame, terms: list[str], idf: list[float], text: str = "description") -> DataFrame:
    """``df`` with ``position`` and ``weight``: the unit-length TF-IDF vector of each row as two arrays.

    Row-local and in the JVM. A row without known terms has empty arrays.
    """
    return weighted_rows(damped_counts(df, terms, words(F.col(text))), idf)


def numbers(values) -> Column:
    """A constant array; the optimiser folds it to one literal, whatever its length."""
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")


def tfidf_weights(df: DataFrame, row_id: str, p: Params = _P) -> DataFrame:
    """(row id, term, weight) of every ``description``: the vectors the classifier sees, as rows.

    Apart from the vocabulary there is no shuffle and no Python.
    """
    vocab = collect_vocabulary(vocabulary(df, p=p))
    names = df.sparkSession.createDataFrame(
        [(i, v["term"]) for i, v in enumerate(vocab)], "position int, term string"
    )
    rows = sparse_rows(df.select(row_id, "description"), [v["term"] for v in vocab], [v["idf"] for v in vocab])
    # The outer form keeps the optimiser from repeating the arrays in a filter on their size.
    entries = rows.select(row_id, F.inline_outer(F.arrays_zip("position", "weight")))
    named = entries.filter(F.col("position").isNotNull()).join(F.broadcast(names), "position")
    return named.select(row_id, "term", "weight")
