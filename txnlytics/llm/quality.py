"""Line-first cleaning: rules judge each line, failing lines go, documents that lose too much text go."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from txnlytics.llm.common import BLANKS, renamed_free, text_of, without, words_of

# --- Fixed values ---------------------------------------------------------------
SYMBOLS = "#*$%&|<>"
SEPARATORS = "|»›•·→"
BOILERPLATE = (
    "all rights reserved",
    "licensed under the",
    "is licensed under",
    "terms of service",
    "terms of use",
    "privacy policy",
    "cookie policy",
    "accept cookies",
    "subscribe to our newsletter",
    "click here to",
    "enable javascript",
    "skip to content",
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class LineRules:
    """Thresholds of the line rules and of the document verdict."""

    symbol_share: float = 0.10
    separators: int = 2
    separator_share: float = 0.2
    shouted_words: int = 3
    repeat_words: int = 8
    repeat_share: float = 0.4
    boilerplate_chars: int = 300
    lost_share: float = 0.3
    min_words: int = 50
    max_repeat_percent: int = 50


def _count(line: Column, characters: str) -> Column:
    return F.length(line) - F.length(without(line, characters))


def line_fails(line: Column, rules: LineRules) -> Column:
    """True for a line of symbols, a navigation line, a shouted line, a line of repeated words, or boilerplate."""
    words = words_of(line)
    n_words = F.size(words)
    marks = _count(line, SYMBOLS)
    separators = _count(line, SEPARATORS)
    symbols = marks > F.length(line) * rules.symbol_share
    navigation = (separators >= rules.separators) & (separators >= n_words * rules.separator_share)
    shouted = (line == F.upper(line)) & (line != F.lower(line)) & (n_words >= rules.shouted_words)
    repeated = (n_words >= rules.repeat_words) & (F.size(F.array_distinct(words)) < n_words * rules.repeat_share)
    low = F.lower(line)
    known = F.lit(False)
    for phrase in BOILERPLATE:
        known = known | low.contains(phrase)
    return symbols | navigation | shouted | ((F.length(line) <= rules.boilerplate_chars) & known) | repeated


def _repeat_words(starts: Column) -> Column:
    """Words covered by three-word windows that begin at the (sorted) positions."""
    step = F.transform(starts, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + 1) - p, F.lit(3))))
    return F.aggregate(step, F.lit(0), lambda a, x: a + x)


def clean_lines(df: DataFrame, rules: LineRules = LineRules(), text: str = "text") -> DataFrame:
    """Add the text counts, ``base_failed``, ``lost_chars``, ``line_chars``, ``cleaned_text`` and ``kept``.

    A null text is empty: no words, so ``base_failed``. Lines without a word carry no
    verdict and no weight; they are not part of ``cleaned_text``. Everything is
    row-local: no shuffle, so hot sources, copies and repeated rows do not matter. An
    empty table gives an empty table. Columns of ``df`` named like an added one are
    replaced.
    """
    out = renamed_free(
        df, *COUNTS, "base_failed", "kept", "lost_chars", "line_chars", "cleaned_text",
        "_t", "_words", "_lines", "_bad", "_windows", "_hits", "_starts",
    )
    out = out.withColumn("_t", text_of(text)).select(
        "*",
        words_of(F.col("_t")).alias("_words"),
        F.filter(F.split("_t", "\n"), lambda s: F.length(F.btrim(s, F.lit(BLANKS))) > 0).alias("_lines"),
    )
    n = F.size("_words")
    windows = F.when(
        n >= 3,
        F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)),
        ),
    )
    out = out.select(
        "*",
        windows.alias("_windows"),
        F.transform("_lines", lambda s: line_fails(s, rules)).alias("_bad"),
    )
    keyed = F.transform(F.col("_windows"), lambda h, k: F.struct(h.alias("h"), k.alias("k")))
    out = out.withColumn(
        "_hits",
        F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), F.sort_array(keyed)),
    )
    hits = F.col("_hits")
    twice = F.filter(
        hits,
        lambda x, k: (x["h"] == F.get(hits, k + 1)["h"]).eqNullSafe(F.lit(True))
        | (x["h"] == F.get(hits, k - 1)["h"]).eqNullSafe(F.lit(True)),
    )
    out = out.withColumn("_starts", F.sort_array(F.transform(twice, lambda x: x["k"])))
    chars = F.transform("_lines", lambda s: F.length(without(s, BLANKS)))
    lost = F.zip_with(F.col("_bad"), chars, lambda bad, c: F.when(bad, c).otherwise(0))
    total = lambda numbers: F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + x)
    kept_lines = F.filter(F.arrays_zip("_lines", "_bad"), lambda x: ~x["_bad"])
    found = F.struct(
        n.cast("long").alias("n_words"),
        total(chars).alias("word_chars"),
        _count(F.col("_t"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(_repeat_words(F.col("_starts")), F.lit(0)).cast("long").alias("n_repeat_words"),
        total(lost).alias("lost_chars"),
        total(chars).alias("line_chars"),
        F.concat_ws("\n", F.transform(kept_lines, lambda x: x["_lines"])).alias("cleaned_text"),
    )
    # A generator between the counts and what is decided from them: a later filter on a
    # verdict would otherwise be pushed below, every expression above written out in it.
    helpers = ("_t", "_words", "_lines", "_bad", "_windows", "_hits", "_starts")
    out = out.select(*[c for c in out.columns if c not in helpers], F.inline(F.array(found)))
    failed = (F.col("n_words") < rules.min_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * rules.max_repeat_percent
    )
    heavy = F.col("lost_chars") > F.col("word_chars") * rules.lost_share
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & ~heavy)
