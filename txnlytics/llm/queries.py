"""The operators applied to the benchmark tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from txnlytics.llm import (
    chat, exact, jaccard, language, mixing, packing, pitman_yor, quality, runs, sharding, spelling, suffix, vectors
)
from txnlytics.llm.chat import Argument
from txnlytics.llm.common import words_of
from txnlytics.llm.sql import SHARDS

Query = Callable[[SparkSession, str], DataFrame]

TURN_SCHEMAS = {
    "reply": {"length": Argument("integer"), "prompt": Argument("string"), "turn": Argument("integer")},
    "greet": {
        "length": Argument("integer"),
        "prompt": Argument("string"),
        "turn": Argument("integer"),
        "urgent": Argument("boolean", required=False),
    },
}

_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_language_id(spark, folder):
    held_out = language.remainder("doc_id", 3) == 1
    docs = _table(spark, folder, "documents").select("doc_id", "text", "lang").withColumn("held_out", held_out)
    model = language.fit(docs.filter(~F.col("held_out")))
    return language.identify(docs.select("doc_id", "held_out", "text"), model)


@query
def op2_lm_scoring(spark, folder):
    held_out = language.remainder("doc_id", 7) == 2
    scored = pitman_yor.score_texts(_table(spark, folder, "documents").select("doc_id", "text"), ~held_out)
    return scored.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"
    )


@query
def op3_chat_formatting(spark, folder):
    """User turns as calls (each waiting for the conversation's previous one), the following turns as results."""
    turns = _table(spark, folder, "conversations")
    name = F.when(F.col("turn") == 0, "greet").when(F.col("turn") % 7 == 6, "search").otherwise("reply")
    arguments = F.create_map(
        F.lit("prompt"), F.col("text"),
        F.lit("turn"), F.col("turn").cast("string"),
        F.lit("length"), F.when(F.col("turn") % 5 != 4, F.length("text").cast("string")).otherwise("long"),
    )
    ident = lambda turn: F.concat(F.col("conv_id").cast("string"), F.lit(":"), turn.cast("string"))
    calls = turns.filter(F.col("role") == "user").select(
        "conv_id",
        ident(F.col("turn")).alias("call_id"),
        ident(F.col("turn") - 2).alias("after"),
        name.alias("name"),
        arguments.alias("arguments"),
    )
    results = turns.filter(F.col("role") != "user").select(
        ident(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content")
    )
    linked = chat.link_calls(calls, results, TURN_SCHEMAS)
    return linked.withColumn("errors", F.concat_ws("; ", "errors"))


@query
def op4_quality_rules(spark, folder):
    judged = quality.clean_lines(_table(spark, folder, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "lost_chars", "kept")


@query
def op5_best_fit_packing(spark, folder):
    return packing.pack_documents(_table(spark, folder, "documents"))


@query
def op6_exact_dedup(spark, folder):
    found = exact.dedup(_table(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query
def op7_ngram_jaccard_join(spark, folder):
    return jaccard.near_duplicates(_table(spark, folder, "documents"), jaccard.Join(words=4, percent=85))


@query
def op8_sharding(spark, folder):
    placed = sharding.assign_shards(_table(spark, folder, "documents").select("doc_id", "source"), SHARDS)
    return placed.select("doc_id", "slot", "shard")


@query
def op9_source_mixing(spark, folder):
    mixed = mixing.mix_sources(_table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op10_suffix_array_dedup(spark, folder):
    cleaned = suffix.remove_repeats(_table(spark, folder, "documents"))
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op11_spelling_variants(spark, folder):
    """Every run whose checksum 199 divides loses a letter, as a slip of the pen would take it."""
    rules = spelling.Variants()
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    found = _table(spark, folder, "documents").select(ident.alias("ident"), F.explode(spelling.letter_runs(F.col("text"), rules.min_chars)).alias("run"))
    hashed = found.withColumn("h", F.crc32(F.concat_ws(":", "ident", "run").cast("binary")))
    gap = (F.col("h") % F.length("run")).cast("int")
    slipped = F.concat(F.substring("run", F.lit(1), gap), F.substring("run", gap + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % 199 == 0, slipped).otherwise(F.col("run")).alias("word"))
    return spelling.spelling_forms(spelling.count_words(words, rules=rules), rules)


def _with_period(docs: DataFrame) -> DataFrame:
    """In every tenth text (by checksum of its id) the words from some place on repeat with a period."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    chosen = docs.withColumn("h", h).withColumn("w", F.when(F.col("h") % 10 == 0, words_of(F.col("text"))))
    g, n = F.floor(F.col("h") / 10), F.size("w")
    begun = chosen.withColumn("n", n.cast("long")).withColumn("a", F.when(F.col("n") > 0, g % F.col("n")))
    places = begun.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8)))
    block = F.slice("w", (F.col("a") + 1).cast("int"), F.col("p").cast("int"))
    rest = F.col("n") - F.col("a")
    repeated = F.flatten(F.array_repeat(block, F.ceil(rest / F.col("p")).cast("int")))
    whole = F.concat(F.slice("w", F.lit(1), F.col("a").cast("int")), F.slice(repeated, F.lit(1), rest.cast("int")))
    return places.select("doc_id", F.when(F.col("n") > 0, F.array_join(whole, " ")).otherwise(F.col("text")).alias("text"))


@query
def op12_periodic_runs(spark, folder):
    found = runs.periodic_runs(_with_period(_table(spark, folder, "documents").select("doc_id", "text")))
    order = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    best = found.withColumn("best", F.array_max(order))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(-1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op13_embedding_near_dedup(spark, folder):
    return vectors.near_vectors(_table(spark, folder, "embeddings"))
