"""Five stages from raw documents to packed sequences; each is written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from txnlytics.llm import exact, jaccard, mixing, packing, quality
from txnlytics.llm.common import carried, restored
from txnlytics.session import materialise


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, then documents that the rules reject."""
    judged = quality.clean_lines(carried(docs, "text")).filter("kept")
    text = F.col("cleaned_text")
    return judged.select(*restored(judged, docs.columns, ("text",), text=text, n_chars=F.length(text).cast("long")))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of equal texts stays."""
    return exact.keep_first_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of near copies (five words, similarity 0.8) stays."""
    return jaccard.keep_one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document has as many rows as the mix takes copies of it."""
    used = ("doc_id", "text", "source")
    mixed = mixing.mix_sources(carried(docs, *used), carry=("text", "source", "_rest")).filter("copies > 0")
    times = F.array_repeat(F.lit(0), F.col("copies").cast("int"))
    return mixed.withColumn("_copy", F.explode(times)).select(*restored(mixed, docs.columns, used))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, packed into sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("exact dedup", exact_stage),
    ("n-gram jaccard join", near_stage),
    ("source mixing", mixing_stage),
    ("best-fit packing", packing_stage),
]

#: SQL has no tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
