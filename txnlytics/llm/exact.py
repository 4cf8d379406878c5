"""Exact dedup with a heavy-hitter split: frequent digests are settled map-side, the rest by a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from txnlytics.llm.common import BLANKS, carried, restored, text_of, without
from txnlytics.session import materialise

#: Digests that the summary may hold and that may be broadcast: fixed, whatever the table's size.
HEAVY, COUNTERS = 4096, 16384


def digest_of(text: Column) -> Column:
    """Lower-case hex SHA-256 of the text without its blanks."""
    return F.sha2(without(text, BLANKS), 256)


def frequent_digests(keys: DataFrame, heavy: int = HEAVY, counters: int = COUNTERS) -> DataFrame:
    """At most ``heavy`` candidate digests from a Misra-Gries summary with ``counters`` counters.

    ``approx_top_k`` keeps the counters of the Misra-Gries family (decrement all when
    full), one summary per task, and merges summaries, so that no row is shuffled. A
    digest with more than about rows / counters copies is never lost; what is returned
    besides is sorted out by exact counts afterwards.
    """
    top = keys.agg(F.expr(f"approx_top_k(digest, {heavy}, {counters})").alias("top"))
    return top.select(F.inline("top")).filter(F.col("count") > 1).select(F.col("item").alias("digest"))


def dedup(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: the key, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` and ``n_chars``.

    Texts are equal if they are identical without blanks; null counts as empty, so null,
    empty and blank texts form one group. Of a group the row with the most code points
    stays, then the smallest key (null last); of rows that tie in both, exactly one has
    ``kept``. An empty table gives an empty table. Other columns of ``df`` are not used.

    Only keys, digests and lengths travel. They are written once; the frequent digests'
    winners are found by a pre-aggregated count and broadcast (at most HEAVY rows), which
    settles their rows without a shuffle. No digest left for the shuffle can be hot.
    """
    body = text_of(text)
    keys = materialise(
        df.select(
            F.col(key).alias("key"),
            F.monotonically_increasing_id().alias("row"),
            digest_of(body).alias("digest"),
            F.length(body).alias("chars"),
        ),
        "digests",
    )
    rank = F.struct((-F.col("chars")).alias("less"), F.col("key").isNull().alias("none"), "key", "row")
    candidates = F.broadcast(frequent_digests(keys))
    winners = materialise(
        keys.join(candidates, "digest", "left_semi")
        .groupBy("digest")
        .agg(F.min(rank).alias("best"), F.count("*").alias("size"))
        .filter(F.col("size") > 1),
        "winners",
    )
    hot = keys.join(F.broadcast(winners), "digest")
    group = Window.partitionBy("digest")
    rest = keys.join(F.broadcast(winners.select("digest")), "digest", "left_anti").select(
        "*", F.min(rank).over(group).alias("best"), F.count("*").over(group).alias("size")
    )
    return hot.unionByName(rest).select(
        F.col("key").alias(key),
        F.col("best.key").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
        F.col("chars").alias("n_chars"),
    )


def keep_first_copies(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, all columns.

    Rows are matched by key and digest. Rows that repeat both (and the length) are told
    apart only here: those few are ranked, all others are never shuffled by content.
    """
    found = dedup(df, key, text)
    stays = materialise(_repeats(found, key), "stays")
    body = text_of(text)
    rows = carried(df, key, text).withColumn("_digest", digest_of(body)).withColumn("_chars", F.length(body))
    match = rows[key].eqNullSafe(stays["_k"]) & (rows["_digest"] == stays["_d"]) & (rows["_chars"] == stays["_c"])
    joined = rows.join(stays, match)
    once = joined.filter(F.col("_n") == 1)
    order = Window.partitionBy("_digest", "_k").orderBy("_chars")
    several = joined.filter(F.col("_n") > 1).withColumn("_r", F.row_number().over(order)).filter(F.col("_r") == 1)
    back = restored(rows, df.columns, (key, text))
    return once.select(*back).unionByName(several.select(*back))


def _repeats(found: DataFrame, key: str) -> DataFrame:
    """The winners' (key, digest, length) and the number of rows that share all three."""
    grouped = found.groupBy(F.col(key).alias("_k"), F.col("text_sha256").alias("_d"), F.col("n_chars").alias("_c"))
    return grouped.agg(F.count("*").alias("_n"), F.max("kept").alias("_kept")).filter("_kept").drop("_kept")
