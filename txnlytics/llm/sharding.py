"""Permutation-filled lookup table: constant-time placement that moves few keys when shards change."""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from txnlytics.llm.common import renamed_free

#: A prime: slots of the table. The table is broadcast, so this is the bound of its size.
SLOTS = 65_537


def _number(text: str) -> int:
    return int(md5(text.encode()).hexdigest()[:15], 16)


def fill_table(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """For each slot the index of its shard.

    A shard prefers the slots offset, offset + skip, offset + 2 skip, ... (modulo the prime
    number of slots), both drawn from its name. Shards take turns, each claiming its next
    free preferred slot, until all are claimed; so shares differ by one slot at most.
    """
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be named, each once")
    if slots < len(shards) or any(slots % p == 0 for p in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be a prime number, at least the number of shards")
    place = [_number(f"offset:{name}") % slots for name in shards]
    skip = [_number(f"skip:{name}") % (slots - 1) + 1 for name in shards]
    table, left = [-1] * slots, slots
    while left:
        for k in range(len(shards)):
            if not left:
                break
            while table[place[k]] >= 0:
                place[k] = (place[k] + skip[k]) % slots
            table[place[k]] = k
            left -= 1
    return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: 60 bits of its MD5 modulo the slots; null is the word ``null``."""
    text = F.coalesce(key.cast("string"), F.lit("null"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long") % slots


def assign_shards(df: DataFrame, shards: Sequence[str], key: str = "doc_id", slots: int = SLOTS) -> DataFrame:
    """Rows of ``df`` with ``slot`` and ``shard``.

    Equal keys, repeated rows included, share a shard; a null key has one too; other
    columns are not looked at; an empty table gives an empty table; columns named ``slot``
    or ``shard`` are replaced. The lookup has ``slots`` rows, a fixed bound, and is broadcast: placement is one hash
    probe per row, with no shuffle.
    """
    out = renamed_free(df, "slot", "shard").withColumn("slot", slot_of(F.col(key), slots))
    table = _lookup(df.sparkSession, shards, slots)
    return out.join(F.broadcast(table), "slot").select(*[c for c in out.columns if c != "slot"], "slot", "shard")


def _lookup(spark: SparkSession, shards: Sequence[str], slots: int) -> DataFrame:
    import pandas as pd

    owner = [shards[k] for k in fill_table(shards, slots)]
    return spark.createDataFrame(pd.DataFrame({"slot": range(slots), "shard": owner}), "slot long, shard string")
