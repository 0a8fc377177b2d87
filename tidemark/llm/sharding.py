"""Jump consistent hashing: stable keys to shards without a ring table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.numbering import number_rows

LAW = "key"


def jump_shard(key: Column, shards: int) -> Column:
    """The shard of ``key`` among ``shards``; NULL keys hash like any other value.

    A key starts in shard 0 and jumps forward: with ``r`` uniform in (0, 1], drawn by a hash of the
    key and the shard it stands in, the next shard that takes it is ``floor((b + 1) / r)``. Jumps do
    not depend on the number of shards, so one more shard takes ``1 / (shards + 1)`` of the keys
    into itself and no key moves otherwise. At most ``shards`` jumps, ``ln(shards)`` on average.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")

    def jump(state: Column, _: Column) -> Column:
        drawn = F.shiftrightunsigned(F.xxhash64(key, F.lit("jump"), state["next"]), 11) + F.lit(1)
        onward = F.floor((state["next"] + F.lit(1)) * F.lit(float(1 << 53)) / drawn)
        return F.when(
            state["next"] < shards, F.struct(state["next"].alias("at"), onward.cast("long").alias("next"))
        ).otherwise(state)

    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("next"))
    steps = F.sequence(F.lit(1), F.lit(shards))
    return F.aggregate(steps, start, jump, lambda state: state["at"]).cast("int")


def shard(df: DataFrame, key: str, text: str, shards: int) -> DataFrame:
    """``key, size, text_crc32, law, shard, slot, grown_shard`` for every row.

    ``size`` is the text's UTF-8 bytes plus 8. Slots count from 0 without gaps in each shard; equal
    texts of a shard lie next to each other. Rows are numbered once over (shard, checksum, size,
    key) in ranges, so neither a large shard nor a text that many rows share meets in one task
    unless its rows are equal in every column shown.

    A NULL text has size 8 and checksum 0; a NULL key goes where its hash says; repeated rows get
    slots of their own; an empty table gives no rows; further columns are ignored.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    placed = df.select(
        F.col(key).alias("key"),
        (F.octet_length(body) + F.lit(8)).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        jump_shard(F.col(key), shards).alias("shard"),
    )
    numbered = number_rows(placed, ["shard", "text_crc32", "size", "key"], name="number", start=0)
    # one row per shard: the sum of the rows in front of it
    counts = numbered.groupBy("shard").agg(F.min("number").alias("first"))
    return numbered.join(F.broadcast(counts), "shard").select(
        F.col("key").alias(key),
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        (F.col("number") - F.col("first")).alias("slot"),
        jump_shard(F.col("key"), shards + 1).alias("grown_shard"),
    )
