"""Sharding by jump consistent hashing.

A row's shard depends on its key and on the number of shards alone; no ring
table is kept. With one more shard, about 1/(n + 1) of the rows move, all of
them into the new shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_MULTIPLIER = np.uint64(2862933555777941757)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard 0 .. shards - 1 of each 64-bit key (Lamping and Veach, 2014)."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state = keys.astype(np.int64).view(np.uint64).copy()
    at = np.zeros(len(state), dtype=np.int64)
    target = np.zeros(len(state), dtype=np.int64)
    live = np.arange(len(state))
    while len(live):
        at[live] = target[live]
        state[live] = state[live] * _MULTIPLIER + np.uint64(1)
        jump = (at[live] + 1) * (float(1 << 31) / ((state[live] >> np.uint64(33)).astype(np.float64) + 1.0))
        target[live] = jump.astype(np.int64)
        live = live[target[live] < shards]
    return at.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """The shard column of a key of any type. A null key has one fixed shard."""

    @F.pandas_udf("int")
    def place(hashed: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(hashed.to_numpy(), shards))

    return place(F.xxhash64(key))


def assign_shards(rows: DataFrame, shards: int, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, size, text_crc32, law, shard, slot, grown_shard.

    size is the UTF-8 length of the text plus 8; a null text counts as empty, and
    its checksum is that of an empty text. slot numbers each shard's rows from 0
    without gaps. Equal keys have equal shards, and equal rows differ in slot only.
    A null key is one more key. grown_shard is the shard among shards + 1.

    Slots are dealt in two steps, so that no task holds a whole shard: each shard is
    cut into blocks by key hash, blocks are counted, and rows are numbered inside
    their block from the block's offset. The table of offsets has shards x blocks
    rows, and blocks is the session's number of shuffle partitions.
    """
    spark = rows.sparkSession
    blocks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    placed = rows.select(
        F.col(key),
        (F.octet_length(body).cast("long") + 8).alias("size"),
        F.crc32(body).alias("text_crc32"),
        shard_of(F.col(key), shards).alias("shard"),
        shard_of(F.col(key), shards + 1).alias("grown_shard"),
        F.pmod(F.xxhash64(F.lit("slot"), F.col(key)), F.lit(blocks)).cast("int").alias("_block"),
    )
    counts = placed.groupBy("shard", "_block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("shard", "_block").orderBy(F.col(key), "size", "text_crc32")
    numbered = placed.withColumn("_rank", F.row_number().over(inside) - 1)
    return numbered.join(F.broadcast(offsets), ["shard", "_block"]).select(
        key,
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("_offset") + F.col("_rank")).cast("long").alias("slot"),
        "grown_shard",
    )


def write_shards(rows: DataFrame, shards: int, path: str, *, key: str = "doc_id") -> None:
    """Write the rows as Parquet under ``path``/shard=<n>, with all their columns."""
    name = "shard"
    while name in rows.columns:
        name = f"_{name}"
    rows.withColumn(name, shard_of(F.col(key), shards)).write.partitionBy(name).parquet(path)
