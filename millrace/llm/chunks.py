"""Documents dealt into chunks of about equal size, by ranges of ids or by a hash.

A chunk is small enough for one task's memory and is a function of the row alone,
so it is the same whenever it is computed again. Operators that look at all of a
corpus exchange packed arrays between chunks and hash buckets, a row for each pair
of both, instead of a row for each hash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import release

CHUNK_BYTES = 4 << 20
#: Bytes of hashes that one bucket receives, about.
BUCKET_BYTES = 32 << 20
#: Ranges of ids whose bounds the driver asks for, at most; a range is cut into even steps of the id.
RANGES = 10_000


@dataclass
class Chunked:
    #: id long (null ids come after all others), text string (null as empty), chunk int
    rows: DataFrame
    chunks: int
    buckets: int


def chunked(docs: DataFrame, doc_id: str, text: str, hash_bytes_per_byte: float, chunk_bytes: int = CHUNK_BYTES, ordered: bool = True) -> Chunked:
    """Deal rows by ranges of an integer id, or else by a hash of id and text.

    ``hash_bytes_per_byte`` of the text go to the buckets. A hash deals repeated ids and
    copies evenly; ranges are for operators that need a chunk's ids to follow the last one's.
    """
    spark = docs.sparkSession
    if not docs.schema[doc_id].dataType.typeName() in ("byte", "short", "integer", "long"):
        raise TypeError(f"{doc_id} must be an integer column")
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = rows.agg(F.sum(F.octet_length("text")).alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi")).first()
    size = known["n"] or 0
    chunks = max(1, partitions if size >= partitions << 16 else 1, -(-size // chunk_bytes))
    buckets = max(2 * partitions, int(size * hash_bytes_per_byte) // BUCKET_BYTES)
    if chunks == 1 or known["lo"] is None:
        return Chunked(rows.withColumn("chunk", F.lit(0)), 1, buckets)
    if not ordered:
        return Chunked(rows.withColumn("chunk", F.pmod(F.xxhash64("id", "text"), F.lit(chunks)).cast("int")), chunks, buckets)
    ranges = min(chunks, RANGES)
    steps = -(-chunks // ranges)
    # the driver keeps one bound for each range
    bounds = rows.agg(F.percentile_approx("id", [i / ranges for i in range(1, ranges)], max(10_000, 20 * ranges)).alias("b")).first()["b"] if ranges > 1 else []
    shared = spark.sparkContext.broadcast(np.array([known["lo"], *bounds, known["hi"]], dtype=np.int64))

    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:
        return pd.Series(place_of(ids.to_numpy(), shared.value, steps))

    last = F.lit(ranges * steps - 1)
    return Chunked(rows.withColumn("chunk", F.when(F.col("id").isNull(), last).otherwise(place(F.coalesce("id", F.lit(known["hi"]))))), ranges * steps, buckets)


def place_of(ids: np.ndarray, bounds: np.ndarray, steps: int) -> np.ndarray:
    """Chunk of each id: its range among ``bounds``, and its even step inside that; never falls as ids grow."""
    found = np.searchsorted(bounds[1:-1], ids, side="left")
    lo, hi = bounds[found].astype(np.float64), bounds[found + 1].astype(np.float64)
    share = (ids.astype(np.float64) - lo) / np.maximum(hi - lo, 1.0)
    return (found * steps + np.clip((share * steps).astype(np.int64), 0, steps - 1)).astype(np.int32)


def rank_of(table: pa.Table) -> np.ndarray:
    """Rank of each row's id in a table ``in_order``; equal ids have equal ranks, and null ids the last."""
    ids = table.column("id")
    if not len(ids):
        return np.zeros(0, np.int64)
    none, known = np.asarray(ids.is_null()), ids.fill_null(0).to_numpy()
    return np.cumsum(np.concatenate(([0], (known[1:] != known[:-1]) | (none[1:] != none[:-1]))))


def in_order(table: pa.Table) -> pa.Table:
    """A chunk's rows by id, then text, so that every pass sees one order."""
    return table.sort_by([("id", "ascending"), ("text", "ascending")])


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each 64-bit hash; ascending keys have ascending buckets."""
    return ((keys >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal neighbours."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edges = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    return np.concatenate(([0], edges)), np.concatenate((edges, [len(keys)]))


def unpack(column: pa.ChunkedArray, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All values of a column of packed arrays, and each row's number of values."""
    parts = [np.frombuffer(v.as_buffer(), dtype=dtype) if v.is_valid else np.zeros(0, dtype) for chunk in column.chunks for v in chunk]
    return (np.concatenate(parts) if parts else np.zeros(0, dtype)), np.array([len(p) for p in parts], dtype=np.int64)


def key_counts(rows: DataFrame, keys_of, buckets: int) -> DataFrame:
    """In how many rows each chunk's 64-bit keys are: (chunk, bucket, counts), for ``counts_of``.

    ``keys_of(table)`` gives the row and the key of each entry, a key at most once
    in a row. A chunk sends each of its keys once, with its own number of rows; a
    bucket adds these up and answers each chunk, unless all counts are 1. Counts end
    at 65535. The low 32 bits and the bucket stand for a key, so a count may be too
    high, but never too low, and equal keys have equal counts everywhere.
    """

    def send(table: pa.Table) -> pa.Table:
        release()
        _, keys = keys_of(table)
        found, counts = np.unique(keys, return_counts=True)
        bucket = bucket_of(found, buckets)
        first, last = runs(bucket)
        low, own = found.astype(np.uint32), np.minimum(counts, 65535).astype(np.uint16)
        return pa.table(
            {
                "bucket": pa.array(bucket[first], pa.int32()),
                "chunk": pa.array(np.full(len(first), table.column("chunk")[0].as_py()), pa.int32()),
                "keys": pa.array([low[a:b].tobytes() for a, b in zip(first, last, strict=True)], pa.binary()),
                "own": pa.array([own[a:b].tobytes() for a, b in zip(first, last, strict=True)], pa.binary()),
            }
        )

    def add(table: pa.Table) -> pa.Table:
        release()
        keys, sizes = unpack(table.column("keys"), np.uint32)
        own, _ = unpack(table.column("own"), np.uint16)
        order = np.argsort(keys, kind="stable")
        start, end = runs(keys[order])
        counts = np.empty(len(keys), dtype=np.uint16)
        counts[order] = np.repeat(np.minimum(np.add.reduceat(own[order].astype(np.int64), start), 65535).astype(np.uint16), end - start)
        ends = np.cumsum(sizes)
        parts = [counts[e - n : e] for e, n in zip(ends, sizes, strict=True)]
        said = [i for i, p in enumerate(parts) if (p > 1).any()]
        take = pa.array(said, pa.int64())
        return pa.table({"chunk": table.column("chunk").take(take).cast(pa.int32()), "bucket": table.column("bucket").take(take).cast(pa.int32()), "counts": pa.array([parts[i].tobytes() for i in said], pa.binary())})

    sent = rows.groupBy("chunk").applyInArrow(send, "bucket int, chunk int, keys binary, own binary")
    return sent.groupBy("bucket").applyInArrow(add, "chunk int, bucket int, counts binary")


def counts_of(keys: np.ndarray, said: pa.Table, buckets: int) -> np.ndarray:
    """The count of each key of a chunk's ``keys_of``, from the chunk's rows of ``key_counts``."""
    found, inverse = np.unique(keys, return_inverse=True)
    bucket = bucket_of(found, buckets)
    counts = np.ones(len(found), dtype=np.uint16)
    for b, packed in zip(said.column("bucket").to_pylist(), said.column("counts").to_pylist(), strict=True):
        lo, hi = np.searchsorted(bucket, [b, b + 1])
        counts[lo:hi] = np.frombuffer(packed, dtype=np.uint16)
    return counts[inverse]
