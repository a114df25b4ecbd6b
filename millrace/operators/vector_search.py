"""Exact vector search: top-k, range counts and fusion of ranked lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.vectors import cosine


def with_query(frames: DataFrame, query: DataFrame, vector: str, query_vector: str) -> DataFrame:
    """Attach the single query row's vector to every frame.

    ``query`` must hold exactly one row (a lookup by key), so the broadcast has
    a fixed size that does not depend on the corpus.
    """
    one = query.select(F.col(query_vector).alias("_query")).limit(1)
    return frames.crossJoin(F.broadcast(one)).withColumn("cos", cosine(F.col(vector), F.col("_query"))).drop("_query")


def top_k(scored: DataFrame, k: int, key: str, score: str = "cos") -> DataFrame:
    """The k best rows by (score desc, key asc); runs as TakeOrderedAndProject."""
    return scored.orderBy(F.col(score).desc_nulls_last(), F.col(key).asc_nulls_last()).limit(k)


def ranked(scored: DataFrame, k: int, key: str, score: str, rank: str) -> DataFrame:
    """The k best rows with a 1-based rank; the window only sees k rows."""
    best = top_k(scored, k, key, score)
    order = Window.orderBy(F.col(score).desc_nulls_last(), F.col(key).asc_nulls_last())
    return best.withColumn(rank, F.row_number().over(order).cast("long"))


def rrf(rank: Column, k: int = 60) -> Column:
    """Reciprocal rank contribution; a missing rank adds nothing."""
    return F.coalesce(F.lit(1.0) / (F.lit(float(k)) + rank), F.lit(0.0))


def blocked_pairs(left: DataFrame, right: DataFrame, min_cos: float, rows: int = 4096) -> DataFrame:
    """Pairs (a, b) of ids whose cosine is above ``min_cos``, by blocks of ``left``.

    ``left`` and ``right`` have id and vec. Each block is a matrix of at most ``rows``
    vectors, whose size is thereby bounded; every task multiplies it with its own rows.
    """
    import numpy as np
    import pyarrow as pa

    blocks: list[tuple[list, object]] = []
    ids, vectors = [], []

    def close() -> None:
        matrix = np.array(vectors, dtype=np.float64)
        matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-300)
        blocks.append((list(ids), matrix))
        ids.clear()
        vectors.clear()

    out = None
    for row in left.select("id", "vec").toLocalIterator():
        ids.append(row.id)
        vectors.append(row.vec)
        if len(ids) == rows:
            close()
    if ids:
        close()
    kind = right.schema["id"].dataType.simpleString()
    for block in blocks:
        shared = right.sparkSession.sparkContext.broadcast(block)

        def multiply(batches, shared=shared):
            own, matrix = shared.value
            for batch in batches:
                values = batch.column(1)
                x = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
                x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
                i, j = np.nonzero(matrix @ x.T > min_cos)
                yield pa.RecordBatch.from_arrays([pa.array([own[k] for k in i.tolist()], batch.column(0).type), batch.column(0).take(pa.array(j))], names=["a", "b"])

        part = right.select("id", "vec").mapInArrow(multiply, f"a {kind}, b {kind}")
        out = part if out is None else out.unionAll(part)
    if out is None:
        return right.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)
    return out
