"""Connected components of links, by alternating large-star and small-star steps.

(Kiveris et al., 2014.) Each round is joins and aggregations whose output is
written to the shared folder. Once FEW edges or less remain, one task joins them;
more are never gathered in one task, and none on the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import new_folder, remove, result

#: Edges, of 16 bytes, that one task may join.
FEW = 50_000


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour to the least of a node and its neighbours."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them; edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b")))


def _joined(batches):
    """(node, component) of all edges in one pass of union-find, each set named by its least node."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while (up := parent[x]) != top:
            parent[x], x = top, up
        return top

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    nodes = np.fromiter(parent, np.int64, len(parent))
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array([root(x) for x in nodes.tolist()], pa.int64())], names=["node", "component"])


def components(links: DataFrame, few: int = FEW) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); component is the least node reachable.

    Self links, repeated links and both directions of a link are allowed; no links give no rows.
    """
    spark = links.sparkSession

    def make() -> DataFrame:
        ordered = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        edges, path, before = ordered, None, None
        while True:
            fresh = new_folder(spark, "links")
            edges.write.parquet(fresh)
            if path:
                remove(spark, path)
            path = fresh
            edges = spark.read.schema("a long, b long").parquet(path)
            now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")).first()
            if now["n"] <= few:
                return edges.coalesce(1).mapInArrow(_joined, "node long, component long")
            if now == before:
                return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
            before = now
            edges = _small_star(_large_star(edges).distinct()).distinct()

    return result(spark, "components", make)
