"""Resampled intervals, class separation and queues of rows worth labelling."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.vectors import dot, norm, unit


def bootstrap_interval(outcomes: DataFrame, group: str, hit: str, *, iterations: int = 1000, alpha: float = 0.05, seed: int = 0) -> DataFrame:
    """(group, n, mean, low, high): the percentile bootstrap of the mean of a boolean; nulls count as misses.

    A resample of n outcomes of which k are hits has Binomial(n, k / n) hits, so only
    counts leave the aggregation and a group of any size is one row. The draws have the
    distribution of resampled rows, not the same numbers.
    """

    @F.pandas_udf("struct<low:double,high:double>")
    def interval(n: pd.Series, k: pd.Series) -> pd.DataFrame:
        ends = []
        for size, hits in zip(n, k, strict=True):
            means = np.random.default_rng([seed, int(size), int(hits)]).binomial(size, hits / size, iterations) / size
            ends.append(np.round(np.percentile(means, [50 * alpha, 100 - 50 * alpha]), 6))
        return pd.DataFrame(ends, columns=["low", "high"])

    counts = outcomes.groupBy(group).agg(F.count("*").alias("n"), F.count_if(F.coalesce(F.col(hit), F.lit(False))).alias("_k"))
    return counts.withColumn("_i", interval("n", "_k")).select(group, "n", F.round(F.col("_k") / F.col("n"), 6).alias("mean"), "_i.low", "_i.high")


def silhouettes(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(key, label, silhouette) by cosine distance, exact and without pairs of rows.

    The mean cosine of a unit vector to a class is its product with the class's sum of unit
    vectors over the count, so each row meets classes, not rows. A class of one row gives 0;
    with one class, or a null vector or label or a vector of length 0, there is no row.
    """
    rows = vectors.select(key, label, F.when(norm(F.col(vector)) > 0, unit(F.col(vector))).alias("_u"))
    rows = rows.where(F.col(label).isNotNull() & F.coalesce(~F.exists("_u", lambda x: x.isNull() | F.isnan(x)), F.lit(False)))
    sums = rows.select(label, F.posexplode("_u").alias("_d", "_x")).groupBy(label, "_d").agg(F.sum("_x").alias("_s"), F.count("*").alias("_n"))
    classes = sums.groupBy(F.col(label).alias("_class")).agg(F.transform(F.array_sort(F.collect_list(F.struct("_d", "_s"))), lambda e: e["_s"]).alias("_sum"), F.max("_n").alias("_n"))
    # one row for each class: the number of labels, not of vectors
    met = rows.join(classes)
    own, cosines = F.col("_class") == F.col(label), dot(F.col("_u"), F.col("_sum"))
    inner = F.when(own & (F.col("_n") > 1), (F.col("_n") - cosines) / (F.col("_n") - 1))
    outer = F.when(~own, 1 - cosines / F.col("_n"))
    found = met.groupBy(key, label).agg(F.max(inner).alias("_a"), F.min(outer).alias("_b")).where("_b IS NOT NULL")
    # a class of one row has no inner distance
    score = F.try_divide(F.col("_b") - F.col("_a"), F.greatest("_a", "_b"))
    return found.select(key, label, F.coalesce(F.when(F.col("_a").isNotNull(), score), F.lit(0.0)).alias("silhouette"))


def label_queue(pool: DataFrame, key: str, *, n: int, near: float = 0.7, floor: float = 0.2, weights: tuple[float, float, float] = (0.45, 0.30, 0.25)) -> DataFrame:
    """The ``n`` rows to label next, with ``al`` and ``place``, of a pool with rare, rep and uniq within 0 to 1 (null: 0).

    al is the weighted sum. Rows rarer than ``near`` lie near the rare classes; at least the
    share ``floor`` of the queue comes from the others while there are any, the rest
    goes by al. Equal scores go by key. Only the best n of each kind are ranked against each other.
    """
    scores = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in ("rare", "rep", "uniq")]
    al = scores[0] * weights[0] + scores[1] * weights[1] + scores[2] * weights[2]
    scored = pool.withColumns({"al": F.round(al, 6), "near": scores[0] > near})
    order = [F.desc("al"), key]
    best = scored.where("near").orderBy(*order).limit(n).unionByName(scored.where("NOT near").orderBy(*order).limit(n))
    kept = -int(-(n * floor) // 1)
    first = ~F.col("near") & (F.row_number().over(Window.partitionBy("near").orderBy(*order)) <= kept)
    chosen = best.withColumn("_first", first).orderBy(F.desc("_first"), *order).limit(n)
    return chosen.withColumn("place", F.row_number().over(Window.orderBy(*order)).cast("long")).drop("_first")
