"""Prompt banks: sentences with a class, scored against frames by cosine.

Frames and sentences meet in blocked matrix products inside Arrow batches. Blocks
of sentences have a bounded size and are broadcast one at a time; only the best k
sentences of each frame (or class) leave a task, never the full matrix.
Ties are broken by the smaller sentence index throughout.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sentences of one broadcast block; at 1024 dimensions a block has 32 MB.
BLOCK_ROWS = 4096


def _blocks(bank: DataFrame, rows: int):
    gidx, cls, vec = [], [], []
    for r in bank.select("gidx", "cls", "vec").toLocalIterator():
        gidx.append(r.gidx)
        cls.append(r.cls)
        vec.append(r.vec)
        if len(gidx) == rows:
            yield np.array(gidx), np.array(cls), np.array(vec, dtype=np.float64)
            gidx, cls, vec = [], [], []
    if gidx:
        yield np.array(gidx), np.array(cls), np.array(vec, dtype=np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def best_sentences(frames: DataFrame, bank: DataFrame, k: int, per_class: bool = False, key: str = "vec_id") -> DataFrame:
    """(key, gt, grp, gidx, cls, cos, rank): the k best sentences of each frame, or of each frame and class."""
    kind = frames.schema[key].dataType.simpleString()
    parts = []
    for gidx, cls, vec in _blocks(bank, BLOCK_ROWS):
        order = np.argsort(gidx, kind="stable")
        shared = frames.sparkSession.sparkContext.broadcast((gidx[order], cls[order], _unit(vec[order])))

        def score(batches, shared=shared):
            gidx, cls, matrix = shared.value
            groups = [np.flatnonzero(cls == c) for c in np.unique(cls)] if per_class else [np.arange(len(gidx))]
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = _unit(batch.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1))
                cos = x @ matrix.T
                rows, picked = [], []
                for g in groups:
                    # a stable sort on -cos keeps the smaller index first among equals
                    top = np.argsort(-cos[:, g], axis=1, kind="stable")[:, :k]
                    rows.append(np.repeat(np.arange(batch.num_rows), top.shape[1]))
                    picked.append(g[top].ravel())
                rows, picked = np.concatenate(rows), np.concatenate(picked)
                kept = [batch.column(c).take(pa.array(rows)) for c in range(3)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(gidx[picked], pa.int64()), pa.array(cls[picked], pa.int32()), pa.array(cos[rows, picked])], names=[key, "gt", "grp", "gidx", "cls", "cos"])

        parts.append(frames.select(key, "gt", "grp", "vec").mapInArrow(score, f"{key} {kind}, gt int, grp long, gidx long, cls int, cos double"))
    if not parts:
        return frames.select(key, "gt", "grp").limit(0).selectExpr("*", "0L AS gidx", "0 AS cls", "0D AS cos", "0L AS rank")
    keys = [key, "cls"] if per_class else [key]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("cos"), "gidx")).cast("long")
    return reduce(DataFrame.unionAll, parts).withColumn("rank", rank).where(F.col("rank") <= k)


def predictions(best: DataFrame, key: str = "vec_id") -> DataFrame:
    """(key, gt, grp, pred, gidx, cos): each frame's best sentence decides."""
    return best.where("rank = 1").select(key, "gt", "grp", F.col("cls").alias("pred"), "gidx", "cos")


def majority_vote(best: DataFrame, k: int, key: str = "vec_id") -> DataFrame:
    """(key, gt, pred, votes, margin): most votes among the k best; ties by the class's best cosine, then the lower class."""
    votes = best.where(F.col("rank") <= k).groupBy(key, "gt", "cls").agg(F.count("*").alias("votes"), F.max("cos").alias("top"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("v"), (-F.col("top")).alias("t"), "cls")))
    ranked = votes.groupBy(key, "gt").agg(ordered.alias("o"))
    second = F.coalesce(-F.try_element_at("o", F.lit(2))["v"], F.lit(0))
    first = -F.element_at("o", 1)["v"]
    return ranked.select(key, "gt", F.element_at("o", 1)["cls"].alias("pred"), first.alias("votes"), ((first - second) / k).alias("margin"))


def class_report(predicted: DataFrame) -> DataFrame:
    """(cls, tp, fp, fn) over the classes of truth and prediction."""
    truth = predicted.groupBy(F.col("gt").alias("cls")).agg(F.count_if(F.col("gt") == F.col("pred")).alias("tp"), F.count_if(F.col("gt") != F.col("pred")).alias("fn"))
    said = predicted.groupBy(F.col("pred").alias("cls")).agg(F.count_if(F.col("gt") != F.col("pred")).alias("fp"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return truth.join(said, "cls", "full_outer").select("cls", zero("tp"), zero("fp"), zero("fn"))


def reach(best_by_class: DataFrame, key: str = "vec_id") -> DataFrame:
    """(gidx, reach): per sentence the largest lead over the best other class, among the frames where it leads its class."""
    lead = best_by_class.where("rank = 1").withColumn("_o", F.max(F.struct("cos", F.col("cls").alias("c"))).over(Window.partitionBy(key)))
    # the best other class: the best of all, or for the winner the runner-up
    second = F.element_at(F.sort_array(F.collect_list("cos").over(Window.partitionBy(key)), False), 2)
    other = F.when(F.col("_o.c") == F.col("cls"), second).otherwise(F.col("_o.cos"))
    return lead.withColumn("lead", F.col("cos") - other).groupBy("gidx").agg(F.max("lead").alias("reach"))


def loo_gains(best: DataFrame, key: str = "vec_id") -> DataFrame:
    """(gidx, wins, gain): change in correct frames when a sentence is left out.

    Only frames won by the sentence change; their second best sentence then decides.
    """
    first = best.where("rank = 1").select(key, "gt", "gidx", F.col("cls").alias("c1"))
    second = best.where("rank = 2").select(key, F.col("cls").alias("c2"))
    right = lambda c: F.coalesce((F.col(c) == F.col("gt")).cast("long"), F.lit(0))
    return first.join(second, key, "left").groupBy("gidx").agg(F.count("*").alias("wins"), F.sum(right("c2") - right("c1")).alias("gain"))


def prune(frames: DataFrame, bank: DataFrame, rounds: int = 20) -> list[tuple[int, int, int]]:
    """Greedy batch pruning: each round drops all sentences whose loss gains frames, while accuracy rises.

    Returns (round, sentences, correct) of each state; the loop holds counts and the
    set of dropped sentence indices, which the bank bounds.
    """
    dropped: set[int] = set()
    curve = []
    total = bank.count()
    for r in range(rounds):
        left = bank.where(~F.col("gidx").isin(*dropped)) if dropped else bank
        best = best_sentences(frames, left, 2).persist()
        correct = predictions(best).where("gt = pred").count()
        if curve and correct <= curve[-1][2]:
            best.unpersist()
            break
        curve.append((r, total - len(dropped), correct))
        harmful = [x.gidx for x in loo_gains(best).where("gain > 0").toLocalIterator()]
        best.unpersist()
        if not harmful:
            break
        dropped.update(harmful)
    return curve


def deletion_score(best: DataFrame, normal: Column) -> DataFrame:
    """(gidx, score): false wins on one side over its frames minus right wins on the other over theirs.

    For sentences of abnormal classes FP / normal frames - TP / abnormal frames; mirrored for normal ones.
    """
    won = best.where("rank = 1").withColumn("_gn", normal & True)
    totals = won.agg(F.count_if(F.col("gt") == 0).alias("nn"), F.count_if(F.col("gt") != 0).alias("na"))
    counted = won.groupBy("gidx", "cls").agg(F.count_if(F.col("gt") == 0).alias("on_normal"), F.count_if(F.col("gt") != 0).alias("on_abnormal"))
    rate = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    score = F.when(F.col("cls") != 0, rate("on_normal", "nn") - rate("on_abnormal", "na")).otherwise(rate("on_abnormal", "na") - rate("on_normal", "nn"))
    return counted.crossJoin(F.broadcast(totals)).select("gidx", "cls", score.alias("score"))
