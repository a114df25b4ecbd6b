"""State machines over rows: batch updates, pins, claims, registry moves, locks, unique keys.

Each takes the current rows and the requested changes and returns the rows after them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def batch_status(rows: DataFrame, wanted: DataFrame, *, key: str, to: str, skip: tuple[str, ...] = ("completed",)) -> DataFrame:
    """Rows with ``status`` set to ``to`` where the key is wanted, except those in a status of ``skip``; and whether each changed."""
    hit = wanted.select(key).distinct().withColumn("_hit", F.lit(True))
    changed = F.coalesce("_hit", F.lit(False)) & ~F.coalesce(F.col("status").isin(*skip), F.lit(False))
    return rows.join(hit, key, "left").withColumn("changed", changed).withColumn("status", F.when(F.col("changed"), to).otherwise(F.col("status"))).drop("_hit")


def claim(rows: DataFrame, *, flag: str, when: Column) -> DataFrame:
    """Compare and set: ``flag`` becomes true where it isn't and ``when`` holds; claimed says which rows this call won."""
    free = ~F.coalesce(F.col(flag), F.lit(False)) & when
    return rows.withColumn("claimed", free).withColumn(flag, F.coalesce(F.col(flag), F.lit(False)) | free)


def promote(registry: DataFrame, chosen: DataFrame, *, task: str, version: str) -> DataFrame:
    """New versions become promoted, and the ones promoted before archived; tasks without a choice stay."""
    picked = chosen.select(F.col(task), F.col(version).alias("_new"))
    joined = registry.join(picked, task, "left")
    state = F.when(F.col(version) == F.col("_new"), "promoted").when(F.col("_new").isNotNull() & (F.col("state") == "promoted"), "archived").otherwise(F.col("state"))
    return joined.withColumn("state", state).drop("_new")


def unique_keys(rows: DataFrame, *, key: str, order: list[str], existing: DataFrame | None = None) -> DataFrame:
    """``unique_key``: repeats of a key get _2, _3 ... in order, counted on from the ``existing`` rows of that key."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    if existing is not None:
        taken = existing.groupBy(key).agg(F.count("*").alias("_taken"))
        rows = rows.join(taken, key, "left")
        place = place + F.coalesce("_taken", F.lit(0))
    out = rows.withColumn("_k", place).withColumn("unique_key", F.when(F.col("_k") == 1, F.col(key)).otherwise(F.concat(F.col(key), F.lit("_"), F.col("_k").cast("string"))))
    return out.drop("_k", "_taken")


def lock_decision(rows: DataFrame, *, now: Column, ttl_seconds: int) -> DataFrame:
    """keep, release or free for each lock: an active one is released when its heartbeat is older than the limit and its owner doesn't run."""
    stale = (F.unix_micros(now) - F.unix_micros("heartbeat")) > ttl_seconds * 1_000_000
    return rows.withColumn("decision", F.when(~F.col("active"), "free").when(stale & ~F.col("owner_running"), "release").otherwise("keep"))


def rotating_budget(units: DataFrame, *, order: str, offset: int, budget: int, count: int) -> DataFrame:
    """The ``budget`` units from a cursor on, going round; ``count`` is the number of units."""
    place = F.row_number().over(Window.orderBy(order)) - 1
    return units.withColumn("place", F.pmod(place - F.lit(offset), F.lit(max(count, 1)))).where(F.col("place") < budget)


def even_places(n: Column, wanted: int) -> Column:
    """``wanted`` places from 0 to n - 1 with both ends, evenly spaced, strictly increasing; all of them if there are no more."""
    step = lambda i: F.floor(i * (n - 1) / F.lit(wanted - 1) + F.lit(0.5)).cast("long")
    every = F.sequence(F.lit(0).cast("long"), n.cast("long") - 1)
    return F.when(n <= 0, F.array().cast("array<long>")).when(n <= wanted, every).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(0).cast("long"), F.lit(wanted - 1).cast("long")), step)))
