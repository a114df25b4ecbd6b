"""Structured Streaming versions of the polling sensors.

Each function takes a streaming (or, for tests, any) DataFrame and returns one;
sinks and triggers are the caller's choice. State is kept per key in Spark's state
store, so a restart continues from the checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

UNIT_OUTPUT = "unit_key string, signature string, cycles int, scan_ts timestamp"
UNIT_STATE = "signature string, cycles int, announced string"


def stable_units(scans: DataFrame, cycles: int, min_age_sec: int, need_marker: bool = True) -> DataFrame:
    """A row when a folder unit becomes stable: same signature in ``cycles`` scans, old enough, marked as done.

    ``scans`` has unit_key, unit_type, signature, max_mtime (seconds), has_marker and
    scan_ts. A changed signature starts the count again; a signature is announced
    once. Files need no marker, directories do when ``need_marker``.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        signature, seen, announced = state.get if state.exists else ("", 0, "")
        out = []
        for row in pd.concat(list(frames)).sort_values("scan_ts").itertuples():
            seen = seen + 1 if row.signature == signature else 1
            signature = row.signature
            old = row.scan_ts.timestamp() - row.max_mtime >= min_age_sec
            marked = row.has_marker or row.unit_type != "directory" or not need_marker
            if seen >= cycles and old and marked and announced != signature:
                announced = signature
                out.append((key[0], signature, seen, row.scan_ts))
        state.update((signature, seen, announced))
        yield pd.DataFrame(out, columns=["unit_key", "signature", "cycles", "scan_ts"])

    return scans.groupBy("unit_key").applyInPandasWithState(step, UNIT_OUTPUT, UNIT_STATE, "append", GroupStateTimeout.NoTimeout)


def debounced(events: DataFrame, key: str, ts: str, quiet: str) -> DataFrame:
    """One row per burst of a key: its last moment and size, once ``quiet`` has passed without another event."""
    windowed = events.withWatermark(ts, quiet).groupBy(F.session_window(ts, quiet), key).agg(F.max(ts).alias("last"), F.count("*").alias("n"))
    return windowed.select(key, "last", "n")


def windowed_counts(events: DataFrame, ts: str, late: str, width: str, keys: list[str]) -> DataFrame:
    """Counts by time window and keys; rows later than ``late`` are left out."""
    counted = events.withWatermark(ts, late).groupBy(F.window(ts, width), *keys).agg(F.count("*").alias("n"))
    return counted.select(F.col("window.start").alias("start"), *keys, "n")


def first_of_key(events: DataFrame, key: list[str], ts: str, late: str) -> DataFrame:
    """The first event of each key inside the watermark; retries with the same key are dropped."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(key)


def tree_deltas(changes: DataFrame, path: str, kind: Column, size: Column) -> DataFrame:
    """(folder, files, bytes): created and deleted files added up over all their folders.

    Each change becomes one signed row for each ancestor, so the aggregation is a plain sum.
    """
    sign = F.when(kind == "create", 1).when(kind == "delete", -1).otherwise(0)
    parts = F.split(path, "/")
    folders = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    rows = changes.where(F.size(parts) > 1).select(F.explode(folders).alias("folder"), sign.alias("_s"), (sign * size).alias("_b"))
    return rows.groupBy("folder").agg(F.sum("_s").alias("files"), F.sum("_b").alias("bytes"))


def snapshot_changed(now: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Snapshots (key, n, latest) that differ from the last seen ones, or are new."""
    old = seen.select(key, F.col("n").alias("_n"), F.col("latest").alias("_l"))
    joined = now.join(old, key, "left")
    return joined.where(~F.col("n").eqNullSafe(F.col("_n")) | ~F.col("latest").eqNullSafe(F.col("_l"))).select(now.columns)
