"""Events as intervals in media time: joins, merging, clip and frame planning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EVENT = "struct<start:double,end:double,category:string,caption:string,count:int>"


def overlapping(left: DataFrame, right: DataFrame, key: str, left_ends: tuple[str, str], right_ends: tuple[str, str], width: float) -> DataFrame:
    """Pairs of one key whose open intervals overlap.

    Both sides are dealt to time bins of ``width``; a pair is made in the bin of the
    later start alone, so the join is an equi-join on key and bin without repeats.
    """
    bins = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / width), F.floor(F.col(b) / width)))
    l = left.where(F.col(left_ends[1]) >= F.col(left_ends[0])).withColumn("_bin", bins(*left_ends))
    r = right.where(F.col(right_ends[1]) >= F.col(right_ends[0])).withColumn("_bin", bins(*right_ends))
    (ls, le), (rs, re) = left_ends, right_ends
    meets = (F.col(le) > F.col(rs)) & (F.col(ls) < F.col(re)) & (F.col("_bin") == F.floor(F.greatest(ls, rs) / width))
    return l.join(r, [key, "_bin"]).where(meets).drop("_bin")


def latest_before(stream: DataFrame, key: str, order: Sequence[str], source: Column, value: Column, name: str) -> DataFrame:
    """Add the value of the last source row of the key at or before each row (as-of).

    Rows of equal order are peers, so a source row at the same moment counts.
    """
    window = Window.partitionBy(key).orderBy(*order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return stream.withColumn(name, F.last(F.when(source, value), ignorenulls=True).over(window))


def plan_chunks(duration: Column, window: int = 660, stride: int = 600) -> Column:
    """Array of (index from 1, start, end) windows; none without a positive duration.

    Windows stop with the first that reaches the end.
    """
    last = F.greatest(F.ceil((duration - window) / stride), F.lit(0)).cast("int")
    make = lambda i: F.struct((i + 1).alias("idx"), F.round((i * stride).cast("double"), 3).alias("start"), F.round(F.least(i * stride + window, duration), 3).alias("end"))
    return F.when(duration > 0, F.transform(F.sequence(F.lit(0), last), make)).otherwise(F.array().cast("array<struct<idx:int,start:double,end:double>>"))


def valid_events(events: Column) -> Column:
    """Events with 0 <= start < end, by start, then end."""
    kept = F.filter(events, lambda e: e["start"].isNotNull() & e["end"].isNotNull() & (e["start"] >= 0) & (e["end"] > e["start"]))
    order = lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).when(a["end"] < b["end"], -1).when(a["end"] > b["end"], 1).otherwise(0)
    return F.array_sort(kept, order)


def within_duration(events: Column, duration: Column) -> Column:
    """Events that end by the duration; an unknown or non-positive duration lets all pass."""
    return F.when(duration.isNull() | (duration <= 0), events).otherwise(F.filter(events, lambda e: e["end"] <= duration))


def offset_events(events: Column, offset: Column, limit: Column) -> Column:
    """Events moved by an offset and cut to [offset, limit]; empty ones are dropped."""
    moved = F.transform(events, lambda e: e.withField("start", F.least(F.greatest(e["start"] + offset, offset), limit)).withField("end", F.least(F.greatest(e["end"] + offset, offset), limit)))
    return valid_events(moved)


def merge_events(events: Column) -> Column:
    """Fold sorted events: one that meets the last merged event of the same category extends it.

    Only the last merged event is compared; another category in between breaks the run.
    The longer caption stays.
    """
    first = F.array().cast(f"array<{EVENT}>")

    def step(merged, e):
        last = F.element_at(merged, -1)
        same = (F.size(merged) > 0) & (F.coalesce(F.lower(e["category"]), F.lit("")) != "") & (F.lower(F.try_element_at(merged, F.lit(-1))["category"]) == F.lower(e["category"])) & (e["start"] <= F.try_element_at(merged, F.lit(-1))["end"])
        longer = F.when(F.length(F.coalesce(e["caption"], F.lit(""))) > F.length(F.coalesce(last["caption"], F.lit(""))), e["caption"]).otherwise(last["caption"])
        joined = last.withField("end", F.greatest(last["end"], e["end"])).withField("caption", longer).withField("count", last["count"] + 1)
        grown = F.concat(F.slice(merged, F.lit(1), F.size(merged) - 1), F.array(joined))
        return F.when(F.coalesce(same, F.lit(False)), grown).otherwise(F.concat(merged, F.array(e))).cast(f"array<{EVENT}>")

    return F.aggregate(events, first, step)


def clip_window(start: Column, end: Column, duration: Column, buffer: float = 5.0) -> tuple[Column, Column]:
    """An event's clip: the event and a buffer on either side, inside the media."""
    known = F.when(duration > 0, duration)
    return F.greatest(start - buffer, F.lit(0.0)), F.least(end + buffer, F.coalesce(known, end + buffer))


def frame_count(duration: Column, fps: Column, most: int) -> Column:
    """Frames to take: a ladder by duration, at most one for each source frame, 1 to ``most``."""
    wanted = F.when(duration < 2, 1).when(duration < 10, 3).when(duration < 60, 6).when(duration < 300, 12).otherwise(24)
    source = F.greatest(F.floor(duration * fps), F.lit(1))
    return F.greatest(F.least(wanted, source, F.lit(most)), F.lit(1)).cast("int")


def interval_timestamps(duration: Column, interval: float) -> Column:
    """0, interval, 2 * interval ... below the duration; just 0 without one."""
    steps = F.greatest(F.ceil(duration / interval).cast("int") - 1, F.lit(0))
    every = F.transform(F.sequence(F.lit(0), steps), lambda i: F.round(i * interval, 3))
    return F.when(duration > 0, every).otherwise(F.array(F.lit(0.0)))


def even_timestamps(duration: Column, n: Column) -> Column:
    """n moments spread over the middle (10 to 90 %, 20 to 80 % below 2 s), distinct to the millisecond."""
    low = F.when(duration < 2, 0.2).otherwise(0.1)
    step = F.when(n > 1, (1 - 2 * low) / (n - 1)).otherwise(0.0)
    base = F.when(n > 1, low).otherwise(0.5)
    return F.when(duration > 0, F.array_distinct(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.round(duration * (base + step * i), 3)))).otherwise(F.array(F.lit(0.0)))


def index_window(center: Column, interval: int, stride: int, size: Column) -> Column:
    """Indices center - interval .. center + interval in steps of stride, inside 0 .. size - 1."""
    return F.filter(F.sequence(center - interval, center + interval, F.lit(stride)), lambda i: (i >= 0) & (i < size))


def debounced(frame: DataFrame, key: str, order: Sequence[str], signal: Column, n: int, threshold: int, name: str) -> DataFrame:
    """Alarm when at least ``threshold`` of the key's last n signals are on; missing ones are off."""
    window = Window.partitionBy(key).orderBy(*order).rowsBetween(-(n - 1), Window.currentRow)
    return frame.withColumn(name, F.sum(signal.cast("int")).over(window) >= threshold)


def filled(frame: DataFrame, key: str, order: Sequence[str], value: str, limit: int) -> DataFrame:
    """Fill gaps from up to ``limit`` rows before, then from up to ``limit`` rows after."""
    window = Window.partitionBy(key).orderBy(*order)
    back = F.last(value, ignorenulls=True).over(window.rowsBetween(-limit, 0))
    ahead = F.first(value, ignorenulls=True).over(window.rowsBetween(0, limit))
    return frame.withColumn(value, F.coalesce(back, ahead))
