"""Media-time events: planning, merging, clipping and debouncing."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.operators import intervals as I
from millrace.plans import fixtures as X
from millrace.sources.tables import table

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


@query(
    "e1_chunk_plan",
    """WITH v AS (SELECT doc_id, n_chars::DOUBLE AS dur FROM documents)
    SELECT doc_id, (i + 1)::INT AS idx, round((i * 600)::DOUBLE, 3) AS start, round(least(i * 600 + 660, dur), 3) AS stop
    FROM v, range(0, 1000) t(i) WHERE dur > 0 AND i <= greatest(ceil((dur - 660) / 600), 0)""",
)
def chunk_plan(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.explode(I.plan_chunks(F.col("n_chars").cast("double"))).alias("c"))
    return docs.select("doc_id", "c.idx", "c.start", F.col("c.end").alias("stop"))


def _events(spark, d):
    """Each asset's events as one array, by start; built from a day's events, so arrays stay small."""
    spans = X.event_spans(spark, d).withColumn("day", F.floor(F.col("start_sec") / 86400).cast("int"))
    event = F.struct(F.col("start_sec").alias("start"), F.col("end_sec").alias("end"), "category", F.concat("category", F.col("event_id").cast("string")).alias("caption"), F.lit(1).alias("count"))
    return spans.groupBy("asset_id", "day").agg(F.collect_list(event).alias("events"))


@query(
    "e2_normalised_events",
    f"""WITH {X.EVENT_SPANS} SELECT asset_id, floor(start_sec / 86400)::INT AS day, string_agg(category || ':' || printf('%.3f', end_sec - start_sec), ',' ORDER BY start_sec, end_sec) AS events
    FROM spans WHERE start_sec >= 0 AND end_sec > start_sec GROUP BY 1, 2""",
)
def normalised_events(spark, d):
    valid = _events(spark, d).withColumn("events", I.valid_events(F.col("events"))).where(F.size("events") > 0)
    text = F.transform(F.filter("events", lambda e: e["category"].isNotNull()), lambda e: F.concat(e["category"], F.lit(":"), S.thousandths(e["end"] - e["start"])))
    return valid.select("asset_id", "day", F.when(F.size(text) > 0, F.array_join(text, ",")).alias("events"))


@query(
    "e3_duration_filter",
    f"""WITH {X.EVENT_SPANS} SELECT asset_id, floor(start_sec / 86400)::INT AS day, count(*) FILTER (end_sec <= 1296000)::INT AS kept, count(*) FILTER (end_sec > 1296000)::INT AS dropped FROM spans GROUP BY 1, 2""",
)
def duration_filter(spark, d):
    kept = F.size(I.within_duration(F.col("events"), F.lit(1296000.0)))
    return _events(spark, d).select("asset_id", "day", kept.alias("kept"), (F.size("events") - kept).alias("dropped"))


@query(
    "e4_offset_events",
    f"""WITH {X.EVENT_SPANS}, m AS (SELECT asset_id, floor(start_sec / 86400)::INT AS day, least(greatest(start_sec + 100, 100), 1296000) AS s, least(greatest(end_sec + 100, 100), 1296000) AS e FROM spans)
    SELECT asset_id, day, count(*) FILTER (e > s)::INT AS n, round(coalesce(sum(e - s) FILTER (e > s), 0), 3) AS seconds FROM m GROUP BY 1, 2""",
)
def offset_events(spark, d):
    moved = I.offset_events(F.col("events"), F.lit(100.0), F.lit(1296000.0))
    total = F.aggregate(moved, F.lit(0.0), lambda t, e: t + e["end"] - e["start"])
    return _events(spark, d).select("asset_id", "day", F.size(moved).alias("n"), F.round(total, 3).alias("seconds"))


@query(
    "e5_merged_events",
    f"""WITH RECURSIVE {X.EVENT_SPANS}, o AS (
        SELECT asset_id, floor(start_sec / 86400)::INT AS day, category, start_sec AS s, end_sec AS e, row_number() OVER (PARTITION BY asset_id, floor(start_sec / 86400) ORDER BY start_sec, end_sec) AS k
        FROM spans WHERE end_sec > start_sec),
    f AS (
        SELECT asset_id, day, k, category, e AS reach, 1 AS grp FROM o WHERE k = 1
        UNION ALL
        SELECT o.asset_id, o.day, o.k, o.category, CASE WHEN lower(o.category) = lower(f.category) AND o.s <= f.reach THEN greatest(f.reach, o.e) ELSE o.e END,
            CASE WHEN lower(o.category) = lower(f.category) AND o.s <= f.reach THEN f.grp ELSE f.grp + 1 END
        FROM f JOIN o ON o.asset_id = f.asset_id AND o.day = f.day AND o.k = f.k + 1)
    SELECT asset_id, day, max(grp)::INT AS merged, count(*)::INT AS events FROM f GROUP BY 1, 2""",
)
def merged_events(spark, d):
    merged = I.merge_events(I.valid_events(F.col("events")).cast(f"array<{I.EVENT}>"))
    counted = F.aggregate(merged, F.lit(0), lambda t, e: t + e["count"])
    return _events(spark, d).select("asset_id", "day", F.size(merged).alias("merged"), counted.alias("events")).where("events > 0")


@query("e7_event_rows", f"WITH {X.EVENT_SPANS} SELECT event_id, sha1(asset_id || ':' || category || ':' || event_id) AS label_id, count(*) OVER (PARTITION BY asset_id)::BIGINT AS event_count FROM spans")
def event_rows(spark, d):
    spans = X.event_spans(spark, d)
    counts = spans.groupBy("asset_id").agg(F.count("*").alias("event_count"))
    return spans.join(counts, "asset_id").select("event_id", F.sha1(F.concat_ws(":", "asset_id", "category", "event_id")).alias("label_id"), "event_count")


@query(
    "e9_clip_windows",
    f"WITH {X.EVENT_SPANS} SELECT event_id, round(greatest(start_sec - 5, 0), 4) AS clip_start, round(least(end_sec + 5, 2592000), 4) AS clip_end FROM spans",
)
def clip_windows(spark, d):
    start, end = I.clip_window(F.col("start_sec"), F.col("end_sec"), F.lit(2592000.0))
    return X.event_spans(spark, d).select("event_id", F.round(start, 4).alias("clip_start"), F.round(end, 4).alias("clip_end"))


@query(
    "e10_frame_count",
    """SELECT event_id, greatest(least(CASE WHEN value < 2 THEN 1 WHEN value < 10 THEN 3 WHEN value < 60 THEN 6 WHEN value < 300 THEN 12 ELSE 24 END, greatest(floor(value * 0.5), 1), 10), 1)::INT AS n FROM events""",
)
def frame_count(spark, d):
    return table(spark, d, "events").select("event_id", I.frame_count(F.col("value"), F.lit(0.5), 10).alias("n"))


@query(
    "e11_frame_timestamps",
    """SELECT event_id, array_to_string(CASE WHEN value > 0 THEN [printf('%.3f', round(i * 7.5, 3)) FOR i IN range(0, greatest(ceil(value / 7.5)::INT, 1))] ELSE ['0.000'] END, ',') AS at FROM events""",
)
def frame_timestamps(spark, d):
    at = F.transform(I.interval_timestamps(F.col("value"), 7.5), lambda t: F.format_string("%.3f", t))
    return table(spark, d, "events").select("event_id", F.array_join(at, ",").alias("at"))


@query("e11_even_timestamps", "SELECT p_partkey, round(p_size * 0.1, 3) AS first, round(p_size * (0.1 + (1 - 0.2) / 4 * 4), 3) AS last, 5 AS n FROM part WHERE p_size >= 2")
def even_timestamps(spark, d):
    at = I.even_timestamps(F.col("p_size").cast("double"), F.lit(5))
    return table(spark, d, "part").where("p_size >= 2").select("p_partkey", F.element_at(at, 1).alias("first"), F.element_at(at, -1).alias("last"), F.size(at).alias("n"))


@query("e15_index_window", "SELECT doc_id, array_to_string(list_filter(range(doc_id % 50 - 6, doc_id % 50 + 7, 3), lambda i: i >= 0 AND i < 40), ',') AS idx FROM documents")
def index_window(spark, d):
    window = I.index_window(F.col("doc_id") % 50, 6, 3, F.lit(40))
    return table(spark, d, "documents").select("doc_id", F.array_join(window.cast("array<string>"), ",").alias("idx"))


@query(
    "e16_gap_fill",
    """WITH g AS (SELECT event_id, user_id, ts, CASE WHEN event_id % 3 = 0 THEN value END AS v FROM events)
    SELECT event_id, coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
        first_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING)) AS v FROM g""",
)
def gap_fill(spark, d):
    gaps = table(spark, d, "events").select("event_id", "user_id", "ts", F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("v"))
    return I.filled(gaps, "user_id", ["ts", "event_id"], "v", 2).select("event_id", "v")


@query(
    "e17_alarm_debounce",
    "SELECT event_id, sum((event_type = 'error')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) >= 2 AS alarm FROM events",
)
def alarm_debounce(spark, d):
    rows = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    return I.debounced(rows, "user_id", ["ts", "event_id"], F.col("event_type") == "error", 5, 2, "alarm").select("event_id", "alarm")


@query("e18_majority", "SELECT user_id, arg_min(event_type, (-n, first)) AS winner FROM (SELECT user_id, event_type, count(*) AS n, min(event_id) AS first FROM events GROUP BY ALL) GROUP BY user_id")
def majority(spark, d):
    counted = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.min("event_id").alias("first"))
    return counted.groupBy("user_id").agg(F.min_by("event_type", F.struct(-F.col("n"), "first")).alias("winner"))


@query(
    "e13_clip_local_time",
    f"""WITH {X.EVENT_SPANS} SELECT event_id, round(greatest(start_sec - floor(start_sec / 3600) * 3600 - 600, 0) * 25)::BIGINT AS first_frame, round((end_sec - floor(start_sec / 3600) * 3600 - 600) * 25)::BIGINT AS last_frame
    FROM spans WHERE end_sec - floor(start_sec / 3600) * 3600 - 600 > 0""",
)
def clip_local_time(spark, d):
    origin = F.floor(F.col("start_sec") / 3600) * 3600 + 600
    local = X.event_spans(spark, d).select("event_id", F.greatest(F.col("start_sec") - origin, F.lit(0.0)).alias("s"), (F.col("end_sec") - origin).alias("e")).where("e > 0")
    return local.select("event_id", F.round(F.col("s") * 25).cast("long").alias("first_frame"), F.round(F.col("e") * 25).cast("long").alias("last_frame"))
