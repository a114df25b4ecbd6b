"""State machines, review rules, name and answer parsing, COCO payloads and evaluation summaries."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import parsing as P
from millrace.functions import scalars as S
from millrace.operators import workflow as O
from millrace.plans import fixtures as X
from millrace.plans.quality_queries import BOXES, boxes
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


# --- filters and joins ---------------------------------------------------------------------

ANSWERS = """answers AS (SELECT event_id, user_id, event_type, value, '{"score": ' || CAST(round(value, 2) AS VARCHAR) || ', "kind": "' || event_type || '"}' AS result FROM events)"""


def answers(spark, d):
    rounded = F.round("value", 2).cast("string")
    return table(spark, d, "events").select("event_id", "user_id", "event_type", "value", F.concat(F.lit('{"score": '), rounded, F.lit(', "kind": "'), "event_type", F.lit('"}')).alias("result"))


@query("f13_result_contains", f"WITH {ANSWERS} SELECT DISTINCT user_id FROM answers WHERE contains(result, '\"kind\": \"click\"') AND json_extract_string(result, '$.kind') = 'click'")
def result_contains(spark, d):
    return answers(spark, d).where(F.col("result").contains('"kind": "click"') & (F.get_json_object("result", "$.kind") == "click")).select("user_id").distinct()


@query("f16_json_field_projection", f"WITH {ANSWERS} SELECT event_id, json_extract_string(result, '$.kind') AS kind, TRY_CAST(json_extract_string(result, '$.score') AS DOUBLE) AS score FROM answers WHERE TRY_CAST(json_extract_string(result, '$.score') AS DOUBLE) > 50")
def json_field_projection(spark, d):
    score = F.get_json_object("result", "$.score").try_cast("double")
    return answers(spark, d).select("event_id", F.get_json_object("result", "$.kind").alias("kind"), score.alias("score")).where("score > 50")


@query("f24_retryable_failure", "SELECT doc_id, (text ILIKE '%timeout%' OR text ILIKE '%reset%' OR lower(text) LIKE '%ara%') AS retryable FROM documents")
def retryable_failure(spark, d):
    marks = [F.lower("text").contains(m) for m in ("timeout", "reset", "ara")]
    return table(spark, d, "documents").select("doc_id", (marks[0] | marks[1] | marks[2]).alias("retryable"))


@query("f25_row_visibility", "SELECT event_id, user_id FROM events, (SELECT unnest(['admin', 'labeler', 'guest']) AS role, unnest([0, 3, 3]) AS who) r WHERE role = 'labeler' AND user_id = who")
def row_visibility(spark, d):
    role, who = "labeler", 3
    allowed = {"admin": F.lit(True), "labeler": F.col("user_id") == who}
    return table(spark, d, "events").where(allowed.get(role, F.lit(False))).select("event_id", "user_id")


@query("j10_composite_literal_join", "SELECT p.p_partkey, l.l_orderkey, l.l_linenumber FROM part p LEFT JOIN lineitem l ON l.l_partkey = p.p_partkey AND l.l_linenumber = 1 AND l.l_returnflag = 'R'")
def composite_literal_join(spark, d):
    lines = table(spark, d, "lineitem").where("l_linenumber = 1 AND l_returnflag = 'R'")
    parts = table(spark, d, "part")
    return parts.join(lines, parts["p_partkey"] == lines["l_partkey"], "left").select("p_partkey", "l_orderkey", "l_linenumber")


@query(
    "j11_other_group_row",
    """WITH e AS (SELECT event_id, user_id, event_type, md5('7' || CAST(event_id AS VARCHAR)) AS h FROM events),
    best AS (SELECT event_type, user_id, min(h || ':' || event_id) AS m FROM e GROUP BY ALL),
    two AS (SELECT event_type, user_id, m, row_number() OVER (PARTITION BY event_type ORDER BY m) AS k FROM best),
    pick AS (SELECT event_type, max(CASE WHEN k = 1 THEN user_id END) AS u1, max(CASE WHEN k = 1 THEN m END) AS m1, max(CASE WHEN k = 2 THEN m END) AS m2 FROM two WHERE k <= 2 GROUP BY ALL)
    SELECT e.event_id, CAST(split_part(CASE WHEN e.user_id = u1 THEN m2 ELSE m1 END, ':', 2) AS BIGINT) AS other FROM e JOIN pick USING (event_type)""",
)
def other_group_row(spark, d):
    """A seeded random row of the same type from another group, for each row; two best rows of each type suffice."""
    rows = table(spark, d, "events").select("event_id", "user_id", "event_type", F.md5(F.concat(F.lit("7"), F.col("event_id").cast("string"))).alias("h"))
    best = rows.groupBy("event_type", "user_id").agg(F.min(F.concat("h", F.lit(":"), "event_id")).alias("m"))
    two = best.groupBy("event_type").agg(F.min(F.struct("m", "user_id")).alias("first"))
    others = best.join(two, "event_type").where("user_id <> first.user_id").groupBy("event_type").agg(F.min("m").alias("m2"))
    pick = two.join(others, "event_type", "left")
    own = F.when(F.col("user_id") == F.col("first.user_id"), F.col("m2")).otherwise(F.col("first.m"))
    return rows.join(pick, "event_type").select("event_id", F.split_part(own, F.lit(":"), F.lit(2)).try_cast("long").alias("other"))


@query("j19_batch_like_join", f"WITH {X.RAW_FILES}, req AS (SELECT DISTINCT unit FROM raw_files) SELECT r.unit, count(*) AS n FROM req r JOIN raw_files f ON f.raw_key LIKE r.unit || '/%' GROUP BY r.unit")
def batch_like_join(spark, d):
    """A prefix that ends at a delimiter is an equality on the part before it."""
    files = X.raw_files(spark, d)
    requests = files.select("unit").distinct()
    return files.withColumn("head", F.split_part("raw_key", F.lit("/"), F.lit(1))).join(requests.withColumnRenamed("unit", "head"), "head").groupBy(F.col("head").alias("unit")).agg(F.count("*").alias("n"))


# --- aggregates ---------------------------------------------------------------------------------


@query("g19_annotation_columns", "SELECT user_id, round(avg(value), 6) AS avg_lead, round(avg(CASE WHEN event_type = 'click' THEN value END), 6) AS avg_click, list_sort(array_agg(DISTINCT event_type)) AS kinds, bool_or(value > 90) AS any_draft FROM events GROUP BY user_id")
def annotation_columns(spark, d):
    click = F.when(F.col("event_type") == "click", F.col("value"))
    return table(spark, d, "events").groupBy("user_id").agg(F.round(F.avg("value"), 6).alias("avg_lead"), F.round(F.avg(click), 6).alias("avg_click"), F.array_sort(F.collect_set("event_type")).alias("kinds"), F.bool_or(F.col("value") > 90).alias("any_draft"))


@query("g20_group_concat", "SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS kinds FROM events GROUP BY user_id")
def group_concat(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("kinds"))


@query("g21_version_counts", "SELECT p_brand, p_size AS version, count(*) AS n, max(p_partkey) AS latest FROM part GROUP BY ALL")
def version_counts(spark, d):
    return table(spark, d, "part").groupBy("p_brand", F.col("p_size").alias("version")).agg(F.count("*").alias("n"), F.max("p_partkey").alias("latest"))


@query("g22_usage_totals", "SELECT conv_id, turn, sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)::BIGINT AS used FROM (SELECT conv_id, turn, string_agg(text, '' ORDER BY role, text) AS text FROM conversations GROUP BY ALL)")
def usage_totals(spark, d):
    turns = table(spark, d, "conversations").groupBy("conv_id", "turn").agg(F.sum(F.length("text")).alias("n"))
    return turns.select("conv_id", "turn", F.sum("n").over(Window.partitionBy("conv_id").orderBy("turn")).alias("used"))


@query("g27_agent_stats", "SELECT role, turn % 2 AS model, count(*) AS calls, sum(length(text))::BIGINT AS total, max(length(text)) AS longest FROM conversations GROUP BY ALL")
def agent_stats(spark, d):
    size = F.length("text")
    return table(spark, d, "conversations").groupBy("role", (F.col("turn") % 2).alias("model")).agg(F.count("*").alias("calls"), F.sum(size).alias("total"), F.max(size).cast("long").alias("longest"))


# --- review --------------------------------------------------------------------------------------

TASKS = """tasks AS (SELECT doc_id AS task, quality = 1 AS labelled, CASE doc_id % 4 WHEN 0 THEN 'approved' WHEN 1 THEN 'first_approved' WHEN 2 THEN 'rejected' ELSE 'open' END AS state FROM labels)"""


def tasks(spark, d):
    state = F.expr("CASE doc_id % 4 WHEN 0 THEN 'approved' WHEN 1 THEN 'first_approved' WHEN 2 THEN 'rejected' ELSE 'open' END")
    return table(spark, d, "labels").select(F.col("doc_id").alias("task"), (F.col("quality") == 1).alias("labelled"), state.alias("state"))


@query("r2_bulk_approve", f"WITH {TASKS} SELECT count(*) FILTER (WHERE labelled AND state <> 'approved') AS processed, count(*) FILTER (WHERE NOT coalesce(labelled AND state <> 'approved', false)) AS skipped FROM tasks")
def bulk_approve(spark, d):
    eligible = F.coalesce(F.col("labelled") & (F.col("state") != "approved"), F.lit(False))
    return tasks(spark, d).agg(F.count_if(eligible).alias("processed"), F.count_if(~eligible).alias("skipped"))


@query("r5_overlap_available", "WITH a AS (SELECT l_partkey AS task, count(DISTINCT l_suppkey) AS done, count(*) FILTER (WHERE l_linestatus = 'O') AS locks FROM lineitem GROUP BY ALL) SELECT task, done + locks AS taken, done + locks < 20 AS available FROM a")
def overlap_available(spark, d):
    rows = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("task")).agg(F.count_distinct("l_suppkey").alias("done"), F.count_if(F.col("l_linestatus") == "O").alias("locks"))
    return rows.select("task", (F.col("done") + F.col("locks")).alias("taken"), (F.col("done") + F.col("locks") < 20).alias("available"))


# --- ranking -----------------------------------------------------------------------------------------


@query("w4_previous_generation", "SELECT o_custkey, max(CASE WHEN k = 1 THEN o_orderkey END) AS latest, max(CASE WHEN k = 2 THEN o_orderkey END) AS previous FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders) WHERE k <= 2 GROUP BY o_custkey")
def previous_generation(spark, d):
    place = F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")))
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", place.alias("k")).where("k <= 2")
    return rows.groupBy("o_custkey").agg(F.max(F.when(F.col("k") == 1, F.col("o_orderkey"))).alias("latest"), F.max(F.when(F.col("k") == 2, F.col("o_orderkey"))).alias("previous"))


@query("w17_relevance_top", "SELECT l_orderkey, min(pos) AS top FROM (SELECT l_orderkey, l_linenumber AS pos, l_discount AS s, max(l_discount) FILTER (WHERE l_discount > 0.02) OVER (PARTITION BY l_orderkey) AS best FROM lineitem) WHERE s = best GROUP BY l_orderkey")
def relevance_top(spark, d):
    """The first place with the highest valid score."""
    valid = table(spark, d, "lineitem").where("l_discount > 0.02").select("l_orderkey", F.col("l_linenumber").alias("pos"), F.col("l_discount").alias("s"))
    return valid.groupBy("l_orderkey").agg(F.min(F.struct((-F.col("s")).alias("a"), "pos")).alias("m")).select("l_orderkey", F.col("m.pos").alias("top"))


@query("w20_seeded_take", "SELECT doc_id FROM documents ORDER BY md5('13' || doc_id), doc_id LIMIT 100")
def seeded_take(spark, d):
    return table(spark, d, "documents").select("doc_id").orderBy(F.md5(F.concat(F.lit("13"), F.col("doc_id").cast("string"))), "doc_id").limit(100)


@query("w21_even_places", "WITH n AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY ALL) SELECT conv_id, CASE WHEN n <= 4 THEN range(n) ELSE list_distinct([CAST(floor(i * (n - 1) / 3.0 + 0.5) AS BIGINT) FOR i IN range(4)]).list_sort() END AS places FROM n")
def even_places(spark, d):
    return table(spark, d, "conversations").groupBy("conv_id").agg(F.count("*").alias("n")).select("conv_id", O.even_places(F.col("n"), 4).alias("places"))


CONFIGS = """configs(who, team, setting) AS (VALUES (3, NULL, 'personal'), (NULL, 1, 'team one'), (NULL, 0, 'team zero'), (NULL, NULL, 'fallback'))"""


@query("w22_config_priority", f"WITH {CONFIGS} SELECT c_custkey, coalesce((SELECT setting FROM configs WHERE who = c_custkey), (SELECT setting FROM configs WHERE team = c_nationkey % 3), 'fallback') AS setting FROM customer")
def config_priority(spark, d):
    personal = F.broadcast(spark.createDataFrame([(3, "personal")], "c_custkey long, own string"))
    team = F.broadcast(spark.createDataFrame([(1, "team one"), (0, "team zero")], "team int, shared string"))
    rows = table(spark, d, "customer").withColumn("team", F.col("c_nationkey") % 3)
    return rows.join(personal, "c_custkey", "left").join(team, "team", "left").select("c_custkey", F.coalesce("own", "shared", F.lit("fallback")).alias("setting"))


# --- state machines -----------------------------------------------------------------------------------


@query("u2_prompt_catalog", "SELECT 'part:' || p_size AS name, p_brand AS body FROM part UNION ALL SELECT 'seg:' || c_nationkey, c_mktsegment FROM customer")
def prompt_catalog(spark, d):
    parts = table(spark, d, "part").select(F.concat(F.lit("part:"), F.col("p_size").cast("string")).alias("name"), F.col("p_brand").alias("body"))
    return parts.unionAll(table(spark, d, "customer").select(F.concat(F.lit("seg:"), F.col("c_nationkey").cast("string")), "c_mktsegment"))


@query("u12_replace_frame_rows", "WITH fresh AS (SELECT l_orderkey, l_linenumber, 'new' AS origin FROM lineitem WHERE l_returnflag = 'R') SELECT l_orderkey, l_linenumber, 'old' AS origin FROM lineitem o WHERE NOT EXISTS (SELECT 1 FROM fresh f WHERE f.l_orderkey = o.l_orderkey AND f.l_linenumber = o.l_linenumber) UNION ALL SELECT * FROM fresh")
def replace_frame_rows(spark, d):
    lines = table(spark, d, "lineitem")
    fresh = lines.where("l_returnflag = 'R'").select("l_orderkey", "l_linenumber", F.lit("new").alias("origin"))
    old = lines.select("l_orderkey", "l_linenumber", F.lit("old").alias("origin"))
    return old.join(fresh, ["l_orderkey", "l_linenumber"], "left_anti").unionAll(fresh)


@query("u14_cleanup_check", f"WITH {X.RAW_FILES} SELECT unit, count(*) AS before, count(*) FILTER (WHERE status = 'failed') AS deleted, count(*) - count(*) FILTER (WHERE status = 'failed') AS after FROM raw_files GROUP BY unit")
def cleanup_check(spark, d):
    files = X.raw_files(spark, d)
    kept = files.where(~F.coalesce(F.col("status") == "failed", F.lit(False))).groupBy("unit").agg(F.count("*").alias("after"))
    whole = files.groupBy("unit").agg(F.count("*").alias("before"))
    after = F.coalesce("after", F.lit(0).cast("long"))
    return whole.join(kept, "unit", "left").select("unit", "before", (F.col("before") - after).alias("deleted"), after.alias("after"))


@query("u16_batch_status", f"WITH {X.RAW_FILES} SELECT asset_id, CASE WHEN hit THEN 'queued' ELSE status END AS status, hit AS changed FROM (SELECT *, size % 2 = 0 AND coalesce(status, '') <> 'completed' AS hit FROM raw_files)")
def batch_status(spark, d):
    files = X.raw_files(spark, d).select("asset_id", "status", "size")
    return O.batch_status(files, files.where("size % 2 = 0"), key="asset_id", to="queued").select("asset_id", "status", "changed")


@query(
    "u17_alias_pins",
    """WITH pins AS (SELECT o_orderpriority AS alias, o_orderkey AS version, o_orderdate AS moment FROM orders WHERE o_orderstatus IN ('F', 'O'))
    SELECT alias, version, lag(version) OVER (PARTITION BY alias ORDER BY moment, version) AS previous, CASE WHEN lead(version) OVER (PARTITION BY alias ORDER BY moment, version) IS NULL THEN 'pinned' ELSE 'available' END AS state FROM pins""",
)
def alias_pins(spark, d):
    """Pin events in order: each names the version pinned before it, and the last one holds."""
    pins = table(spark, d, "orders").where(F.col("o_orderstatus").isin("F", "O")).select(F.col("o_orderpriority").alias("alias"), F.col("o_orderkey").alias("version"), F.col("o_orderdate").alias("at"))
    order = Window.partitionBy("alias").orderBy("at", "version")
    return pins.select("alias", "version", F.lag("version").over(order).alias("previous"), F.when(F.lead("version").over(order).isNull(), "pinned").otherwise("available").alias("state"))


@query("u18_claim", "SELECT event_id, (event_type = 'click') OR value > 50 AS taken, event_type <> 'click' AND value > 50 AS claimed FROM events")
def claimed(spark, d):
    rows = table(spark, d, "events").withColumn("taken", F.when(F.col("event_type") == "click", True))
    return O.claim(rows, flag="taken", when=F.col("value") > 50).select("event_id", "taken", "claimed")


REGISTRY = """registry AS (SELECT p_brand AS task, p_partkey AS version, CASE WHEN p_partkey = min(p_partkey) OVER (PARTITION BY p_brand) THEN 'promoted' ELSE 'new' END AS state FROM part)"""


@query("u19_promotion", f"WITH {REGISTRY}, c AS (SELECT task, max(version) AS v FROM registry WHERE version % 2 = 0 GROUP BY task) SELECT task, version, CASE WHEN version = v THEN 'promoted' WHEN v IS NOT NULL AND state = 'promoted' THEN 'archived' ELSE state END AS state FROM registry LEFT JOIN c USING (task)")
def promotion(spark, d):
    parts = table(spark, d, "part").select(F.col("p_brand").alias("task"), F.col("p_partkey").alias("version"))
    first = F.min("version").over(Window.partitionBy("task"))
    registry = parts.withColumn("state", F.when(F.col("version") == first, "promoted").otherwise("new"))
    chosen = registry.where("version % 2 = 0").groupBy("task").agg(F.max("version").alias("version"))
    return O.promote(registry, chosen, task="task", version="version").select("task", "version", "state")


@query("u21_active_pointer", "SELECT c_custkey, CASE WHEN trim(coalesce(CASE WHEN c_acctbal > 0 THEN c_mktsegment ELSE ' ' END, '')) = '' THEN 'default' ELSE c_mktsegment END AS active FROM customer")
def active_pointer(spark, d):
    pointer = F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).otherwise(" ")
    return table(spark, d, "customer").select("c_custkey", S.norm_str(pointer, "default").alias("active"))


@query(
    "u22_request_lifecycle",
    """SELECT batch, CASE WHEN bool_or(status = 'failed') THEN 'failed' WHEN bool_and(status = 'done') THEN 'completed' WHEN bool_or(status = 'done') THEN 'running' ELSE 'requested' END AS state,
    max(CASE WHEN status <> 'open' THEN seq END) AS last_step FROM (WITH """ + X.JOBS + """ SELECT * FROM jobs) GROUP BY batch""",
)
def request_lifecycle(spark, d):
    state = F.when(F.bool_or(F.col("status") == "failed"), "failed").when(F.bool_and(F.col("status") == "done"), "completed").when(F.bool_or(F.col("status") == "done"), "running").otherwise("requested")
    return X.jobs(spark, d).groupBy("batch").agg(state.alias("state"), F.max(F.when(F.col("status") != "open", F.col("seq"))).alias("last_step"))


@query("u23_lock_release", "SELECT event_id, CASE WHEN NOT (value > 20) THEN 'free' WHEN epoch_us(TIMESTAMP '2024-01-15 00:00:00') - epoch_us(ts) > 86400000000 AND user_id % 3 <> 0 THEN 'release' ELSE 'keep' END AS decision FROM events")
def lock_release(spark, d):
    rows = table(spark, d, "events").select("event_id", (F.col("value") > 20).alias("active"), F.col("ts").cast("timestamp").alias("heartbeat"), (F.col("user_id") % 3 == 0).alias("owner_running"))
    return O.lock_decision(rows, now=F.lit("2024-01-15 00:00:00").cast("timestamp"), ttl_seconds=86400).select("event_id", "decision")


@query("u24_unique_keys", "WITH k AS (SELECT doc_id, source || '-' || lang AS key FROM documents), t AS (SELECT key, count(*) AS taken FROM k WHERE doc_id < 20 GROUP BY key), n AS (SELECT doc_id, k.key, row_number() OVER (PARTITION BY k.key ORDER BY doc_id) + coalesce(taken, 0) AS p FROM k LEFT JOIN t ON t.key = k.key WHERE doc_id >= 20) SELECT doc_id, CASE WHEN p = 1 THEN key ELSE key || '_' || p END AS unique_key FROM n")
def unique_keys(spark, d):
    keys = table(spark, d, "documents").select("doc_id", F.concat_ws("-", "source", "lang").alias("key"))
    return O.unique_keys(keys.where("doc_id >= 20"), key="key", order=["doc_id"], existing=keys.where("doc_id < 20")).select("doc_id", "unique_key")


# --- duplicates ---------------------------------------------------------------------------------------------


@query("d5_ingest_gate", f"WITH {X.RAW_FILES}, old AS (SELECT DISTINCT checksum FROM raw_files WHERE asset_id % 2 = 0) SELECT asset_id, checksum IN (SELECT checksum FROM old) OR row_number() OVER (PARTITION BY checksum ORDER BY asset_id) > 1 AS rejected FROM raw_files WHERE asset_id % 2 = 1")
def ingest_gate(spark, d):
    """New files whose checksum is known, or came earlier in the batch, are rejected."""
    files = X.raw_files(spark, d)
    known = files.where("asset_id % 2 = 0").select("checksum").distinct().withColumn("known", F.lit(True))
    again = F.row_number().over(Window.partitionBy("checksum").orderBy("asset_id")) > 1
    return files.where("asset_id % 2 = 1").join(known, "checksum", "left").select("asset_id", (F.coalesce("known", F.lit(False)) | again).alias("rejected"))


@query("d6_byte_source", f"WITH {X.RAW_FILES} SELECT asset_id, CASE WHEN asset_id % 3 = 0 THEN 'archive' WHEN status = 'completed' THEN 'source' ELSE 'store' END AS origin FROM raw_files")
def byte_source(spark, d):
    places = [F.when(F.col("asset_id") % 3 == 0, "archive"), F.when(F.col("status") == "completed", "source"), F.lit("store")]
    return X.raw_files(spark, d).select("asset_id", F.coalesce(*places).alias("origin"))


@query("d12_source_keeper", f"WITH {X.RAW_FILES} SELECT unit, checksum, min(asset_id) AS keeper, count(*) - 1 AS extra FROM raw_files GROUP BY ALL HAVING count(*) > 1")
def source_keeper(spark, d):
    groups = X.raw_files(spark, d).groupBy("unit", "checksum").agg(F.min("asset_id").alias("keeper"), (F.count("*") - 1).alias("extra"))
    return groups.where("extra > 0")


_SLUG = "lower(regexp_replace(regexp_replace(regexp_replace(translate(translate({0}, 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ', 'aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY'), ' ', '_'), '[^A-Za-z0-9._-]', '', 'g'), '_+', '_', 'g'), '^[_.]+|[_.]+$', '', 'g'))"
_CUT = "substr(regexp_replace(text, '\\s', ' ', 'g'), 1, 30)"


@query("d13_repaired_keys", f"SELECT doc_id, {_SLUG.format(_CUT)} AS slug, count(*) OVER (PARTITION BY {_SLUG.format(_CUT)}) > 1 AS ambiguous FROM documents WHERE {_SLUG.format(_CUT)} <> ''")
def repaired_keys(spark, d):
    name = F.substring(F.regexp_replace("text", r"\s", " "), 1, 30)
    rows = table(spark, d, "documents").select("doc_id", P.path_component(name).alias("slug")).where("slug <> 'unnamed'")
    return rows.select("doc_id", "slug", (F.count("*").over(Window.partitionBy("slug")) > 1).alias("ambiguous"))


@query("d14_marker_merge", "SELECT user_id, event_type AS marker, max(n) AS n FROM (SELECT user_id, event_type, value > 50 AS src, count(*) AS n FROM events GROUP BY ALL) GROUP BY ALL")
def marker_merge(spark, d):
    """A marker is kept as often as the set that holds it most often does."""
    each = table(spark, d, "events").groupBy("user_id", "event_type", (F.col("value") > 50).alias("src")).agg(F.count("*").alias("n"))
    return each.groupBy("user_id", F.col("event_type").alias("marker")).agg(F.max("n").alias("n"))


# --- names and answers ---------------------------------------------------------------------------------------


@query("x2_path_component", f"SELECT doc_id, CASE WHEN {_SLUG.format(_CUT)} = '' THEN 'unnamed' ELSE {_SLUG.format(_CUT)} END AS slug FROM documents")
def path_component(spark, d):
    return table(spark, d, "documents").select("doc_id", P.path_component(F.substring(F.regexp_replace("text", r"\s", " "), 1, 30)).alias("slug"))


REPLIES = """replies AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN '```json' || chr(10) || '{"relevance_score": ' || (event_id % 30) / 20.0 || ',}' || chr(10) || '```' WHEN 1 THEN 'Sure: {"relevance_score": "-0.5", "predicted_class": " Click "} ok' WHEN 2 THEN '{"relevance_score": true, "predicted_class": "other"}' ELSE 'none' END AS reply FROM events)"""


def replies(spark, d):
    score = (F.col("event_id") % 30 / F.lit(20.0)).cast("string")
    fenced = F.concat(F.lit('```json\n{"relevance_score": '), score, F.lit(",}\n```"))
    place = F.col("event_id") % 4
    reply = F.when(place == 0, fenced).when(place == 1, 'Sure: {"relevance_score": "-0.5", "predicted_class": " Click "} ok').when(place == 2, '{"relevance_score": true, "predicted_class": "other"}').otherwise("none")
    return table(spark, d, "events").select("event_id", reply.alias("reply"))


@query("x13_clean_json", f"WITH {REPLIES} SELECT event_id, CASE event_id % 4 WHEN 3 THEN '' WHEN 0 THEN regexp_replace(regexp_extract(reply, '\\{{[^}}]*\\}}'), ',\\}}', '}}') ELSE regexp_extract(reply, '\\{{[^}}]*\\}}') END AS body FROM replies")
def clean_json(spark, d):
    return replies(spark, d).select("event_id", P.clean_json(F.col("reply")).alias("body"))


@query("x15_relevance", f"WITH {REPLIES} SELECT event_id, CASE event_id % 4 WHEN 0 THEN least(1.0, (event_id % 30) / 20.0)::DOUBLE WHEN 1 THEN 0.0::DOUBLE END AS score FROM replies")
def relevance(spark, d):
    return replies(spark, d).select("event_id", P.relevance(F.col("reply")).alias("score"))


@query("x16_classification", "SELECT event_id, CASE event_id % 4 WHEN 1 THEN 'click' END AS predicted FROM events")
def classification(spark, d):
    return replies(spark, d).select("event_id", P.classification(F.col("reply"), ["Click", "view"]).alias("predicted"))


@query(
    "x32_uuid5",
    """WITH h AS (SELECT doc_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(source || '/' || doc_id)) AS s FROM documents)
    SELECT doc_id, substr(s, 1, 8) || '-' || substr(s, 9, 4) || '-5' || substr(s, 14, 3) || '-' || substr('89ab', 1 + (strpos('0123456789abcdef', substr(s, 17, 1)) - 1)::INT % 4, 1) || substr(s, 18, 3) || '-' || substr(s, 21, 12) AS id FROM h""",
)
def uuid5(spark, d):
    return table(spark, d, "documents").select("doc_id", P.uuid5(uuid.NAMESPACE_URL, F.concat_ws("/", "source", "doc_id")).alias("id"))


@query("x37_expiry", "SELECT event_id, greatest(0, epoch(ts)::BIGINT + 604800 - epoch(TIMESTAMP '2024-01-15 00:00:00')::BIGINT) AS left_seconds FROM (SELECT event_id, date_trunc('second', ts) AS ts FROM events)")
def expiry(spark, d):
    now = F.lit("2024-01-15 00:00:00").cast("timestamp")
    return table(spark, d, "events").select("event_id", P.expiry(F.col("ts").cast("timestamp"), F.lit(604800), now).alias("left_seconds"))


@query("x38_model_names", "SELECT p_partkey, p_brand || '@v' || p_size AS name, p_size = 1 AS stock FROM part")
def model_names(spark, d):
    name = F.concat("p_brand", F.lit("@v"), F.col("p_size").cast("string"))
    parsed = F.regexp_extract(name, r"@v([0-9]+)$", 1).cast("int")
    return table(spark, d, "part").select("p_partkey", name.alias("name"), (parsed == 1).alias("stock"))


@query("x41_pricing", "SELECT l_orderkey, l_linenumber, round(l_quantity * CASE l_returnflag WHEN 'A' THEN 0.10 WHEN 'N' THEN 0.25 ELSE 0.5 END, 6) AS price FROM lineitem")
def pricing(spark, d):
    rate = S.lookup(F.col("l_returnflag"), {"A": "0.10", "N": "0.25"}, F.lit("0.5")).cast("double")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(F.col("l_quantity") * rate, 6).alias("price"))


@query("x43_display_width", "SELECT doc_id, length(t) + length(regexp_replace(t, '[^\\x{1100}-\\x{115F}\\x{2E80}-\\x{A4CF}\\x{AC00}-\\x{D7A3}\\x{F900}-\\x{FAFF}\\x{FF00}-\\x{FF60}]', '', 'g')) AS width FROM (SELECT doc_id, text || ' 가나 漢字' AS t FROM documents)")
def display_width(spark, d):
    return table(spark, d, "documents").select("doc_id", P.display_width(F.concat("text", F.lit(" 가나 漢字"))).cast("long").alias("width"))


# --- detections -----------------------------------------------------------------------------------------------


@query("x40_corner_boxes", "SELECT l_orderkey, l_linenumber, round(least(l_quantity, l_discount), 2) AS x, round(abs(l_discount - l_quantity), 2) AS w FROM lineitem WHERE l_quantity <> l_discount AND l_linenumber <> 3")
def corner_boxes(spark, d):
    box = P.box_of_corners(F.col("l_quantity"), F.col("l_linenumber").cast("double"), F.col("l_discount"), F.lit(3.0))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", box.alias("box")).where("box IS NOT NULL").select("l_orderkey", "l_linenumber", "box.x", "box.w")


@query(
    "c2_coco_payload",
    f"""WITH {BOXES}, c AS (SELECT category, row_number() OVER (ORDER BY category) AS category_id FROM (SELECT DISTINCT category FROM pred))
    SELECT image, row_number() OVER (PARTITION BY image ORDER BY category, pid) AS id, category_id, round(x1, 2) AS x, round(y1, 2) AS y, round((x2 - x1) * (y2 - y1), 2) AS area FROM pred JOIN c USING (category)""",
)
def coco_payload(spark, d):
    """Annotations of each image with category numbers by name, in order of category and place."""
    _, pred = boxes(spark, d)
    names = pred.select("category").distinct().withColumn("category_id", F.row_number().over(Window.orderBy("category")))
    rows = pred.join(names, "category")
    number = F.row_number().over(Window.partitionBy("image").orderBy("category", "pid"))
    return rows.select("image", number.alias("id"), "category_id", F.round("x1", 2).alias("x"), F.round("y1", 2).alias("y"), F.round((F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1")), 2).alias("area"))


@query("c9_review_rectangles", f"WITH {BOXES} SELECT image, pid, CASE category WHEN 'R' THEN 'red' ELSE category END AS label, round(100 * x1 / 200, 6) AS x_pct, round(100 * (x2 - x1) / 200, 6) AS w_pct FROM pred WHERE category IN ('R', 'A') AND score >= 0.03")
def review_rectangles(spark, d):
    """Boxes of allowed labels and sufficient score as percentages of the image's width."""
    _, pred = boxes(spark, d)
    label = S.lookup(F.col("category"), {"R": "red"}, F.col("category"))
    kept = pred.where(F.col("category").isin("R", "A") & (F.col("score") >= 0.03))
    return kept.select("image", "pid", label.alias("label"), F.round(100 * F.col("x1") / 200, 6).alias("x_pct"), F.round(100 * (F.col("x2") - F.col("x1")) / 200, 6).alias("w_pct"))


@query("c10_projection_refresh", f"WITH {BOXES}, t AS (SELECT DISTINCT image FROM pred) SELECT image, 'pred' AS origin, count(*) AS n FROM pred GROUP BY image UNION ALL SELECT image, 'truth', count(*) FROM truth WHERE image NOT IN (SELECT image FROM t) GROUP BY image")
def projection_refresh(spark, d):
    """An image's rows are replaced by the fresh ones, if it has any."""
    truth, pred = boxes(spark, d)
    old = truth.join(pred.select("image").distinct(), "image", "left_anti").withColumn("origin", F.lit("truth"))
    return pred.withColumn("origin", F.lit("pred")).select("image", "origin").unionAll(old.select("image", "origin")).groupBy("image", "origin").agg(F.count("*").alias("n"))


@query("c11_split", "WITH r AS (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY md5('5' || p_partkey), p_partkey) AS k, count(*) OVER (PARTITION BY p_brand) AS n FROM part) SELECT p_brand, p_partkey, CASE WHEN n >= 2 AND k <= greatest(1, least(n - 1, CAST(floor(n * 0.2) AS BIGINT))) THEN 'test' ELSE 'train' END AS part_of FROM r")
def split(spark, d):
    """A seeded fifth of each group is for tests: one at least of two or more, and one at least is for training."""
    group = Window.partitionBy("p_brand")
    place = F.row_number().over(group.orderBy(F.md5(F.concat(F.lit("5"), F.col("p_partkey").cast("string"))), "p_partkey"))
    rows = table(spark, d, "part").select("p_brand", "p_partkey", place.alias("k"), F.count("*").over(group).alias("n"))
    size = F.greatest(F.lit(1), F.least(F.col("n") - 1, F.floor(F.col("n") * 0.2)))
    return rows.select("p_brand", "p_partkey", F.when((F.col("n") >= 2) & (F.col("k") <= size), "test").otherwise("train").alias("part_of"))


@query("c12_by_prompt", f"WITH {BOXES} SELECT image, coalesce(CASE category WHEN 'R' THEN 'fire' WHEN 'N' THEN 'smoke' END, lower(category)) AS prompt, count(*) AS n, max(score) AS best FROM pred GROUP BY ALL")
def by_prompt(spark, d):
    _, pred = boxes(spark, d)
    prompt = S.lookup(F.col("category"), {"R": "fire", "N": "smoke"}, F.lower("category"))
    return pred.groupBy("image", prompt.alias("prompt")).agg(F.count("*").alias("n"), F.max("score").alias("best"))


# --- evaluation ---------------------------------------------------------------------------------------------------


@query("m7_scorability", f"WITH {BOXES}, p AS (SELECT image, count(*) AS n FROM pred GROUP BY image), t AS (SELECT image, count(*) AS n FROM truth GROUP BY image) SELECT image, coalesce(p.n, 0) AS scorable, CASE WHEN coalesce(p.n, 0) = 0 THEN 'abstain' ELSE 'score' END AS verdict FROM t LEFT JOIN p USING (image)")
def scorability(spark, d):
    truth, pred = boxes(spark, d)
    counts = pred.groupBy("image").agg(F.count("*").alias("n"))
    scorable = F.coalesce("n", F.lit(0).cast("long"))
    return truth.select("image").distinct().join(counts, "image", "left").select("image", scorable.alias("scorable"), F.when(scorable == 0, "abstain").otherwise("score").alias("verdict"))


@query("m9_summary", "SELECT event_type, round(avg(value), 2) AS mean, round(median(value), 4) AS middle, round(quantile_cont(value, 0.95), 4) AS p95, round(count(*) * 60.0 / sum(value), 4) AS per_minute FROM events GROUP BY event_type")
def summary(spark, d):
    rate = F.when(F.sum("value") > 0, F.count("*") * 60.0 / F.sum("value"))
    middle, high = F.expr("percentile(value, 0.5)"), F.expr("percentile(value, 0.95)")
    return table(spark, d, "events").groupBy("event_type").agg(F.round(F.avg("value"), 2).alias("mean"), F.round(middle, 4).alias("middle"), F.round(high, 4).alias("p95"), F.round(rate, 4).alias("per_minute"))


@query("m22_export_contract", "SELECT 'orphan' AS rule, count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) UNION ALL SELECT 'status', count(*) FROM orders WHERE o_orderstatus NOT IN ('O', 'F') UNION ALL SELECT 'key', count(*) - count(DISTINCT o_orderkey) FROM orders UNION ALL SELECT 'null', count(*) FROM orders WHERE o_orderstatus = 'F' AND o_totalprice IS NULL")
def export_contract(spark, d):
    orders = table(spark, d, "orders")
    known = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"))
    counted = lambda rows, rule: rows.agg(F.count("*").alias("n")).select(F.lit(rule).alias("rule"), "n")
    keys = orders.agg((F.count("*") - F.count_distinct("o_orderkey")).alias("n")).select(F.lit("key").alias("rule"), "n")
    parts = [counted(orders.join(known, "o_custkey", "left_anti"), "orphan"), counted(orders.where(~F.col("o_orderstatus").isin("O", "F")), "status"), keys, counted(orders.where("o_orderstatus = 'F' AND o_totalprice IS NULL"), "null")]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])


# --- events -----------------------------------------------------------------------------------------------------------


@query("e8_imported_events", "SELECT event_id, lower(trim(event_type)) AS category, round(least(a, b), 3) AS start_sec, round(greatest(a, b), 3) AS end_sec FROM (SELECT event_id, event_type, value AS a, CASE WHEN event_id % 2 = 0 THEN value + 5 ELSE value - 5 END AS b FROM events) WHERE greatest(a, b) > 0")
def imported_events(spark, d):
    """Field names differ between sources: each takes the first of its aliases that is there, and swapped ends are put right."""
    rows = table(spark, d, "events").select("event_id", F.col("event_type").alias("label"), F.when(F.col("event_id") % 2 == 0, F.col("value")).alias("start"), F.when(F.col("event_id") % 2 == 1, F.col("value")).alias("timestamp"), F.when(F.col("event_id") % 2 == 0, F.col("value") + 5).otherwise(F.col("value") - 5).alias("end"))
    begin = F.coalesce("start", "timestamp")
    out = rows.select("event_id", F.lower(F.trim("label")).alias("category"), F.round(F.least(begin, F.col("end")), 3).alias("start_sec"), F.round(F.greatest(begin, F.col("end")), 3).alias("end_sec"), F.greatest(begin, F.col("end")).alias("last"))
    return out.where("last > 0").drop("last")


@query("e12_sampling_policy", "SELECT event_id, CASE WHEN user_id % 10 = 0 THEN 7 ELSE least(12, greatest(1, CAST(ceil(value / 10) AS BIGINT)) * CASE event_type WHEN 'view' THEN 2 ELSE 1 END) END AS frames FROM events")
def sampling_policy(spark, d):
    base = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("value") / 10))
    scaled = F.least(F.lit(12).cast("long"), base * F.when(F.col("event_type") == "view", 2).otherwise(1))
    return table(spark, d, "events").select("event_id", F.when(F.col("user_id") % 10 == 0, F.lit(7).cast("long")).otherwise(scaled).alias("frames"))


@query("e14_review_events", "SELECT l_orderkey, l_linenumber, round((l_quantity - 1) / 25, 3) AS start_sec, round((l_quantity + l_linenumber) / 25, 3) AS end_sec FROM lineitem")
def review_events(spark, d):
    """Ranges of frames, counted from 1 with both ends, as seconds."""
    first, last, fps = F.col("l_quantity"), F.col("l_quantity") + F.col("l_linenumber"), 25
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round((first - 1) / fps, 3).alias("start_sec"), F.round(last / fps, 3).alias("end_sec"))


@query("e19_scene_text", "SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN event_type END AS kind, CASE WHEN value > 50 THEN 'day' ELSE 'night' END AS light FROM events")
def scene_text(spark, d):
    """``key: value`` lines; values outside a key's list are null."""
    light = F.when(F.col("value") > 50, "Day").otherwise("night")
    scene = F.concat(F.lit("Kind: "), "event_type", F.lit("\nnonsense\nLight : "), light)
    value = lambda name, allowed: F.filter(F.array(F.lower(F.trim(F.regexp_extract("scene", rf"(?im)^{name}\s*:(.*)$", 1)))), lambda v: v.isin(*allowed)).getItem(0)
    return table(spark, d, "events").withColumn("scene", scene).select("event_id", F.get(F.filter(F.array(F.lower(F.trim(F.regexp_extract("scene", r"(?im)^kind\s*:(.*)$", 1)))), lambda v: v.isin("click", "view")), F.lit(0)).alias("kind"), value("light", ("day", "night")).alias("light"))


# --- banks --------------------------------------------------------------------------------------------------------------


@query("v17_cluster_composition", "SELECT site, cluster, n, round(n / sum(n) OVER (PARTITION BY site), 6) AS share FROM (SELECT lang AS site, source AS cluster, count(*) AS n FROM documents GROUP BY ALL)")
def cluster_composition(spark, d):
    counts = table(spark, d, "documents").groupBy(F.col("lang").alias("site"), F.col("source").alias("cluster")).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("site")), 6))


@query("b25_attribute_cross_tab", "SELECT lang, source AS rule, count(*) AS n, round(avg((quality = toxic)::INT), 6) AS wrong, count(*) FILTER (WHERE toxic = 1 AND quality = 1) AS fn, count(*) FILTER (WHERE toxic = 0 AND quality = 0) AS fp FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL AND toxic IS NOT NULL GROUP BY ALL")
def attribute_cross_tab(spark, d):
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").where("quality IS NOT NULL AND toxic IS NOT NULL")
    return rows.groupBy("lang", F.col("source").alias("rule")).agg(
        F.count("*").alias("n"),
        F.round(F.avg((F.col("quality") == F.col("toxic")).cast("int")), 6).alias("wrong"),
        F.count_if((F.col("toxic") == 1) & (F.col("quality") == 1)).alias("fn"),
        F.count_if((F.col("toxic") == 0) & (F.col("quality") == 0)).alias("fp"),
    )


@query("b30_crosswalk", "WITH m AS (SELECT l_orderkey, CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 END AS cls FROM lineitem) SELECT l_orderkey, max(cls) AS cls FROM m GROUP BY l_orderkey HAVING bool_and(cls IS NOT NULL)")
def crosswalk(spark, d):
    """An image with a category that maps to no class isn't in the ground truth."""
    cls = S.lookup(F.col("l_returnflag"), {"R": "1", "A": "0"}, F.lit(None).cast("string")).cast("int")
    return table(spark, d, "lineitem").select("l_orderkey", cls.alias("cls")).groupBy("l_orderkey").agg(F.max("cls").alias("cls"), F.bool_and(F.col("cls").isNotNull()).alias("ok")).where("ok").drop("ok")


@query("b31_sync_delta", "WITH a AS (SELECT doc_id, quality AS g FROM labels), b AS (SELECT doc_id, toxic AS g FROM labels WHERE doc_id % 3 <> 0) SELECT coalesce(CAST(a.g AS VARCHAR), 'none') AS before, coalesce(CAST(b.g AS VARCHAR), 'none') AS after, count(*) AS n FROM a JOIN b USING (doc_id) WHERE a.g IS DISTINCT FROM b.g GROUP BY ALL")
def sync_delta(spark, d):
    before = table(spark, d, "labels").select("doc_id", F.col("quality").alias("a"))
    after = table(spark, d, "labels").where("doc_id % 3 <> 0").select("doc_id", F.col("toxic").alias("b"))
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("none"))
    return before.join(after, "doc_id").where(~F.col("a").eqNullSafe(F.col("b"))).groupBy(name("a").alias("before"), name("b").alias("after")).agg(F.count("*").alias("n"))


@query("b34_bank_from_rows", "SELECT sentence, min(lang) AS cls FROM (SELECT lower(trim(substr(text, 1, 12))) AS sentence, lang FROM documents WHERE trim(substr(text, 1, 12)) <> '') GROUP BY sentence HAVING count(DISTINCT lang) = 1")
def bank_from_rows(spark, d):
    """Distinct sentences; those tagged with more than one class are left out."""
    rows = table(spark, d, "documents").select(F.lower(F.trim(F.substring("text", 1, 12))).alias("sentence"), "lang").where("sentence <> ''")
    return rows.groupBy("sentence").agg(F.min("lang").alias("cls"), F.max("lang").alias("other")).where("cls = other").drop("other")


@query("b35_bank_audit", "WITH b AS (SELECT doc_id, text, CASE doc_id % 3 WHEN 0 THEN text WHEN 1 THEN ' ' || text ELSE text || 'x' END AS other FROM documents) SELECT count(*) AS n, count(*) FILTER (WHERE text = other) AS equal, count(*) FILTER (WHERE text <> other AND trim(text) = trim(other)) AS blanks, count(*) FILTER (WHERE trim(text) <> trim(other)) AS different FROM b")
def bank_audit(spark, d):
    left = table(spark, d, "documents").select("doc_id", "text")
    place = F.col("doc_id") % 3
    right = left.select("doc_id", F.when(place == 0, F.col("text")).when(place == 1, F.concat(F.lit(" "), "text")).otherwise(F.concat("text", F.lit("x"))).alias("other"))
    same, alike = F.col("text") == F.col("other"), F.trim("text") == F.trim("other")
    return left.join(right, "doc_id").agg(F.count("*").alias("n"), F.count_if(same).alias("equal"), F.count_if(~same & alike).alias("blanks"), F.count_if(~alike).alias("different"))


@query(
    "b39_stratified_subsample",
    """WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('9' || doc_id), doc_id) AS k, count(*) OVER (PARTITION BY lang) AS n, count(*) OVER () AS total FROM documents)
    SELECT doc_id, lang FROM r WHERE k <= greatest(1, CAST(floor(120 * n / total) AS BIGINT))""",
)
def stratified_subsample(spark, d):
    """A seeded sample in proportion to the classes, one row of each at least."""
    docs = table(spark, d, "documents").select("doc_id", "lang")
    sizes = docs.groupBy("lang").agg(F.count("*").alias("n"))
    quota = sizes.withColumn("quota", F.greatest(F.lit(1), F.floor(120 * F.col("n") / F.sum("n").over(Window.partitionBy()))))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.md5(F.concat(F.lit("9"), F.col("doc_id").cast("string"))), "doc_id"))
    return docs.join(quota, "lang").withColumn("k", place).where(F.col("k") <= F.col("quota")).select("doc_id", "lang")


@query("b40_index_shift", "WITH f AS (SELECT vec_id AS gidx, vec_id + label * 1000 AS field, label FROM embeddings), s AS (SELECT label, min(field - gidx) AS shift FROM f GROUP BY label) SELECT label, shift, count(*) AS n FROM f JOIN s USING (label) WHERE field - shift = gidx GROUP BY ALL")
def index_shift(spark, d):
    """The offset of a block of places against the set's, taken back."""
    rows = table(spark, d, "embeddings").select(F.col("vec_id").alias("gidx"), (F.col("vec_id") + F.col("label") * 1000).alias("field"), "label")
    shift = rows.groupBy("label").agg(F.min(F.col("field") - F.col("gidx")).alias("shift"))
    return rows.join(shift, "label").where("field - shift = gidx").groupBy("label", "shift").agg(F.count("*").alias("n"))


@query("t2_rotating_budget", "WITH u AS (SELECT DISTINCT l_suppkey FROM lineitem), p AS (SELECT l_suppkey, row_number() OVER (ORDER BY l_suppkey) - 1 AS k, count(*) OVER () AS n FROM u) SELECT l_suppkey, ((k - 7) % n + n) % n AS place FROM p WHERE ((k - 7) % n + n) % n < 5")
def rotating_budget(spark, d):
    units = table(spark, d, "lineitem").select("l_suppkey").distinct()
    return O.rotating_budget(units, order="l_suppkey", offset=7, budget=5, count=units.count())


@query("h7_tree_listing", f"WITH {X.RAW_FILES}, n AS (SELECT unit || '/' || lang AS path, 2 AS depth, count(*) AS files FROM raw_files GROUP BY ALL UNION ALL SELECT unit, 1, count(*) FROM raw_files GROUP BY ALL) SELECT path, depth, files, row_number() OVER (ORDER BY path) AS sort_key FROM n")
def tree_listing(spark, d):
    """Folders with their files; the listing has a row for each folder, so one window orders it."""
    files = X.raw_files(spark, d)
    lower = files.groupBy(F.concat_ws("/", "unit", "lang").alias("path")).agg(F.count("*").alias("files")).withColumn("depth", F.lit(2))
    upper = files.groupBy(F.col("unit").alias("path")).agg(F.count("*").alias("files")).withColumn("depth", F.lit(1))
    return lower.unionAll(upper).select("path", "depth", "files", F.row_number().over(Window.orderBy("path")).alias("sort_key"))
