"""Filters, joins, aggregates, windows and merges of the catalog layer."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import relational as R
from millrace.operators.detection import numbered
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


long = lambda c: F.count(c).cast("long")

# --- scans and filters ----------------------------------------------------------


@query("s1_projected_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000")
def projected_scan(spark, d):
    return table(spark, d, "orders").where("o_orderstatus = 'F' AND o_totalprice > 100000").select("o_orderkey", "o_totalprice")


@query("f1_folder_filter", f"WITH {X.RAW_FILES} SELECT asset_id, raw_key FROM raw_files WHERE starts_with(raw_key, 'src1/')")
def folder_filter(spark, d):
    return X.raw_files(spark, d).where(R.under_folder(F.col("raw_key"), "src1")).select("asset_id", "raw_key")


@query("f2_status_default", f"WITH {X.RAW_FILES} SELECT asset_id FROM raw_files WHERE coalesce(status, 'pending') IN ('pending', 'failed')")
def status_default(spark, d):
    return X.raw_files(spark, d).where(R.with_default(F.col("status"), "pending").isin("pending", "failed")).select("asset_id")


@query("f3_nullable_enum", f"WITH {X.RAW_FILES} SELECT asset_id, status FROM raw_files WHERE status IS NULL OR status IN ('completed')")
def nullable_enum(spark, d):
    return X.raw_files(spark, d).where(R.null_or_in(F.col("status"), ["completed"])).select("asset_id", "status")


@query("f4_not_in_nullable", f"WITH {X.RAW_FILES} SELECT asset_id, status FROM raw_files WHERE status IS NULL OR status NOT IN ('failed', 'pending')")
def not_in_nullable(spark, d):
    return X.raw_files(spark, d).where(R.null_or_not_in(F.col("status"), ["failed", "pending"])).select("asset_id", "status")


@query("f5_ttl_predicate", "SELECT event_id FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00' - INTERVAL 90 MINUTE")
def ttl_predicate(spark, d):
    return table(spark, d, "events").where(R.older_than(F.col("ts"), F.lit("2024-01-15 00:00:00").cast("timestamp"), 90)).select("event_id")


@query("f6_stem_match", f"WITH {X.RAW_FILES} SELECT asset_id, regexp_extract(raw_key, '[^/]+$') AS name FROM raw_files WHERE starts_with(regexp_extract(raw_key, '[^/]+$'), '12.')")
def stem_match(spark, d):
    name = R.basename(F.col("raw_key"))
    return X.raw_files(spark, d).where(name.startswith("12.")).select("asset_id", name.alias("name"))


@query("f7_escaped_contains", "SELECT p_partkey FROM part WHERE contains(lower(p_name), lower('5'))")
def escaped_contains(spark, d):
    return table(spark, d, "part").where(R.contains_ignoring_case(F.col("p_name"), "5")).select("p_partkey")


@query("f8_exact_or_like", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT') OR o_orderpriority LIKE '5-%' OR o_orderpriority LIKE '%HIGH'")
def exact_or_like(spark, d):
    return table(spark, d, "orders").where(R.any_of(F.col("o_orderpriority"), ["1-URGENT"], ["5-%", "%HIGH"])).select("o_orderkey", "o_orderpriority")


@query(
    "f9_implied_requirement",
    """SELECT o_orderkey FROM orders o WHERE o_orderstatus <> 'F'
    OR EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')""",
)
def implied_requirement(spark, d):
    returned = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("returned", F.lit(True))
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus").join(returned, "o_orderkey", "left")
    return orders.where(R.implies(F.col("o_orderstatus") == "F", F.col("returned").isNotNull())).select("o_orderkey")


@query(
    "f18_class_thresholds",
    """SELECT event_id, event_type FROM events
    WHERE value >= CASE event_type WHEN 'click' THEN 60.0 WHEN 'view' THEN 20.0 ELSE 40.0 END""",
)
def class_thresholds(spark, d):
    limits = F.create_map(F.lit("click"), F.lit(60.0), F.lit("view"), F.lit(20.0))
    return table(spark, d, "events").where(F.col("value") >= F.coalesce(F.try_element_at(limits, F.col("event_type")), F.lit(40.0))).select("event_id", "event_type")


@query(
    "f21_incoming_validation",
    """SELECT doc_id, CASE WHEN n_chars = 0 THEN 'FAIL:empty' WHEN n_chars > 20000 THEN 'FAIL:too_large'
        WHEN length(source) > 5 THEN 'WARN:name' WHEN lang NOT IN ('en', 'de', 'fr', 'es') THEN 'WARN:lang' ELSE 'PASS' END AS verdict FROM documents""",
)
def incoming_validation(spark, d):
    verdict = (
        F.when(F.col("n_chars") == 0, "FAIL:empty").when(F.col("n_chars") > 20000, "FAIL:too_large").when(F.length("source") > 5, "WARN:name").when(~F.col("lang").isin("en", "de", "fr", "es"), "WARN:lang").otherwise("PASS")
    )
    return table(spark, d, "documents").select("doc_id", verdict.alias("verdict"))


@query("f22_source_purity", "SELECT source, count(DISTINCT lang)::BIGINT AS n_lang, count(DISTINCT lang) > 1 AS mixed FROM documents GROUP BY source")
def source_purity(spark, d):
    n = F.count_distinct("lang").cast("long")
    return table(spark, d, "documents").groupBy("source").agg(n.alias("n_lang"), (n > 1).alias("mixed"))


@query("f23_placeholder_text", "SELECT doc_id FROM documents WHERE regexp_matches(text, '(?i)lorem|licen[sc]ed under')")
def placeholder_text(spark, d):
    return table(spark, d, "documents").where(F.col("text").rlike("(?i)lorem|licen[sc]ed under")).select("doc_id")


# --- joins -------------------------------------------------------------------------


@query("j1_inner_join", "SELECT c_custkey, o_orderkey, o_totalprice FROM customer JOIN orders ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING'")
def inner_join(spark, d):
    customer = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey")
    return customer.join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", "o_orderkey", "o_totalprice")


@query(
    "j2_star_join",
    """SELECT r_name, n_name, count(*)::BIGINT AS n, sum(round(l_extendedprice * (1 - l_discount) * 100)::BIGINT)::BIGINT AS revenue_cents
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE l_returnflag = 'R' GROUP BY ALL""",
)
def star_join(spark, d):
    nation = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    supplier = table(spark, d, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "r_name", "n_name")
    lines = table(spark, d, "lineitem").where("l_returnflag = 'R'").select("l_suppkey", "l_extendedprice", "l_discount")
    joined = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return joined.groupBy("r_name", "n_name").agg(long("*").alias("n"), F.sum(F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")) * 100).cast("long")).alias("revenue_cents"))


@query("j3_left_join", "SELECT c_custkey, count(o_orderkey)::BIGINT AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'P' GROUP BY c_custkey")
def left_join(spark, d):
    pending = table(spark, d, "orders").where("o_orderstatus = 'P'").select("o_custkey", "o_orderkey")
    return table(spark, d, "customer").join(pending, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_custkey").agg(long("o_orderkey").alias("n"))


@query(
    "j4_bridge_self_join",
    """SELECT l_orderkey, l_linenumber, a.p_name AS src, b.p_name AS out FROM lineitem
    JOIN part a ON l_partkey = a.p_partkey JOIN part b ON l_partkey % 100 + 1 = b.p_partkey WHERE l_quantity > 45""",
)
def bridge_self_join(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_name")
    lines = table(spark, d, "lineitem").where("l_quantity > 45").select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_partkey") % 100 + 1).alias("other"))
    first = part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("src"))
    second = part.select(F.col("p_partkey").alias("other"), F.col("p_name").alias("out"))
    return lines.join(first, "l_partkey").join(second, "other").select("l_orderkey", "l_linenumber", "src", "out")


@query("j5_backlog_anti_join", "SELECT doc_id FROM documents WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)")
def backlog_anti_join(spark, d):
    return R.backlog(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), ["doc_id"])


@query(
    "j6_missing_either",
    """WITH a AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R'), b AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'A')
    SELECT o_orderkey, o_orderkey IN (SELECT * FROM a) AS has_r, o_orderkey IN (SELECT * FROM b) AS has_a FROM orders
    WHERE NOT (o_orderkey IN (SELECT * FROM a) AND o_orderkey IN (SELECT * FROM b))""",
)
def missing_either(spark, d):
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_returnflag")
    parts = {"r": lines.where("l_returnflag = 'R'"), "a": lines.where("l_returnflag = 'A'")}
    return R.missing_any(table(spark, d, "orders").select("o_orderkey"), parts, ["o_orderkey"])


@query("j7_semi_join_gate", f"WITH {X.RAW_FILES}, {X.LABEL_ROWS} SELECT asset_id FROM raw_files WHERE asset_id IN (SELECT asset_id FROM label_rows WHERE review_status = 'finalized')")
def semi_join_gate(spark, d):
    return R.having(X.raw_files(spark, d).select("asset_id"), X.label_rows(spark, d).where("review_status = 'finalized'"), ["asset_id"])


@query(
    "j8_nested_exists",
    """SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    WHERE o_custkey = c_custkey AND l_returnflag = 'R' AND l_quantity >= 49)""",
)
def nested_exists(spark, d):
    lines = table(spark, d, "lineitem").where("l_returnflag = 'R' AND l_quantity >= 49").select(F.col("l_orderkey").alias("o_orderkey"))
    buyers = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey")).join(lines, "o_orderkey", "left_semi")
    return R.having(table(spark, d, "customer").select("c_custkey"), buyers, ["c_custkey"])


@query("j9_all_terminal", f"WITH {X.JOBS} SELECT batch FROM jobs GROUP BY batch HAVING count(*) > 0 AND count(*) FILTER (status = 'open') = 0")
def all_terminal(spark, d):
    return X.jobs(spark, d).groupBy("batch").agg(F.count_if(F.col("status") == "open").alias("open")).where("open = 0").select("batch")


@query("j12_near_duplicate_pairs", "SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id WHERE 1 - list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) < 0.3")
def near_duplicate_pairs(spark, d):
    from millrace.operators.vector_search import blocked_pairs

    emb = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    return blocked_pairs(emb, emb, 0.7).where("a < b").select("a", "b")


@query(
    "j14_interval_overlap",
    f"""WITH {X.EVENT_SPANS}, clips AS (SELECT asset_id, k AS clip, k * 86400.0 AS clip_start, (k + 1) * 86400.0 + 3600 AS clip_end
        FROM (SELECT DISTINCT asset_id FROM spans), range(0, 30) t(k))
    SELECT event_id, clip FROM spans JOIN clips USING (asset_id) WHERE end_sec > clip_start AND start_sec < clip_end""",
)
def interval_overlap(spark, d):
    from millrace.operators.intervals import overlapping

    spans = X.event_spans(spark, d)
    clips = spans.select("asset_id").distinct().select("asset_id", F.explode(F.sequence(F.lit(0), F.lit(29))).alias("clip"))
    clips = clips.select("asset_id", F.col("clip").cast("long").alias("clip"), (F.col("clip") * 86400.0).alias("clip_start"), ((F.col("clip") + 1) * 86400.0 + 3600).alias("clip_end"))
    return overlapping(spans, clips, "asset_id", ("start_sec", "end_sec"), ("clip_start", "clip_end"), 86400.0).select("event_id", "clip")


@query("j15_stem_join", f"WITH {X.RAW_FILES} SELECT asset_id, toxic FROM raw_files JOIN labels ON regexp_replace(regexp_extract(raw_key, '[^/]+$'), '\\.[^.]*$', '') = labels.doc_id::VARCHAR")
def stem_join(spark, d):
    files = X.raw_files(spark, d).select("asset_id", R.stem(F.col("raw_key")).alias("stem"))
    return files.join(table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("stem"), "toxic"), "stem").select("asset_id", "toxic")


@query(
    "j16_fallback_join",
    """SELECT c_custkey, coalesce(o.p, n.n_name, r.r_name) AS hit, CASE WHEN o.p IS NOT NULL THEN 0 WHEN n.n_name IS NOT NULL THEN 1 ELSE 2 END AS tier
    FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderpriority) AS p FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) o ON o_custkey = c_custkey
    LEFT JOIN nation n ON n_nationkey = c_nationkey AND n_nationkey % 2 = 0
    LEFT JOIN nation m ON m.n_nationkey = c_nationkey LEFT JOIN region r ON r_regionkey = m.n_regionkey""",
)
def fallback_join(spark, d):
    customer = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, d, "nation")
    own = table(spark, d, "orders").where("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderpriority").alias("hit"))
    by_nation = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    second = by_nation.where("n_nationkey % 2 = 0").select("c_custkey", F.col("n_name").alias("hit"))
    third = by_nation.join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("c_custkey", F.col("r_name").alias("hit"))
    return R.first_match(customer.select("c_custkey"), "c_custkey", [own, second, third], "hit")


@query(
    "j17_delete_twins",
    f"""WITH {X.LABEL_ROWS} SELECT label_id, asset_id, review_status FROM label_rows l WHERE review_status = 'finalized'
    OR NOT EXISTS (SELECT 1 FROM label_rows t WHERE t.asset_id = l.asset_id AND t.review_status = 'finalized')""",
)
def delete_twins(spark, d):
    rows = X.label_rows(spark, d).select("label_id", "asset_id", "review_status")
    return R.without_twins(rows, ["asset_id"], F.col("review_status") == "finalized")


@query("j20_scalar_subquery", "SELECT event_id, user_id FROM events WHERE ts::DATE = (SELECT max(ts)::DATE FROM events)")
def scalar_subquery(spark, d):
    events = table(spark, d, "events")
    latest = events.agg(F.max(F.to_date("ts")).alias("day"))
    return events.withColumn("day", F.to_date("ts")).join(F.broadcast(latest), "day", "left_semi").select("event_id", "user_id")


@query("j21_orphan_scan", "SELECT 'labels.doc_id' AS fk, count(*)::BIGINT AS n FROM labels WHERE doc_id IS NOT NULL AND doc_id NOT IN (SELECT item_id FROM benchmark) UNION ALL SELECT 'lineitem.l_orderkey', count(*)::BIGINT FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)")
def orphan_scan(spark, d):
    checks = [("labels.doc_id", "labels", "doc_id", "benchmark", "item_id"), ("lineitem.l_orderkey", "lineitem", "l_orderkey", "orders", "o_orderkey")]
    counts = [R.orphans(table(spark, d, c), table(spark, d, p), k, pk).agg(F.lit(fk).alias("fk"), long("*").alias("n")) for fk, c, k, p, pk in checks]
    return counts[0].unionAll(counts[1])


@query(
    "j24_as_of_join",
    """WITH v AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'view'), p AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'purchase')
    SELECT p.event_id, v.event_id AS last_view FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.ts""",
)
def as_of_join(spark, d):
    from millrace.operators.intervals import latest_before

    events = table(spark, d, "events").where("event_type IN ('view', 'purchase')")
    return latest_before(events, "user_id", ["ts"], F.col("event_type") == "view", F.col("event_id"), "last_view").where("event_type = 'purchase'").select("event_id", "last_view")


# --- aggregates ------------------------------------------------------------------------


@query("g1_count_by_keys", "SELECT l_returnflag, l_linestatus, count(*)::BIGINT AS n FROM lineitem GROUP BY ALL")
def count_by_keys(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(long("*").alias("n"))


@query("g2_count_by_derived_key", f"WITH {X.RAW_FILES} SELECT split_part(raw_key, '/', 1) AS folder, count(*)::BIGINT AS n FROM raw_files GROUP BY 1")
def count_by_derived_key(spark, d):
    return X.raw_files(spark, d).groupBy(F.split_part("raw_key", F.lit("/"), F.lit(1)).alias("folder")).agg(long("*").alias("n"))


@query(
    "g3_conditional_distinct_having",
    f"""WITH {X.RAW_FILES} SELECT unit, count(DISTINCT CASE WHEN lang = 'en' THEN checksum END)::BIGINT AS n_en, count(DISTINCT CASE WHEN lang = 'de' THEN checksum END)::BIGINT AS n_de
    FROM raw_files GROUP BY unit HAVING n_en > 20 OR n_de > 20""",
)
def conditional_distinct(spark, d):
    counted = X.raw_files(spark, d).groupBy("unit").agg(*(F.count_distinct(F.when(F.col("lang") == x, F.col("checksum"))).cast("long").alias(f"n_{x}") for x in ("en", "de")))
    return counted.where("n_en > 20 OR n_de > 20")


@query(
    "g4_status_rollup",
    f"""WITH {X.JOBS}, c AS (SELECT batch, count(*) FILTER (status = 'done') AS n_done, count(*) FILTER (status = 'failed') AS n_failed, count(*) AS n_total FROM jobs GROUP BY batch)
    SELECT batch, n_done::BIGINT AS n_done, n_failed::BIGINT AS n_failed, n_total::BIGINT AS n_total,
        CASE WHEN n_total = 0 THEN 'pending' WHEN n_done + n_failed < n_total THEN CASE WHEN n_done + n_failed > 0 THEN 'running' ELSE 'pending' END
            WHEN n_failed = 0 THEN 'succeeded' WHEN n_done = 0 THEN 'failed' ELSE 'partial_success' END AS state FROM c""",
)
def status_rollup(spark, d):
    done, failed = F.count_if(F.col("status") == "done"), F.count_if(F.col("status") == "failed")
    counted = X.jobs(spark, d).groupBy("batch").agg(done.alias("n_done"), failed.alias("n_failed"), long("*").alias("n_total"))
    return counted.withColumn("state", R.job_status(F.col("n_done"), F.col("n_failed"), F.col("n_total")))


@query("g5_cost_summary", f"WITH {X.JOBS} SELECT engine, count(*) FILTER (status = 'done')::BIGINT AS n_done, count(*) FILTER (status = 'failed')::BIGINT AS n_failed, round(coalesce(sum(cost), 0), 2) AS cost, count(DISTINCT batch)::BIGINT AS batches FROM jobs GROUP BY engine")
def cost_summary(spark, d):
    return X.jobs(spark, d).groupBy("engine").agg(
        F.count_if(F.col("status") == "done").alias("n_done"),
        F.count_if(F.col("status") == "failed").alias("n_failed"),
        F.round(F.coalesce(F.sum("cost"), F.lit(0.0)), 2).alias("cost"),
        F.count_distinct("batch").cast("long").alias("batches"),
    )


@query("g6_defined_any_value", "SELECT o_custkey, arg_min(o_orderpriority, (o_orderdate, o_orderkey)) AS first_priority FROM orders GROUP BY o_custkey")
def defined_any_value(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.min_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("first_priority"))


@query("g7_distinct_list", "SELECT l_orderkey, array_to_string(list_sort(list(DISTINCT l_returnflag)), ',') AS flags FROM lineitem GROUP BY l_orderkey")
def distinct_list(spark, d):
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.sort_array(F.collect_set("l_returnflag")), ",").alias("flags"))


@query("g8_ordered_fingerprint", "SELECT o_custkey, md5(string_agg(o_orderkey::VARCHAR || ':' || o_orderstatus, '|' ORDER BY o_orderkey)) AS fingerprint FROM orders GROUP BY o_custkey")
def ordered_fingerprint(spark, d):
    items = F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderstatus")))
    text = F.array_join(F.transform(items, lambda x: F.concat_ws(":", x["o_orderkey"], x["o_orderstatus"])), "|")
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.md5(text).alias("fingerprint"))


@query("g9_completeness_having", "SELECT source FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source HAVING count(*) = count(quality) AND count(*) > 0 UNION ALL SELECT lang FROM documents LEFT JOIN labels USING (doc_id) WHERE doc_id IN (SELECT doc_id FROM labels) GROUP BY lang HAVING count(*) = count(quality)")
def completeness_having(spark, d):
    joined = table(spark, d, "documents").select("doc_id", "source", "lang").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    complete = lambda f, key: f.groupBy(key).agg(F.count("*").alias("n"), F.count("quality").alias("q")).where("n = q AND n > 0").select(F.col(key).alias("source"))
    return complete(joined, "source").unionAll(complete(joined.where("quality IS NOT NULL"), "lang"))


@query("g12_cross_tab", "SELECT lang, count(*) FILTER (toxic = 0)::BIGINT AS t0, count(*) FILTER (toxic = 1)::BIGINT AS t1 FROM documents JOIN labels USING (doc_id) GROUP BY lang")
def cross_tab(spark, d):
    joined = table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id")
    return joined.groupBy("lang").agg(*(F.count_if(F.col("toxic") == t).alias(f"t{t}") for t in (0, 1)))


@query(
    "g13_daily_gap_filled",
    """WITH days AS (SELECT (DATE '2024-01-20' + i::INT)::DATE AS day FROM range(0, 14) t(i))
    SELECT strftime(day, '%Y-%m-%d') AS day, count(event_id)::BIGINT AS n FROM days LEFT JOIN events ON ts::DATE = day AND event_type = 'purchase' GROUP BY day""",
)
def daily_gap_filled(spark, d):
    days = spark.range(1).select(F.explode(F.expr("sequence(DATE '2024-01-20', DATE '2024-02-02')")).alias("day"))
    daily = table(spark, d, "events").where("event_type = 'purchase'").groupBy(F.to_date("ts").alias("day")).agg(long("*").alias("n"))
    return days.join(daily, "day", "left").select(F.date_format("day", "yyyy-MM-dd").alias("day"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))


@query(
    "g14_worker_dashboard",
    """SELECT user_id, count(DISTINCT event_type)::BIGINT AS kinds, count(*)::BIGINT AS n, count(DISTINCT ts::DATE)::BIGINT AS days, round(sum(value), 4) AS total, round(avg(value), 4) AS mean,
        count(*) FILTER (event_type = 'error')::BIGINT AS errors, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last FROM events GROUP BY user_id""",
)
def worker_dashboard(spark, d):
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return table(spark, d, "events").groupBy("user_id").agg(
        F.count_distinct("event_type").cast("long").alias("kinds"),
        long("*").alias("n"),
        F.count_distinct(F.to_date("ts")).cast("long").alias("days"),
        F.round(F.sum("value"), 4).alias("total"),
        F.round(F.avg("value"), 4).alias("mean"),
        F.count_if(F.col("event_type") == "error").alias("errors"),
        stamp(F.min("ts")).alias("first"),
        stamp(F.max("ts")).alias("last"),
    )


@query(
    "g15_guarded_ratios",
    """SELECT user_id, CASE WHEN count(*) FILTER (event_type = 'view') > 0 THEN round(100.0 * count(*) FILTER (event_type = 'click') / count(*) FILTER (event_type = 'view'), 4) ELSE 0.0 END AS rate,
        round(count(*) / count(DISTINCT ts::DATE), 4) AS per_day FROM events GROUP BY user_id""",
)
def guarded_ratios(spark, d):
    views, clicks = (F.count_if(F.col("event_type") == t) for t in ("view", "click"))
    rate = F.when(views > 0, F.round(100.0 * clicks / views, 4)).otherwise(0.0)
    return table(spark, d, "events").groupBy("user_id").agg(rate.alias("rate"), F.round(F.count("*") / F.count_distinct(F.to_date("ts")), 4).alias("per_day"))


@query("g17_task_counters", "SELECT conv_id, count(*) FILTER (role <> 'system')::BIGINT AS annotations, count(*) FILTER (text IS NULL OR text = '')::BIGINT AS cancelled, count(DISTINCT role)::BIGINT AS roles FROM conversations GROUP BY conv_id")
def task_counters(spark, d):
    return table(spark, d, "conversations").groupBy("conv_id").agg(
        F.count_if(F.col("role") != "system").alias("annotations"), F.count_if(F.col("text").isNull() | (F.col("text") == "")).alias("cancelled"), F.count_distinct("role").cast("long").alias("roles")
    )


@query("g18_is_labeled", "SELECT conv_id, count(DISTINCT role) >= 2 AS is_labeled FROM conversations GROUP BY conv_id")
def is_labeled(spark, d):
    return table(spark, d, "conversations").groupBy("conv_id").agg((F.count_distinct("role") >= 2).alias("is_labeled"))


@query(
    "g23_usage_from_json",
    "SELECT strftime(ts::DATE, '%Y-%m-%d') AS day, sum(coalesce(TRY_CAST(json_extract_string(CASE WHEN json_valid(props) THEN props END, '$.k') AS BIGINT), 0))::BIGINT AS used FROM events GROUP BY 1",
)
def usage_from_json(spark, d):
    used = F.coalesce(F.get_json_object("props", "$.k").try_cast("long"), F.lit(0))
    return table(spark, d, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.sum(used).alias("used"))


@query(
    "g24_percentiles",
    """SELECT event_type, round(quantile_cont(value, 0.1), 6) AS p10, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.9), 6) AS p90,
        round(list_sort(list(value))[(floor((count(*) - 1) * 0.95))::BIGINT + 1], 6) AS p95_low FROM events GROUP BY event_type""",
)
def percentiles(spark, d):
    # the lower-index rule on exact order statistics: a counted histogram of values, no list of rows
    values = table(spark, d, "events").groupBy("event_type", "value").agg(F.count("*").alias("n"))
    order = Window.partitionBy("event_type").orderBy("value")
    ranked = values.withColumn("upto", F.sum("n").over(order)).withColumn("all", F.sum("n").over(Window.partitionBy("event_type")))
    at = F.floor((F.col("all") - 1) * F.lit(0.95)) + 1
    low = ranked.where((F.col("upto") >= at) & (F.col("upto") - F.col("n") < at)).select("event_type", F.round("value", 6).alias("p95_low"))
    linear = table(spark, d, "events").groupBy("event_type").agg(*(F.round(F.percentile("value", p), 6).alias(f"p{round(100 * p)}") for p in (0.1, 0.5, 0.9)))
    return linear.join(low, "event_type")


@query("g25_bincount", "SELECT l_suppkey % 10 AS bin, count(*)::BIGINT AS n FROM lineitem GROUP BY 1")
def bincount(spark, d):
    return table(spark, d, "lineitem").groupBy((F.col("l_suppkey") % 10).alias("bin")).agg(long("*").alias("n"))


@query(
    "g26_folder_statistics",
    "SELECT len(string_split(url, '/'))::BIGINT AS depth, CASE WHEN regexp_matches(url, '\\.html') THEN 'html' ELSE '' END AS ext, count(*)::BIGINT AS n, sum(length(html))::BIGINT AS size FROM pages GROUP BY 1, 2",
)
def folder_statistics(spark, d):
    depth = F.size(F.split("url", "/")).cast("long")
    ext = F.when(F.col("url").rlike(r"\.html"), "html").otherwise("")
    return table(spark, d, "pages").groupBy(depth.alias("depth"), ext.alias("ext")).agg(long("*").alias("n"), F.sum(F.length("html")).cast("long").alias("size"))


@query(
    "g28_multiset_merge",
    """WITH c AS (SELECT l_orderkey, l_linestatus, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL), m AS (SELECT l_orderkey, l_returnflag, max(n) AS n FROM c GROUP BY ALL)
    SELECT l_orderkey, string_agg(repeat(l_returnflag, n::INT), '' ORDER BY l_returnflag) AS marks FROM m GROUP BY l_orderkey""",
)
def multiset_merge(spark, d):
    counted = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linestatus", "l_returnflag").agg(F.count("*").alias("n"))
    most = counted.groupBy("l_orderkey", "l_returnflag").agg(F.max("n").cast("int").alias("n"))
    marks = F.transform(F.array_sort(F.collect_list(F.struct("l_returnflag", "n"))), lambda x: F.repeat(x["l_returnflag"], x["n"]))
    return most.groupBy("l_orderkey").agg(F.array_join(marks, "").alias("marks"))


@query(
    "g29_class_split_counts",
    """SELECT category, count(*) FILTER (s = 0)::BIGINT AS train, count(*) FILTER (s = 1)::BIGINT AS val, count(*) FILTER (s = 2)::BIGINT AS test, count(*)::BIGINT AS total, min(n) >= 1 AS ok
    FROM (SELECT l_returnflag AS category, l_orderkey % 3 AS s, count(*) OVER (PARTITION BY l_returnflag, l_orderkey % 3) AS n FROM lineitem) GROUP BY category""",
)
def class_split_counts(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("category"), (F.col("l_orderkey") % 3).alias("s"))
    counts = [F.count_if(F.col("s") == i) for i in range(3)]
    named = [c.alias(n) for c, n in zip(counts, ("train", "val", "test"), strict=True)]
    return rows.groupBy("category").agg(*named, long("*").alias("total"), (F.least(*(F.when(c > 0, c) for c in counts)) >= 1).alias("ok"))


@query("g30_status_counts", f"WITH {X.RAW_FILES} SELECT coalesce(status, 'none') AS status, count(*)::BIGINT AS n FROM raw_files GROUP BY 1")
def status_counts(spark, d):
    return X.raw_files(spark, d).groupBy(R.with_default(F.col("status"), "none").alias("status")).agg(long("*").alias("n"))


# --- windows, ranking, limits ------------------------------------------------------------


@query("w1_latest_per_key", "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def latest_per_key(spark, d):
    return R.first_per_key(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_custkey", "o_orderkey")


@query(
    "w2_cap_per_group",
    f"WITH {X.RAW_FILES}, r AS (SELECT asset_id, unit, size FROM raw_files QUALIFY row_number() OVER (PARTITION BY unit ORDER BY size DESC, asset_id) <= 3) SELECT * FROM r ORDER BY size DESC, asset_id LIMIT 40",
)
def cap_per_group(spark, d):
    return R.cap_per_group(X.raw_files(spark, d).select("asset_id", "unit", "size"), ["unit"], [F.desc("size"), F.asc("asset_id")], 3, 40, [F.desc("size"), F.asc("asset_id")])


@query("w3_distinct_on", f"WITH {X.RAW_FILES} SELECT DISTINCT ON (unit) unit, asset_id, status FROM raw_files ORDER BY unit, status NULLS LAST, asset_id")
def distinct_on(spark, d):
    return R.first_per_key(X.raw_files(spark, d).select("unit", "asset_id", "status"), ["unit"], [F.asc_nulls_last("status"), F.asc("asset_id")])


@query("w5_supersede_older", "SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC) > 1 AS superseded FROM conversations")
def supersede_older(spark, d):
    rank = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.desc("turn"), F.desc("role")))
    return table(spark, d, "conversations").select("conv_id", "turn", (rank > 1).alias("superseded"))


@query(
    "w6_supersede_by_signature",
    f"""WITH {X.RAW_FILES}, m AS (SELECT checksum, unit, max(asset_id) AS newest FROM raw_files GROUP BY ALL),
    k AS (SELECT checksum, unit FROM m QUALIFY row_number() OVER (PARTITION BY checksum ORDER BY newest DESC, unit) = 1)
    SELECT asset_id FROM raw_files JOIN k USING (checksum, unit)""",
)
def supersede_by_signature(spark, d):
    files = X.raw_files(spark, d).select("asset_id", "checksum", "unit")
    newest = files.groupBy("checksum", "unit").agg(F.max("asset_id").alias("newest"))
    best = newest.groupBy("checksum").agg(F.min_by("unit", F.struct(-F.col("newest"), "unit")).alias("unit"))
    return files.join(best, ["checksum", "unit"], "left_semi").select("asset_id")


@query(
    "w7_neighbour_gaps",
    f"""WITH {X.EVENT_SPANS} SELECT event_id, round(start_sec - lag(end_sec) OVER w, 4) AS gap_before, round(lead(start_sec) OVER w - end_sec, 4) AS gap_after
    FROM spans WINDOW w AS (PARTITION BY asset_id ORDER BY start_sec, end_sec, event_id)""",
)
def neighbour_gaps(spark, d):
    w = Window.partitionBy("asset_id").orderBy("start_sec", "end_sec", "event_id")
    return X.event_spans(spark, d).select("event_id", F.round(F.col("start_sec") - F.lag("end_sec").over(w), 4).alias("gap_before"), F.round(F.lead("start_sec").over(w) - F.col("end_sec"), 4).alias("gap_after"))


@query("w9_natural_order_key", "SELECT c_custkey, array_to_string(list_transform(regexp_extract_all(c_name, '\\d+|\\D+'), lambda p: CASE WHEN regexp_matches(p, '^\\d') THEN lpad(p, 10, '0') ELSE p END), '') AS key FROM customer")
def natural_order_key(spark, d):
    return table(spark, d, "customer").select("c_custkey", R.natural_key(F.col("c_name")).alias("key"))


@query("w11_nulls_last_order", f"WITH {X.RAW_FILES} SELECT asset_id, status, row_number() OVER (ORDER BY status NULLS LAST, asset_id) AS place FROM raw_files")
def nulls_last_order(spark, d):
    # statuses are lower-case words, after which this stands
    rows = X.raw_files(spark, d).select("asset_id", "status", F.coalesce("status", F.lit("~")).alias("lead"))
    return numbered(rows, ["lead", "asset_id"], "place").drop("lead")


@query("w12_enum_order", "SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS place, row_number() OVER (ORDER BY CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, o_orderkey) AS rank FROM orders")
def enum_order(spark, d):
    place = F.when(F.col("o_orderstatus") == "P", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    return numbered(table(spark, d, "orders").select("o_orderkey", place.alias("place")), ["place", "o_orderkey"], "rank")


@query("w13_sorted_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def sorted_limit(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query(
    "w14_priority_then_fill",
    """WITH u AS (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderkey % 50 = 0),
    r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS k FROM orders WHERE NOT (o_orderpriority = '1-URGENT' AND o_orderkey % 50 = 0))
    SELECT o_orderkey FROM u UNION ALL SELECT o_orderkey FROM r WHERE k <= 200 - (SELECT count(*) FROM u)""",
)
def priority_then_fill(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    urgent = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderkey") % 50 == 0)
    return R.prioritised(orders, urgent, 200, [F.asc("o_orderkey")]).select("o_orderkey")


@query("w18_round_robin", "SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents) ORDER BY k, source LIMIT 64")
def round_robin(spark, d):
    return R.round_robin(table(spark, d, "documents").select("doc_id", "source"), "source", [F.asc("doc_id")], 64).select("doc_id", "source")


@query("w19_seeded_sample", "SELECT doc_id FROM documents ORDER BY sha256('51:' || doc_id), doc_id LIMIT 100")
def seeded_sample(spark, d):
    return R.hash_sample(table(spark, d, "documents").select("doc_id"), "doc_id", "51", 100)


@query(
    "w23_ranking_ladder",
    "SELECT l_orderkey, max(CASE WHEN k = 1 THEN l_partkey END) AS first, coalesce(max(CASE WHEN k = 2 THEN l_partkey END), -1) AS second FROM (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber, l_partkey) AS k FROM lineitem) WHERE k <= 2 GROUP BY l_orderkey",
)
def ranking_ladder(spark, d):
    rank = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(F.desc("l_extendedprice"), "l_linenumber", "l_partkey"))
    top = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", rank.alias("k")).where("k <= 2")
    pick = lambda k: F.max(F.when(F.col("k") == k, F.col("l_partkey")))
    return top.groupBy("l_orderkey").agg(pick(1).alias("first"), F.coalesce(pick(2), F.lit(-1)).cast("long").alias("second"))


# --- sets and merges --------------------------------------------------------------------


@query(
    "u1_long_union",
    """SELECT 'caption' AS kind, doc_id, NULL::DOUBLE AS start_sec, lang AS label FROM documents WHERE trim(lang) <> ''
    UNION ALL SELECT 'timestamp', event_id, value, NULL FROM events WHERE value IS NOT NULL UNION ALL SELECT 'label', doc_id, NULL, toxic::VARCHAR FROM labels""",
)
def long_union(spark, d):
    captions = table(spark, d, "documents").where("trim(lang) <> ''").select(F.lit("caption").alias("kind"), "doc_id", F.col("lang").alias("label"))
    stamps = table(spark, d, "events").where("value IS NOT NULL").select(F.lit("timestamp").alias("kind"), F.col("event_id").alias("doc_id"), F.col("value").alias("start_sec"))
    labels = table(spark, d, "labels").select(F.lit("label").alias("kind"), "doc_id", F.col("toxic").cast("string").alias("label"))
    return captions.unionByName(stamps, allowMissingColumns=True).unionByName(labels, allowMissingColumns=True).select("kind", "doc_id", "start_sec", "label")


@query("u4_state_token", "SELECT (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))::BIGINT AS backlog, (SELECT max(doc_id) FROM labels) || ':' || (SELECT count(*) FROM labels) AS token")
def state_token(spark, d):
    labels = table(spark, d, "labels")
    waiting = R.backlog(table(spark, d, "documents").select("doc_id"), labels, ["doc_id"]).agg(long("*").alias("backlog"))
    return waiting.crossJoin(labels.agg(F.concat_ws(":", F.max("doc_id"), F.count("*")).alias("token")))


@query("u5_incumbent_minus_new", f"WITH {X.LABEL_ROWS} SELECT DISTINCT asset_id FROM label_rows WHERE review_status = 'auto_generated' EXCEPT SELECT asset_id FROM label_rows WHERE review_status = 'finalized'")
def incumbent_minus_new(spark, d):
    rows = X.label_rows(spark, d)
    return rows.where("review_status = 'auto_generated'").select("asset_id").subtract(rows.where("review_status = 'finalized'").select("asset_id"))


_UPSERT = """WITH base AS (SELECT o_orderkey AS k, o_orderstatus AS status, o_totalprice AS price FROM orders WHERE o_orderkey % 3 <> 0),
    new AS (SELECT o_orderkey AS k, 'X' AS status, o_totalprice * 2 AS price FROM orders WHERE o_orderkey % 2 = 0)"""


def _base_and_new(spark, d):
    orders = table(spark, d, "orders")
    base = orders.where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    new = orders.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("k"), F.lit("X").alias("status"), (F.col("o_totalprice") * 2).alias("price"))
    return base, new


@query("u7_upsert", _UPSERT + " SELECT * FROM new UNION ALL SELECT * FROM base WHERE k NOT IN (SELECT k FROM new)")
def upsert(spark, d):
    return R.upsert(*_base_and_new(spark, d), ["k"])


@query(
    "u8_guarded_upsert",
    _UPSERT + " SELECT * FROM base WHERE status = 'F' OR k NOT IN (SELECT k FROM new) UNION ALL SELECT * FROM new WHERE k NOT IN (SELECT k FROM base WHERE status = 'F')",
)
def guarded_upsert(spark, d):
    return R.upsert(*_base_and_new(spark, d), ["k"], F.col("status") == "F")


@query("u9_insert_or_ignore", _UPSERT + " SELECT * FROM base UNION ALL SELECT * FROM new WHERE k NOT IN (SELECT k FROM base)")
def insert_or_ignore(spark, d):
    return R.insert_or_ignore(*_base_and_new(spark, d), ["k"], [F.asc("price")])


_SCOPE = """WITH base AS (SELECT l_orderkey AS scope, l_linenumber AS seq, l_returnflag AS status FROM lineitem),
    new AS (SELECT o_orderkey AS scope, 99 AS seq, 'Z' AS status FROM orders WHERE o_orderkey % 4 = 0)"""


def _scoped(spark, d):
    base = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("scope"), F.col("l_linenumber").alias("seq"), F.col("l_returnflag").alias("status"))
    new = table(spark, d, "orders").where("o_orderkey % 4 = 0").select(F.col("o_orderkey").alias("scope"), F.lit(99).alias("seq"), F.lit("Z").alias("status"))
    return base, new


@query("u10_replace_scope", _SCOPE + " SELECT * FROM base WHERE status <> 'N' OR scope NOT IN (SELECT scope FROM new) UNION ALL SELECT * FROM new")
def replace_scope(spark, d):
    return R.replace_scope(*_scoped(spark, d), ["scope"], F.col("status") == "N")


@query(
    "u11_replace_unless_final",
    _SCOPE + ", ok AS (SELECT * FROM new WHERE scope NOT IN (SELECT scope FROM base WHERE status = 'A')) SELECT * FROM base WHERE scope NOT IN (SELECT scope FROM ok) UNION ALL SELECT * FROM ok",
)
def replace_unless_final(spark, d):
    return R.replace_scope(*_scoped(spark, d), ["scope"], F.lit(True), F.col("status") == "A")


@query(
    "u13_cascade_delete",
    """WITH gone AS (SELECT c_custkey FROM customer WHERE c_acctbal < 0), o AS (SELECT * FROM orders WHERE o_custkey NOT IN (SELECT * FROM gone))
    SELECT 'orders' AS name, count(*)::BIGINT AS kept FROM o UNION ALL SELECT 'lineitem', count(*)::BIGINT FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM o)""",
)
def cascade_delete(spark, d):
    gone = table(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey").join(gone, "o_custkey", "left_anti")
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).join(orders, "o_orderkey", "left_semi")
    return orders.agg(F.lit("orders").alias("name"), long("*").alias("kept")).unionAll(lines.agg(F.lit("lineitem").alias("name"), long("*").alias("kept")))


@query("u15_stale_reap", "SELECT event_id, CASE WHEN event_type = 'view' AND ts < TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 60 MINUTE THEN 'failed' ELSE event_type END AS status FROM events")
def stale_reap(spark, d):
    stale = (F.col("event_type") == "view") & R.older_than(F.col("ts"), F.lit("2024-01-20 00:00:00").cast("timestamp"), 60)
    return table(spark, d, "events").select("event_id", F.when(stale, "failed").otherwise(F.col("event_type")).alias("status"))


@query(
    "u20_duplicate_keepers",
    f"""WITH {X.RAW_FILES} SELECT asset_id, row_number() OVER (PARTITION BY checksum ORDER BY (status = 'completed') DESC NULLS LAST, size, asset_id) = 1 AS keeper
    FROM raw_files QUALIFY count(*) OVER (PARTITION BY checksum) > 1""",
)
def duplicate_keepers(spark, d):
    files = X.raw_files(spark, d).select("asset_id", "checksum", "status", "size")
    return R.duplicate_keepers(files, ["checksum"], [F.desc_nulls_last(F.col("status") == "completed"), F.asc("size"), F.asc("asset_id")]).select("asset_id", "keeper")


# --- exact deduplication -------------------------------------------------------------------


@query("d1_first_of_checksum", f"WITH {X.RAW_FILES} SELECT min(asset_id) AS asset_id, count(*)::BIGINT AS copies FROM raw_files GROUP BY checksum")
def first_of_checksum(spark, d):
    return X.raw_files(spark, d).groupBy("checksum").agg(F.min("asset_id").alias("asset_id"), long("*").alias("copies")).select("asset_id", "copies")


@query("d2_duplicate_map", f"WITH {X.RAW_FILES} SELECT min(asset_id) AS asset_id, string_agg(raw_key, ',' ORDER BY raw_key) AS names FROM raw_files GROUP BY checksum HAVING count(*) > 1")
def duplicate_map(spark, d):
    grouped = X.raw_files(spark, d).groupBy("checksum").agg(F.min("asset_id").alias("asset_id"), F.array_join(F.array_sort(F.collect_list("raw_key")), ",").alias("names"), F.count("*").alias("n"))
    return grouped.where("n > 1").select("asset_id", "names")


@query(
    "d9_oldest_by_checksum",
    f"""WITH {X.RAW_FILES}, m AS (SELECT checksum, min(asset_id) AS m1 FROM raw_files GROUP BY checksum),
    n AS (SELECT checksum, min(asset_id) AS m2 FROM raw_files JOIN m USING (checksum) WHERE asset_id > m1 GROUP BY checksum)
    SELECT asset_id, CASE WHEN asset_id = m1 THEN m2 ELSE m1 END AS oldest_other FROM raw_files JOIN m USING (checksum) LEFT JOIN n USING (checksum)""",
)
def oldest_by_checksum(spark, d):
    """The oldest other file with the same bytes, for each file."""
    files = X.raw_files(spark, d).select("asset_id", "checksum")
    first = files.groupBy("checksum").agg(F.min("asset_id").alias("m1"))
    second = files.join(first, "checksum").where("asset_id > m1").groupBy("checksum").agg(F.min("asset_id").alias("m2"))
    other = F.when(F.col("asset_id") == F.col("m1"), F.col("m2")).otherwise(F.col("m1"))
    return files.join(first, "checksum").join(second, "checksum", "left").select("asset_id", other.alias("oldest_other"))


@query("d10_duplicate_assertion", f"WITH {X.RAW_FILES} SELECT count(*)::BIGINT AS violations FROM (SELECT checksum FROM raw_files GROUP BY checksum HAVING count(*) > 1)")
def duplicate_assertion(spark, d):
    return X.raw_files(spark, d).groupBy("checksum").agg(F.count("*").alias("n")).where("n > 1").agg(long("*").alias("violations"))


@query(
    "d11_text_ledger",
    "SELECT substr(sha256(regexp_replace(trim(lower(text)), '\\s+', ' ', 'g')), 1, 16) AS hash, count(DISTINCT source)::BIGINT AS n_versions, count(*)::BIGINT AS n, array_to_string(list_sort(list(DISTINCT lang)), ',') AS langs FROM documents GROUP BY 1",
)
def text_ledger(spark, d):
    from millrace.functions.scalars import content_hash

    return table(spark, d, "documents").groupBy(content_hash(F.col("text")).alias("hash")).agg(
        F.count_distinct("source").cast("long").alias("n_versions"), long("*").alias("n"), F.array_join(F.sort_array(F.collect_set("lang")), ",").alias("langs")
    )


@query("m20_consistency_counts", f"WITH {X.RAW_FILES} SELECT count(*) FILTER (status = 'completed' AND asset_id NOT IN (SELECT doc_id FROM labels))::BIGINT AS no_metadata, count(*) FILTER (status IS NULL)::BIGINT AS no_status FROM raw_files")
def consistency_counts(spark, d):
    marked = X.raw_files(spark, d).select("asset_id", "status").join(table(spark, d, "labels").select(F.col("doc_id").alias("asset_id"), F.lit(1).alias("has")).distinct(), "asset_id", "left")
    return marked.agg(F.count_if((F.col("status") == "completed") & F.col("has").isNull()).alias("no_metadata"), F.count_if(F.col("status").isNull()).alias("no_status"))
