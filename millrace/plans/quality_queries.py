"""Detection boxes, matching, splits, near-duplicate images and review dashboards."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.operators import detection as D
from millrace.operators.filters import apply_filters, apply_order
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


BOXES = """truth AS (SELECT l_orderkey AS image, l_returnflag AS category, l_linenumber AS pos, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS tid,
        l_quantity AS x1, l_tax * 100 AS y1, l_quantity + 12 AS x2, l_tax * 100 + 10 + l_linenumber AS y2, l_discount AS score FROM lineitem),
    pred AS (SELECT image, category, pos, tid AS pid, x1 + pos % 3 AS x1, y1 AS y1, x2 + pos % 3 AS x2, y2 AS y2, score FROM truth WHERE (image + pos) % 4 <> 0)"""
_IOU = "(CASE WHEN least(p.x2, t.x2) > greatest(p.x1, t.x1) AND least(p.y2, t.y2) > greatest(p.y1, t.y1) THEN (least(p.x2, t.x2) - greatest(p.x1, t.x1)) * (least(p.y2, t.y2) - greatest(p.y1, t.y1)) / ((p.x2 - p.x1) * (p.y2 - p.y1) + (t.x2 - t.x1) * (t.y2 - t.y1) - (least(p.x2, t.x2) - greatest(p.x1, t.x1)) * (least(p.y2, t.y2) - greatest(p.y1, t.y1))) ELSE 0 END)"


def boxes(spark, d):
    order = Window.partitionBy("l_orderkey", "l_returnflag").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    truth = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("image"),
        F.col("l_returnflag").alias("category"),
        F.col("l_linenumber").alias("pos"),
        F.row_number().over(order).cast("long").alias("tid"),
        F.col("l_quantity").alias("x1"),
        (F.col("l_tax") * 100).alias("y1"),
        (F.col("l_quantity") + 12).alias("x2"),
        (F.col("l_tax") * 100 + 10 + F.col("l_linenumber")).alias("y2"),
        F.col("l_discount").alias("score"),
    )
    shift = F.col("pos") % 3
    pred = truth.where((F.col("image") + F.col("pos")) % 4 != 0).select("image", "category", "pos", F.col("tid").alias("pid"), (F.col("x1") + shift).alias("x1"), "y1", (F.col("x2") + shift).alias("x2"), "y2", "score")
    return truth, pred


def _pairs(spark, d):
    truth, pred = boxes(spark, d)
    joined = pred.alias("p").join(truth.alias("t"), ["image", "category"])
    corner = lambda s: [F.col(f"{s}.{c}") for c in ("x1", "y1", "x2", "y2")]
    return joined.select("image", "category", F.col("pid").alias("pred"), F.col("p.score").alias("score"), F.col("pid").alias("pred_pos"), F.col("tid").alias("truth"), F.col("tid").alias("truth_pos"), S.box_iou(corner("p"), corner("t")).alias("iou"))


@query("m1_best_iou", f"WITH {BOXES} SELECT p.image, p.category, p.pid, round(max({_IOU}), 6) AS best FROM pred p JOIN truth t ON p.image = t.image AND p.category = t.category GROUP BY ALL")
def best_iou(spark, d):
    return _pairs(spark, d).groupBy("image", "category", F.col("pred").alias("pid")).agg(F.round(F.max("iou"), 6).alias("best"))


@query("m2_greedy_match")
def greedy_match(spark, d):
    return D.greedy_matches(_pairs(spark, d), ["image", "category"], 0.5)


@query(
    "m5_precision_recall",
    f"""WITH {BOXES}, b AS (SELECT p.category, p.image, p.pid, max({_IOU}) AS best FROM pred p JOIN truth t ON p.image = t.image AND p.category = t.category GROUP BY ALL),
    h AS (SELECT category, count(*) FILTER (best >= 0.9) AS tp, count(*) FILTER (best < 0.9) AS fp FROM b GROUP BY 1), g AS (SELECT category, count(*) AS n FROM truth GROUP BY 1),
    c AS (SELECT category, tp::BIGINT AS tp, fp::BIGINT AS fp, greatest(n - tp, 0)::BIGINT AS fn FROM h JOIN g USING (category))
    SELECT *, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)), 6) AS f1 FROM c""",
)
def precision_recall(spark, d):
    truth, _ = boxes(spark, d)
    best = _pairs(spark, d).groupBy("category", "image", "pred").agg(F.max("iou").alias("best"))
    hits = best.groupBy("category").agg(F.count_if(F.col("best") >= 0.9).alias("tp"), F.count_if(F.col("best") < 0.9).alias("fp"))
    counts = hits.join(truth.groupBy("category").agg(F.count("*").alias("n")), "category").select("category", "tp", "fp", F.greatest(F.col("n") - F.col("tp"), F.lit(0)).cast("long").alias("fn"))
    return D.quality(counts)


@query(
    "m4_average_precision",
    """WITH r AS (SELECT event_type AS category, value >= 50 AS hit, row_number() OVER (PARTITION BY event_type ORDER BY value % 10 DESC, event_id) AS ord, count(*) OVER (PARTITION BY event_type) AS n_gt FROM events),
    p AS (SELECT *, sum(hit::INT) OVER (PARTITION BY category ORDER BY ord) / ord AS p FROM r), m AS (SELECT *, max(p) OVER (PARTITION BY category ORDER BY ord ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS best FROM p)
    SELECT category, round(sum(CASE WHEN hit THEN best ELSE 0 END) / max(n_gt), 6) AS ap FROM m GROUP BY category""",
)
def average_precision(spark, d):
    scored = table(spark, d, "events").select(F.col("event_type").alias("category"), (F.col("value") >= 50).alias("hit"), (F.col("value") % 10).alias("score"), "event_id")
    return D.average_precision(scored, "category", "score", "event_id").select("category", F.round("ap", 6).alias("ap"))


@query(
    "m8_agreement_rows",
    f"""WITH {BOXES}, b AS (SELECT p.category, p.image, p.pid, max({_IOU}) AS best FROM pred p JOIN truth t ON p.image = t.image AND p.category = t.category GROUP BY ALL)
    SELECT category, count(*)::BIGINT AS n, round(avg(best), 4) AS mean, round(quantile_cont(best, 0.5), 4) AS median, count(*) FILTER (best >= 0.3)::BIGINT AS hit3, count(*) FILTER (best >= 0.5)::BIGINT AS hit5, count(*) FILTER (best >= 0.7)::BIGINT AS hit7 FROM b GROUP BY category""",
)
def agreement_rows(spark, d):
    best = _pairs(spark, d).groupBy("category", "image", "pred").agg(F.max("iou").alias("best"))
    hit = lambda t: F.count_if(F.col("best") >= t)
    return best.groupBy("category").agg(F.count("*").alias("n"), F.round(F.avg("best"), 4).alias("mean"), F.round(F.percentile("best", 0.5), 4).alias("median"), hit(0.3).alias("hit3"), hit(0.5).alias("hit5"), hit(0.7).alias("hit7"))


@query(
    "m12_promotion_gate",
    "WITH m AS (SELECT max(CASE WHEN event_type = 'view' THEN 0.02 END) AS p, min(CASE WHEN event_type <> 'view' THEN (length(event_type) - 6) / 100.0 END) AS w FROM events) SELECT (p >= 0.01 AND w >= -0.02) AS promote, CASE WHEN p IS NULL THEN 'no_primary' WHEN p < 0.01 THEN 'below_margin' WHEN w < -0.02 THEN 'class_regression' ELSE 'ok' END AS reason FROM m",
)
def promotion_gate(spark, d):
    kinds = table(spark, d, "events").select("event_type").distinct()
    delta = F.when(F.col("event_type") == "view", 0.02).otherwise((F.length("event_type") - 6) / 100.0)
    metrics = kinds.select(F.when(F.col("event_type") == "view", "map").otherwise(F.col("event_type")).alias("metric"), F.lit(0.0).alias("old"), delta.alias("new"))
    return D.promotion_gate(metrics, 0.01, -0.02)


@query(
    "m13_grouped_split",
    """WITH k AS (SELECT DISTINCT source FROM documents), r AS (SELECT source, row_number() OVER (ORDER BY sha256('51:' || source), source) AS k, count(*) OVER () AS n FROM k)
    SELECT source, CASE WHEN k <= n - greatest(floor(n * 0.1), 1) - greatest(n - floor(n * 0.8) - floor(n * 0.1), 1) THEN 'train' WHEN k <= n - greatest(n - floor(n * 0.8) - floor(n * 0.1), 1) THEN 'val' ELSE 'test' END AS split FROM r""",
)
def grouped_split(spark, d):
    return D.grouped_split(table(spark, d, "documents"), "source", "51", (0.8, 0.1))


@query(
    "m14_class_floor",
    "SELECT lang, count(*) FILTER (doc_id % 10 < 8)::BIGINT AS train, count(*) FILTER (doc_id % 10 >= 8)::BIGINT AS test, count(*) FILTER (doc_id % 10 >= 8) >= 20 AS enough FROM documents GROUP BY lang",
)
def class_floor(spark, d):
    test = F.count_if(F.col("doc_id") % 10 >= 8)
    return table(spark, d, "documents").groupBy("lang").agg(F.count_if(F.col("doc_id") % 10 < 8).alias("train"), test.alias("test"), (test >= 20).alias("enough"))


@query("m25_field_profile", "SELECT 'event_type' AS field, count(DISTINCT event_type)::BIGINT AS n, round(avg((event_type IS NULL)::INT), 6) AS nulls FROM events UNION ALL SELECT 'user_id', count(DISTINCT user_id)::BIGINT, round(avg((user_id IS NULL)::INT), 6) FROM events UNION ALL SELECT 'props', count(DISTINCT props)::BIGINT, round(avg((props IS NULL)::INT), 6) FROM events")
def field_profile(spark, d):
    fields = ("event_type", "user_id", "props")
    one = table(spark, d, "events").agg(*(F.count_distinct(f).alias(f"n_{f}") for f in fields), *(F.round(F.avg(F.col(f).isNull().cast("int")), 6).alias(f"z_{f}") for f in fields))
    rows = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"n_{f}").cast("long").alias("n"), F.col(f"z_{f}").alias("nulls")) for f in fields))
    return one.select(F.inline(rows))


@query(
    "m27_threshold_sweep",
    "SELECT t / 10.0 AS threshold, count(*) FILTER (value / 100 >= t / 10.0)::BIGINT AS kept, count(DISTINCT user_id) FILTER (value / 100 >= t / 10.0)::BIGINT AS users FROM events, range(1, 10) r(t) GROUP BY t",
)
def threshold_sweep(spark, d):
    # rows are expanded to the thresholds that they pass
    grid = F.filter(F.sequence(F.lit(1), F.lit(9)), lambda t: F.col("value") / 100 >= t / 10.0)
    passed = table(spark, d, "events").select("user_id", F.explode(grid).alias("t"))
    counted = passed.groupBy("t").agg(F.count("*").alias("kept"), F.count_distinct("user_id").cast("long").alias("users"))
    every = spark.range(1, 10).select(F.col("id").cast("int").alias("t")).join(counted, "t", "left")
    return every.select((F.col("t") / 10.0).alias("threshold"), F.coalesce("kept", F.lit(0)).cast("long").alias("kept"), F.coalesce("users", F.lit(0)).cast("long").alias("users"))


_PH = "substr(sha256((doc_id // 3)::VARCHAR), 1, 15) || substr('0123456789abcdef', (doc_id % 3)::INT + 1, 1)"
_HAM = "(bit_count(xor(('0x' || substr(a.h, 1, 8))::BIGINT, ('0x' || substr(b.h, 1, 8))::BIGINT)) + bit_count(xor(('0x' || substr(a.h, 9, 8))::BIGINT, ('0x' || substr(b.h, 9, 8))::BIGINT)))"


def _phashes(spark, d):
    digest = F.sha2(F.expr("CAST(doc_id div 3 AS STRING)"), 256)
    last = F.substring(F.lit("0123456789abcdef"), (F.col("doc_id") % 3).cast("int") + 1, F.lit(1))
    return table(spark, d, "documents").select("doc_id", F.concat(F.substring(digest, 1, 15), last).alias("h"))


@query("d3_similar_phash", f"WITH p AS (SELECT doc_id, {_PH} AS h FROM documents) SELECT a.doc_id, b.doc_id AS other, {_HAM}::INT AS distance FROM p a JOIN p b ON a.doc_id <> b.doc_id AND a.doc_id % 10 = 0 WHERE {_HAM} <= 5")
def similar_phash(spark, d):
    from millrace.operators.phash import similar

    hashes = _phashes(spark, d)
    return similar(hashes.where("doc_id % 10 = 0"), hashes, "doc_id", "h", 5)


@query(
    "d4_nearest_group",
    f"""WITH p AS (SELECT doc_id, {_PH} AS h FROM documents), n AS (SELECT a.doc_id, b.doc_id AS other FROM p a JOIN p b ON a.doc_id <> b.doc_id WHERE substr(a.h, 1, 15) = substr(b.h, 1, 15) AND {_HAM} <= 5
        QUALIFY row_number() OVER (PARTITION BY a.doc_id ORDER BY {_HAM}, b.doc_id) = 1),
    w AS (SELECT doc_id AS who, doc_id AS seq, 'dup_' || least(doc_id, other) || '_' || greatest(doc_id, other) AS grp FROM n UNION ALL SELECT other, doc_id, 'dup_' || least(doc_id, other) || '_' || greatest(doc_id, other) FROM n)
    SELECT who AS doc_id, arg_max(grp, seq) AS dup_group FROM w GROUP BY who""",
)
def nearest_group(spark, d):
    from millrace.operators.phash import nearest_groups, similar

    hashes = _phashes(spark, d)
    return nearest_groups(similar(hashes, hashes, "doc_id", "h", 5), "doc_id")


# --- filter algebra and ordering -----------------------------------------------------------


_SPEC = {
    "conjunction": "or",
    "items": [
        {"filter": "o_orderpriority", "operator": "contains", "value": "urgent", "child": {"filter": "o_totalprice", "operator": "greater", "value": 200000}},
        {"filter": "o_totalprice", "operator": "in", "value": {"min": 100000, "max": 101000}},
        {"filter": "o_orderstatus", "operator": "in_list", "value": ["P"]},
        {"filter": "o_orderkey", "operator": "less", "value": None},
    ],
}


@query("f10_filter_algebra", "SELECT o_orderkey FROM orders WHERE (contains(lower(o_orderpriority), 'urgent') AND o_totalprice > 200000) OR (o_totalprice BETWEEN 100000 AND 101000) OR o_orderstatus IN ('P')")
def filter_algebra(spark, d):
    return apply_filters(table(spark, d, "orders"), _SPEC).select("o_orderkey")


@query("f12_empty_semantics", f"WITH {X.RAW_FILES} SELECT asset_id FROM raw_files WHERE status IS NULL OR status = ''")
def empty_semantics(spark, d):
    return apply_filters(X.raw_files(spark, d), {"items": [{"filter": "status", "operator": "empty", "value": True}]}).select("asset_id")


@query("f10_regex_filter", "SELECT page_id FROM pages WHERE regexp_matches(url, '^https://.*/en/')")
def regex_filter(spark, d):
    good = apply_filters(table(spark, d, "pages"), {"items": [{"filter": "url", "operator": "regex", "value": "^https://.*/en/"}]})
    bad = apply_filters(table(spark, d, "pages"), {"items": [{"filter": "url", "operator": "regex", "value": "("}]})
    return good.select("page_id").unionAll(bad.select("page_id"))


@query("w11_ordering_spec", "SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_acctbal DESC NULLS LAST, c_custkey) AS place FROM customer")
def ordering_spec(spark, d):
    # nulls last, then by the negated value
    rows = table(spark, d, "customer").select("c_custkey", "c_acctbal", F.col("c_acctbal").isNull().cast("int").alias("none"), F.coalesce(-F.col("c_acctbal"), F.lit(0.0)).alias("key"))
    return D.numbered(rows, ["none", "key", "c_custkey"], "place").drop("none", "key")


@query("w15_offset_page", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC NULLS LAST, c_custkey LIMIT 30 OFFSET 60")
def offset_page(spark, d):
    return apply_order(table(spark, d, "customer").select("c_custkey", "c_acctbal"), "-c_acctbal", "c_custkey").offset(60).limit(30)


# --- review workflow ---------------------------------------------------------------------------


@query(
    "r1_review_transition",
    """SELECT conv_id, turn, CASE WHEN role = 'user' AND text <> '' THEN CASE WHEN turn % 3 = 0 THEN 'approved' ELSE 'first_approved' END WHEN role <> 'user' AND turn % 4 = 1 THEN 'rejected' ELSE 'pending' END AS state FROM conversations""",
)
def review_transition(spark, d):
    from millrace.operators.review import transition

    rows = table(spark, d, "conversations").select(
        "conv_id",
        "turn",
        F.when(F.col("role") == "user", "approve").when(F.col("turn") % 4 == 1, "reject").otherwise("none").alias("action"),
        F.when(F.col("turn") % 3 == 0, "admin").otherwise("reviewer").alias("actor"),
        F.lit("pending").alias("status"),
        (F.col("text") != "").alias("labeled"),
        F.lit("note").alias("note"),
    )
    return rows.select("conv_id", "turn", transition(F.col("action"), F.col("actor"), F.col("status"), F.col("labeled"), F.col("note")).alias("state"))


@query(
    "g16_overturn_rate",
    """WITH e AS (SELECT conv_id, turn, role, CASE WHEN role = 'user' THEN 'first_approved' ELSE 'rejected' END AS action, 'u' || (conv_id % 5) AS who FROM conversations),
    r AS (SELECT conv_id, (SELECT arg_max(f.who || ':' || f.turn, f.turn) FROM e f WHERE f.conv_id = e.conv_id AND f.action = 'first_approved' AND f.turn <= e.turn) AS hit FROM e WHERE action = 'rejected' AND turn % 3 = 1),
    a AS (SELECT who, count(*) AS n FROM e WHERE action = 'first_approved' GROUP BY who), o AS (SELECT split_part(hit, ':', 1) AS who, count(*) AS k FROM r WHERE hit IS NOT NULL GROUP BY 1)
    SELECT who, n::BIGINT AS first_approved, coalesce(k, 0)::BIGINT AS overturned, round(100.0 * coalesce(k, 0) / n, 1) AS rate FROM a LEFT JOIN o USING (who)""",
)
def overturn_rate(spark, d):
    from millrace.operators.review import overturns

    history = table(spark, d, "conversations").select(
        F.col("conv_id").alias("task"), F.col("turn").alias("ts"), F.when(F.col("role") == "user", "first_approved").otherwise("rejected").alias("action"), F.concat(F.lit("u"), F.col("conv_id") % 5).alias("who"), (F.col("turn") % 3 == 1).alias("final")
    )
    return overturns(history)


@query("r3_label_distribution", "SELECT conv_id, role AS label, count(*)::BIGINT AS n, round(avg(length(text)), 4) AS mean FROM conversations GROUP BY ALL")
def label_distribution(spark, d):
    return table(spark, d, "conversations").groupBy("conv_id", F.col("role").alias("label")).agg(F.count("*").alias("n"), F.round(F.avg(F.length("text")), 4).alias("mean"))


@query(
    "r4_overlap_cohort",
    """WITH t AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1), m AS (SELECT greatest(floor(count(*) * 0.3 + 0.5) - count(*) FILTER (n >= 5), 0) AS need FROM t)
    SELECT conv_id, CASE WHEN row_number() OVER (ORDER BY n DESC, conv_id) <= need THEN 3 ELSE 1 END AS overlap FROM t, m WHERE n < 5""",
)
def overlap_cohort(spark, d):
    tasks = table(spark, d, "conversations").groupBy("conv_id").agg(F.count("*").alias("n"))
    need = tasks.agg(F.greatest(F.floor(F.count("*") * 0.3 + 0.5) - F.count_if(F.col("n") >= 5), F.lit(0)).alias("need")).first()["need"]
    chosen = tasks.where("n < 5").orderBy(F.desc("n"), "conv_id").limit(need).select("conv_id").withColumn("_c", F.lit(True))
    return tasks.where("n < 5").join(chosen, "conv_id", "left").select("conv_id", F.when(F.col("_c"), 3).otherwise(1).alias("overlap"))


# --- dashboards -------------------------------------------------------------------------------------


@query("h1_type_totals", "SELECT coalesce(event_type, 'all') AS kind, count(*)::BIGINT AS n FROM events GROUP BY ROLLUP (event_type)")
def type_totals(spark, d):
    return table(spark, d, "events").rollup("event_type").agg(F.count("*").alias("n")).select(F.coalesce("event_type", F.lit("all")).alias("kind"), "n")


@query("h2_backlog_panel", "SELECT 'labels' AS panel, count(*)::BIGINT AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT 'vectors', count(*)::BIGINT FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)")
def backlog_panel(spark, d):
    docs = table(spark, d, "documents").select("doc_id")
    parts = {"labels": table(spark, d, "labels").select("doc_id"), "vectors": table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"))}
    counts = [docs.join(p, "doc_id", "left_anti").agg(F.lit(n).alias("panel"), F.count("*").alias("n")) for n, p in parts.items()]
    return counts[0].unionAll(counts[1])


@query("h3_daily_by_type", "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*)::BIGINT AS n FROM events WHERE ts >= TIMESTAMP '2024-01-11' GROUP BY ALL")
def daily_by_type(spark, d):
    return table(spark, d, "events").where(F.col("ts") >= F.lit("2024-01-11").cast("timestamp")).groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type").agg(F.count("*").alias("n"))


@query("h4_latest_summary", "SELECT arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events")
def latest_summary(spark, d):
    latest = F.max_by(F.struct("event_id", "event_type"), F.struct("ts", "event_id"))
    return table(spark, d, "events").agg(latest.alias("e")).select("e.event_id", "e.event_type")


@query("h5_latest_ranking", "SELECT user_id, count(*)::BIGINT AS n FROM events WHERE ts::DATE = (SELECT max(ts)::DATE FROM events) GROUP BY user_id ORDER BY n DESC, user_id LIMIT 10")
def latest_ranking(spark, d):
    events = table(spark, d, "events").select("user_id", F.to_date("ts").alias("day"))
    day = events.agg(F.max("day").alias("day"))
    return events.join(F.broadcast(day), "day", "left_semi").groupBy("user_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "user_id").limit(10)


@query("h6_time_series", "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, count(*)::BIGINT AS n, round(avg(value), 4) AS mean FROM events GROUP BY 1")
def time_series(spark, d):
    return table(spark, d, "events").groupBy(F.date_format("ts", "yyyy-MM-dd HH").alias("hour")).agg(F.count("*").alias("n"), F.round(F.avg("value"), 4).alias("mean"))


@query("t9_sliding_rate", "SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 3600000000 PRECEDING AND CURRENT ROW) > 2 AS limited FROM events")
def sliding_rate(spark, d):
    window = Window.partitionBy("user_id").orderBy(F.unix_micros(F.col("ts").cast("timestamp"))).rangeBetween(-3_600_000_000, 0)
    return table(spark, d, "events").select("event_id", (F.count("*").over(window) > 2).alias("limited"))


@query(
    "t10_fifo_drain",
    f"""WITH {X.JOBS}, i AS (SELECT engine, count(*) FILTER (status = 'done') % 7 AS inflight FROM jobs GROUP BY engine), r AS (SELECT engine, batch, seq, row_number() OVER (PARTITION BY engine ORDER BY batch, seq, cost) AS k FROM jobs WHERE status = 'open')
    SELECT engine, batch, seq FROM r JOIN i USING (engine) WHERE k <= 10 - inflight""",
)
def fifo_drain(spark, d):
    jobs = X.jobs(spark, d)
    inflight = jobs.groupBy("engine").agg((F.count_if(F.col("status") == "done") % 7).alias("inflight"))
    from millrace.operators.relational import first_per_key

    waiting = first_per_key(jobs.where("status = 'open'"), ["engine"], [F.asc("batch"), F.asc("seq"), F.asc("cost")], 10)
    rank = F.row_number().over(Window.partitionBy("engine").orderBy("batch", "seq", "cost"))
    return waiting.withColumn("k", rank).join(F.broadcast(inflight), "engine").where(F.col("k") <= 10 - F.col("inflight")).select("engine", "batch", "seq")
