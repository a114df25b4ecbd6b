"""Scalar functions over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.functions import vectors as V
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


@query("x1_norm_str", "SELECT event_id, CASE WHEN trim(event_type) <> '' THEN trim(event_type) ELSE 'none' END AS kind FROM events")
def norm_str(spark, d):
    return table(spark, d, "events").select("event_id", S.norm_str(F.col("event_type"), "none").alias("kind"))


@query("x3_content_hash", "SELECT doc_id, substr(sha256(regexp_replace(trim(lower(text)), '\\s+', ' ', 'g')), 1, 16) AS hash FROM documents")
def content_hash(spark, d):
    return table(spark, d, "documents").select("doc_id", S.content_hash(F.col("text")).alias("hash"))


@query("x4_class_names", "SELECT vec_id, CASE label WHEN 0 THEN 'normal' WHEN 1 THEN 'fire' WHEN 2 THEN 'smoke' ELSE 'class_' || label END AS name FROM embeddings")
def class_names(spark, d):
    names = {"0": "normal", "1": "fire", "2": "smoke"}
    label = F.col("label").cast("string")
    return table(spark, d, "embeddings").select("vec_id", S.lookup(label, names, F.concat(F.lit("class_"), label)).alias("name"))


@query("x5_label_synonyms", "SELECT event_id, CASE lower(event_type) WHEN 'click' THEN 'tap' WHEN 'view' THEN 'look' ELSE lower(event_type) END AS label FROM events")
def label_synonyms(spark, d):
    label = F.lower("event_type")
    return table(spark, d, "events").select("event_id", S.lookup(label, {"click": "tap", "view": "look"}, label).alias("label"))


@query("x6_version_tag", "SELECT p_partkey, regexp_replace('v' || (p_size % 3) || '.' || (p_size % 5) || '.' || p_size, '\\.', '', 'g') AS tag FROM part")
def version_tag(spark, d):
    version = F.concat(F.lit("v"), F.concat_ws(".", F.col("p_size") % 3, F.col("p_size") % 5, F.col("p_size")))
    return table(spark, d, "part").select("p_partkey", S.version_tag(version).alias("tag"))


@query("x7_split_part", "SELECT page_id, split_part(url, '/', 3) AS host, split_part(url, '/', -1) AS last FROM pages")
def split_parts(spark, d):
    part = lambda i: F.split_part("url", F.lit("/"), F.lit(i))
    return table(spark, d, "pages").select("page_id", part(3).alias("host"), part(-1).alias("last"))


@query("x8_key_builder", "SELECT doc_id, concat_ws('/', source, 'labels', lang, doc_id || '.pseudo.json') AS key FROM documents")
def key_builder(spark, d):
    return table(spark, d, "documents").select("doc_id", F.concat_ws("/", "source", F.lit("labels"), "lang", F.concat("doc_id", F.lit(".pseudo.json"))).alias("key"))


@query("x9_ordered_distinct", "SELECT o_orderkey, array_to_string(list_distinct_ordered, ',') AS kinds FROM (SELECT o_orderkey, list_reduce(list_transform(string_split(lower(o_orderstatus || ',' || substr(o_orderpriority, 3) || ',' || o_orderstatus), ','), lambda x: [x]), lambda a, b: CASE WHEN list_contains(a, b[1]) THEN a ELSE list_concat(a, b) END) AS list_distinct_ordered FROM orders)")
def ordered_distinct(spark, d):
    text = F.concat_ws(",", "o_orderstatus", F.substr("o_orderpriority", F.lit(3)), "o_orderstatus")
    return table(spark, d, "orders").select("o_orderkey", F.array_join(F.array_distinct(F.split(F.lower(text), ",")), ",").alias("kinds"))


@query("x11_json_payload", "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) IS NOT NULL AS valid FROM events")
def json_payload(spark, d):
    k = F.get_json_object("props", "$.k").try_cast("long")
    return table(spark, d, "events").select("event_id", k.alias("k"), k.isNotNull().alias("valid"))


@query("x12_tag_list", "SELECT doc_id, array_to_string(list_filter(list_transform(string_split(source || ', ' || lang || ',,' || source, ','), lambda t: trim(t)), lambda t: t <> ''), '|') AS tags FROM documents")
def tag_list(spark, d):
    text = F.concat("source", F.lit(", "), "lang", F.lit(",,"), "source")
    return table(spark, d, "documents").select("doc_id", F.array_join(S.parse_tags(text), "|").alias("tags"))


@query("x14_numbered_items", "SELECT p_partkey, p_name AS first, p_brand AS second FROM part")
def numbered_items(spark, d):
    text = F.concat(F.lit("1. "), "p_name", F.lit("\nnoise\n2) "), "p_brand", F.lit("\n1. again"))
    found = S.numbered_items(text)
    return table(spark, d, "part").select("p_partkey", F.try_element_at(found, F.lit(1)).alias("first"), F.try_element_at(found, F.lit(2)).alias("second"))


@query("x17_keyword_match", "SELECT doc_id, regexp_matches(text, '(?i)\\bthe\\b') AS english, contains(text, 'der') AS part FROM documents")
def keyword_match(spark, d):
    return table(spark, d, "documents").select("doc_id", F.col("text").rlike(r"(?i)\bthe\b").alias("english"), F.contains("text", F.lit("der")).alias("part"))


_TRIGRAMS = "list_distinct(flatten(list_transform(list_filter(regexp_split_to_array(lower({0}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"


@query(
    "x18_trigram_similarity",
    f"WITH t AS (SELECT p_partkey, {_TRIGRAMS.format('p_type')} AS a, {_TRIGRAMS.format(chr(39) + 'standard brushed tin' + chr(39))} AS b FROM part) SELECT p_partkey, round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 6) AS similarity FROM t",
)
def trigram_similarity(spark, d):
    return table(spark, d, "part").select("p_partkey", F.round(S.trigram_similarity(F.col("p_type"), F.lit("standard brushed tin")), 6).alias("similarity"))


@query(
    "x19_vector_distances",
    """WITH q AS (SELECT embedding::DOUBLE[] AS q FROM embeddings WHERE vec_id = 1)
    SELECT vec_id, round(1 - list_cosine_similarity(embedding::DOUBLE[], q), 6) AS cosine, round(list_distance(embedding::DOUBLE[], q), 6) AS l2, round(-list_inner_product(embedding::DOUBLE[], q), 6) + 0.0 AS inner_product FROM embeddings, q""",
)
def vector_distances(spark, d):
    emb = table(spark, d, "embeddings")
    one = F.broadcast(emb.where("vec_id = 1").select(F.col("embedding").alias("q")))
    v, q = F.col("embedding"), F.col("q")
    return emb.crossJoin(one).select("vec_id", F.round(1 - V.cosine(v, q), 6).alias("cosine"), F.round(V.l2(v, q), 6).alias("l2"), (F.round(-V.dot(v, q), 6) + F.lit(0.0)).alias("inner_product"))


@query("x20_rounding", "SELECT event_id, round(value, 3) AS r3, substr(event_type, 1, 3) AS head FROM events")
def rounding(spark, d):
    return table(spark, d, "events").select("event_id", F.round("value", 3).alias("r3"), F.left("event_type", F.lit(3)).alias("head"))


_PHASH = "substr(sha256(doc_id::VARCHAR), 1, 16)"
_HALVES = "bit_count(xor(('0x' || substr({0}, 1, 8))::BIGINT, ('0x' || substr({1}, 1, 8))::BIGINT)) + bit_count(xor(('0x' || substr({0}, 9, 8))::BIGINT, ('0x' || substr({1}, 9, 8))::BIGINT))"


@query("x21_hamming", f"WITH h AS (SELECT doc_id, {_PHASH} AS a, substr(sha256((doc_id + 1)::VARCHAR), 1, 16) AS b FROM documents) SELECT doc_id, ({_HALVES.format('a', 'b')})::INT AS distance FROM h")
def hamming(spark, d):
    h = lambda c: F.substring(F.sha2(c.cast("string"), 256), 1, 16)
    return table(spark, d, "documents").select("doc_id", S.hamming64(h(F.col("doc_id")), h(F.col("doc_id") + 1)).cast("int").alias("distance"))


@query(
    "x22_iou",
    """WITH b AS (SELECT l_orderkey, l_linenumber, l_quantity AS s, l_quantity + 10 AS e, l_tax * 100 AS y FROM lineitem)
    SELECT l_orderkey, l_linenumber, round(greatest(least(e, 30) - greatest(s, 20), 0.0) / ((e - s) + 10 - greatest(least(e, 30) - greatest(s, 20), 0.0)), 6) AS iou1,
        round(CASE WHEN (e - s) * 5 + 100 - i > 0 THEN i / ((e - s) * 5 + 100 - i) ELSE 0 END, 6) AS iou2
    FROM (SELECT *, greatest(least(e, 30) - greatest(s, 20), 0.0) * greatest(least(y + 5, 10) - greatest(y, 0), 0.0) AS i FROM b)""",
)
def iou(spark, d):
    s, e, y = F.col("l_quantity"), F.col("l_quantity") + 10, F.col("l_tax") * 100
    line = S.interval_iou(s, e, F.lit(20.0), F.lit(30.0))
    box = S.box_iou([s, y, e, y + 5], [F.lit(20.0), F.lit(0.0), F.lit(30.0), F.lit(10.0)])
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(line, 6).alias("iou1"), F.round(box, 6).alias("iou2"))


@query(
    "x24_wilson",
    """WITH c AS (SELECT source, count(*) FILTER (lang = 'en') AS h, count(*) AS n FROM documents GROUP BY source), p AS (SELECT *, h / n AS p, 1.959964 AS z FROM c)
    SELECT source, round((p + z*z/(2*n) - z * sqrt(p*(1-p)/n + z*z/(4*n*n))) / (1 + z*z/n), 6) AS low, round((p + z*z/(2*n) + z * sqrt(p*(1-p)/n + z*z/(4*n*n))) / (1 + z*z/n), 6) AS high FROM p""",
)
def wilson(spark, d):
    counted = table(spark, d, "documents").groupBy("source").agg(F.count_if(F.col("lang") == "en").alias("h"), F.count("*").alias("n"))
    low, high = S.wilson(F.col("h"), F.col("n"))
    return counted.select("source", F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))


@query(
    "x24_mcnemar",
    """WITH c AS (SELECT user_id, count(*) FILTER (event_type = 'click') AS b, count(*) FILTER (event_type = 'error') AS c FROM events GROUP BY user_id)
    SELECT user_id, round(CASE WHEN b + c = 0 THEN 1.0 ELSE least(1.0, 2 * list_sum(list_transform(range(0, least(b, c) + 1),
        lambda k: exp(lgamma((b + c + 1)::DOUBLE) - lgamma((k + 1)::DOUBLE) - lgamma((b + c - k + 1)::DOUBLE)) * pow(0.5, b + c)))) END, 6) AS p FROM c""",
)
def mcnemar(spark, d):
    counted = table(spark, d, "events").groupBy("user_id").agg(*(F.count_if(F.col("event_type") == t).alias(n) for t, n in (("click", "b"), ("error", "c"))))
    return counted.select("user_id", F.round(S.mcnemar(F.col("b"), F.col("c")), 6).alias("p"))


@query(
    "x25_ordinal_spearman",
    "WITH r AS (SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY value, event_id) AS a, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS b FROM events) SELECT event_type, round(corr(a, b), 6) AS rho FROM r GROUP BY event_type",
)
def ordinal_spearman(spark, d):
    from pyspark.sql import Window

    rank = lambda *o: F.row_number().over(Window.partitionBy("event_type").orderBy(*o))
    ranked = table(spark, d, "events").select("event_type", rank("value", "event_id").alias("a"), rank("ts", "event_id").alias("b"))
    return ranked.groupBy("event_type").agg(F.round(F.corr("a", "b"), 6).alias("rho"))


@query(
    "x26_cramers_v",
    """WITH x AS (SELECT l_returnflag AS a, l_linestatus AS b, count(*)::DOUBLE AS n FROM lineitem GROUP BY ALL), t AS (SELECT *, sum(n) OVER (PARTITION BY a) AS na, sum(n) OVER (PARTITION BY b) AS nb, sum(n) OVER () AS tot FROM x)
    SELECT round(sqrt((sum(n * n / (na * nb)) - 1) / (least(count(DISTINCT a), count(DISTINCT b)) - 1)), 6) AS v FROM t""",
)
def cramers_v(spark, d):
    from pyspark.sql import Window

    cells = table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("a"), F.col("l_linestatus").alias("b")).agg(F.count("*").cast("double").alias("n"))
    margins = cells.withColumns({"na": F.sum("n").over(Window.partitionBy("a")), "nb": F.sum("n").over(Window.partitionBy("b"))})
    smaller = F.least(F.count_distinct("a"), F.count_distinct("b")) - 1
    return margins.agg(F.round(F.sqrt((F.sum(F.col("n") * F.col("n") / (F.col("na") * F.col("nb"))) - 1) / smaller), 6).alias("v"))


@query("x27_binning", "SELECT event_id, floor(value / 5) * 5 AS bin, CASE WHEN value < 10 THEN 'low' WHEN value < 50 THEN 'mid' ELSE 'high' END AS band FROM events")
def binning(spark, d):
    band = F.when(F.col("value") < 10, "low").when(F.col("value") < 50, "mid").otherwise("high")
    return table(spark, d, "events").select("event_id", S.floor_bin(F.col("value"), 5.0).alias("bin"), band.alias("band"))


@query("x28_sample_tiers", "SELECT user_id, CASE WHEN count(*) = 0 THEN 'no_gt' WHEN count(*) < 30 THEN 'counts_only' WHEN count(*) < 100 THEN 'exploratory' ELSE 'reportable' END AS tier FROM events GROUP BY user_id")
def sample_tiers(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(S.sample_tier(F.count("*")).alias("tier"))


@query("x30_hash_ids", "SELECT doc_id, sha256(text) AS sha256, md5(text) AS md5, sha1('label:' || doc_id) AS label_id FROM documents")
def hash_ids(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"), F.md5("text").alias("md5"), F.sha1(F.concat(F.lit("label:"), "doc_id")).alias("label_id"))


@query("x31_canonical_json_hash", "SELECT c_custkey, sha256('{\"nation\":' || c_nationkey || ',\"segment\":\"' || c_mktsegment || '\"}') AS spec_hash FROM customer")
def canonical_json_hash(spark, d):
    spec = F.to_json(F.struct(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")))
    return table(spark, d, "customer").select("c_custkey", F.sha2(spec, 256).alias("spec_hash"))


@query("x33_recent_dates", "SELECT strftime(DATE '2024-03-02' - i::INT, '%Y%m%d') AS day FROM range(0, 7) t(i)")
def recent_dates(spark, d):
    days = F.sequence(F.expr("date_sub(DATE '2024-03-02', 6)"), F.expr("DATE '2024-03-02'"))
    return spark.range(1).select(F.explode(days).alias("day")).select(F.date_format("day", "yyyyMMdd").alias("day"))


@query("x34_date_trunc", "SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS week, count(*)::BIGINT AS n FROM events GROUP BY 1")
def date_trunc(spark, d):
    return table(spark, d, "events").groupBy(F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd").alias("week")).agg(F.count("*").alias("n"))


@query("x35_stem_parse", "SELECT c_custkey, regexp_extract(c_name, '^(.*?)[#_]*(\\d+)$', 1) AS video, regexp_extract(c_name, '^(.*?)[#_]*(\\d+)$', 2)::BIGINT AS frame FROM customer")
def stem_parse(spark, d):
    at = lambda g: F.regexp_extract("c_name", r"^(.*?)[#_]*(\d+)$", g)
    return table(spark, d, "customer").select("c_custkey", at(1).alias("video"), at(2).cast("long").alias("frame"))


@query(
    "x39_yolo_box",
    """SELECT l_orderkey, l_linenumber, round(least(greatest((l_quantity + (l_discount * 100 + 1) / 2) / 60, 0), 1), 6) AS cx, round(least(greatest((l_tax * 100 + (10 + l_linenumber) / 2) / 40, 0), 1), 6) AS cy FROM lineitem""",
)
def yolo_box(spark, d):
    box = S.yolo_box(F.col("l_quantity"), F.col("l_tax") * 100, F.col("l_discount") * 100 + 1, F.lit(10.0) + F.col("l_linenumber"), F.lit(60.0), F.lit(40.0))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", box.alias("b")).select("l_orderkey", "l_linenumber", F.round("b.cx", 6).alias("cx"), F.round("b.cy", 6).alias("cy"))


@query("x42_size_format", "SELECT doc_id, CASE WHEN n_chars >= 1024 THEN (n_chars // 1024) || ' KB' ELSE n_chars || ' B' END AS size FROM documents")
def size_format(spark, d):
    size = F.when(F.col("n_chars") >= 1024, F.concat(F.expr("n_chars div 1024"), F.lit(" KB"))).otherwise(F.concat("n_chars", F.lit(" B")))
    return table(spark, d, "documents").select("doc_id", size.alias("size"))
