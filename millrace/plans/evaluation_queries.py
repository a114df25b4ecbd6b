"""Box and event matching, answers of detection servers, class separation, label queues and clusters."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions.vectors import unit
from millrace.operators import detection as D
from millrace.operators import sampling as P
from millrace.operators.intervals import overlapping
from millrace.plans import fixtures as X
from millrace.plans.quality_queries import _IOU, _pairs, BOXES
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


# --- matching ------------------------------------------------------------------------------


def _walk(order: str, seen: str) -> str:
    """SQL that goes through the pairs of a group in an order; ``seen`` is what else bars a pair's prediction."""
    return f"""c AS (SELECT image, category, list({{'pred': pred, 'truth': truth, 'iou': iou}} ORDER BY {order}) AS l FROM pairs GROUP BY ALL),
    walk AS (SELECT image, category, l, 1 AS k, []::BIGINT[] AS up, []::BIGINT[] AS ut, []::BIGINT[] AS hits FROM c
        UNION ALL SELECT image, category, l, k + 1, CASE WHEN open AND ({seen} OR good) THEN list_append(up, l[k].pred) ELSE up END,
            CASE WHEN open AND good THEN list_append(ut, l[k].truth) ELSE ut END, CASE WHEN open AND good THEN list_append(hits, k) ELSE hits END
        FROM (SELECT *, NOT list_contains(up, l[k].pred) AND NOT list_contains(ut, l[k].truth) AS open, GOOD AS good FROM walk) WHERE k <= len(l)),
    done AS (SELECT image, category, l, unnest(hits) AS h FROM walk WHERE k > len(l))
    SELECT image, category, l[h].pred AS pred, l[h].truth AS truth, round(l[h].iou, 6) AS iou FROM done"""


_PAIRS = f"pairs AS (SELECT p.image, p.category, p.pid AS pred, t.tid AS truth, p.score, {_IOU} AS iou FROM pred p JOIN truth t ON p.image = t.image AND p.category = t.category)"


@query("m3_global_greedy", f"WITH RECURSIVE {BOXES}, {_PAIRS}, {_walk('iou DESC, pred, truth', 'false').replace('GOOD', 'l[k].iou > 0')}")
def global_greedy(spark, d):
    return D.global_greedy_matches(_pairs(spark, d), ["image", "category"]).withColumn("iou", F.round("iou", 6))


@query("m2_greedy_order", f"WITH RECURSIVE {BOXES}, {_PAIRS}, {_walk('score DESC, pred, iou DESC, truth', 'true').replace('GOOD', 'l[k].iou >= 0.5')}")
def greedy_order(spark, d):
    return D.greedy_matches(_pairs(spark, d), ["image", "category"], 0.5).withColumn("iou", F.round("iou", 6))


#: Predicted events: two of three, moved by up to a third of their length; whole microseconds become seconds.
_EVENTS = f"""{X.EVENT_SPANS}, guess AS (SELECT event_id AS pred, asset_id, start_sec + (event_id % 5) * value * 50 AS s, end_sec + (event_id % 5) * value * 50 AS e, value AS score FROM spans WHERE event_id % 3 <> 0 AND value > 0)"""


def _event_pairs(spark, d):
    truth = X.event_spans(spark, d).where("value > 0").select(F.col("event_id").alias("truth"), "asset_id", "start_sec", "end_sec")
    moved = F.col("event_id") % 5 * F.col("value") * 50
    guess = X.event_spans(spark, d).where("event_id % 3 <> 0 AND value > 0").select(F.col("event_id").alias("pred"), "asset_id", (F.col("start_sec") + moved).alias("s"), (F.col("end_sec") + moved).alias("e"), F.col("value").alias("score"))
    both = overlapping(guess, truth, "asset_id", ("s", "e"), ("start_sec", "end_sec"), 86400.0)
    inter = F.least("e", "end_sec") - F.greatest("s", "start_sec")
    iou = inter / (F.greatest("e", "end_sec") - F.least("s", "start_sec"))
    return both.select("asset_id", "pred", F.col("pred").alias("pred_pos"), "score", "truth", F.col("truth").alias("truth_pos"), iou.alias("iou"))


@query(
    "m6_event_best",
    f"""WITH {_EVENTS} SELECT pred, round(max((least(e, end_sec) - greatest(s, start_sec)) / (greatest(e, end_sec) - least(s, start_sec))), 6) AS best
    FROM guess g JOIN spans t ON g.asset_id = t.asset_id AND e > start_sec AND s < end_sec AND t.value > 0 GROUP BY 1""",
)
def event_best(spark, d):
    return _event_pairs(spark, d).groupBy("pred").agg(F.round(F.max("iou"), 6).alias("best"))


@query("m6_event_quality")
def event_quality(spark, d):
    """One row of precision, recall and f1 of events matched one to one at a temporal IoU of 0.5.

    Pairs below the threshold can't match, so they are dropped before the greedy fold.
    """
    matched = D.greedy_matches(_event_pairs(spark, d).where("iou >= 0.5"), ["asset_id"], 0.5).agg(F.count("*").alias("tp"))
    events = X.event_spans(spark, d).where("value > 0").agg(F.count_if(F.col("event_id") % 3 != 0).alias("p"), F.count("*").alias("g"))
    return D.quality(matched.join(F.broadcast(events)).select("tp", (F.col("p") - F.col("tp")).alias("fp"), (F.col("g") - F.col("tp")).alias("fn")))


@query("m11_bootstrap_interval")
def bootstrap(spark, d):
    hits = table(spark, d, "labels").select((F.col("doc_id") % 7).alias("query_set"), (F.col("quality") == 1).alias("hit"))
    return P.bootstrap_interval(hits, "query_set", "hit", seed=5)


# --- answers -------------------------------------------------------------------------------

_ANSWER = """'[{"prompt_class":" ' || l_returnflag || ' ","mask_bbox":[' || l_linenumber || ',2,' || (l_linenumber + 10) || ',8],"score":0.5},{"prompt_class":"  ","mask_bbox":[1,2,3,4]},{"prompt_class":"x","mask_bbox":[1,2]},{"prompt_class":"Box","mask_bbox":[0,1,2,3,9]}]'"""


@query(
    "c4_server_detections",
    f"""WITH a AS (SELECT l_orderkey AS image, l_linenumber AS line, {_ANSWER} AS answer FROM lineitem),
    e AS (SELECT image, line, unnest(from_json(answer, '[{{"prompt_class":"VARCHAR","mask_bbox":["DOUBLE"],"score":"DOUBLE"}}]')) AS d FROM a)
    SELECT image, line, lower(trim(d.prompt_class)) AS class, d.mask_bbox[1] AS x1, d.mask_bbox[2] AS y1, d.mask_bbox[3] AS x2, d.mask_bbox[4] AS y2, d.score AS confidence FROM e WHERE trim(d.prompt_class) <> '' AND len(d.mask_bbox) >= 4""",
)
def server_detections(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("image"), F.col("l_linenumber").alias("line"), F.expr(_ANSWER).alias("answer"))
    found = rows.select("image", "line", F.explode(D.detections_of(F.col("answer"))).alias("d"))
    corners = [F.col("d.bbox")[i].alias(name) for i, name in enumerate(("x1", "y1", "x2", "y2"))]
    return found.select("image", "line", F.col("d.class").alias("class"), *corners, F.col("d.confidence").alias("confidence"))


_LEGACY = """CASE doc_id % 4 WHEN 0 THEN '{"image_id":" ","source_clip_id":"","iou_threshold":"bad"}' WHEN 1 THEN '{"image_id":"i' || doc_id || '","confidence_threshold":0.4}' WHEN 2 THEN '{"model":"m2","class_source":"review","source_clip_id":"c' || doc_id || '"}' ELSE NULL END"""


@query(
    "c3_legacy_header",
    f"""WITH p AS (SELECT doc_id, {_LEGACY} AS j FROM documents), f AS (SELECT doc_id, trim(json_extract_string(j, '$.image_id')) AS i, trim(json_extract_string(j, '$.source_clip_id')) AS c, trim(json_extract_string(j, '$.model')) AS m,
        TRY_CAST(json_extract_string(j, '$.confidence_threshold') AS DOUBLE) AS t, TRY_CAST(json_extract_string(j, '$.iou_threshold') AS DOUBLE) AS u, trim(json_extract_string(j, '$.class_source')) AS s FROM p)
    SELECT doc_id, coalesce(nullif(i, ''), 'row' || doc_id) AS image_id, nullif(coalesce(c, 'clip' || doc_id), '') AS source_clip_id, coalesce(nullif(m, ''), 'base') AS model, coalesce(t, 0.25) AS confidence_threshold, coalesce(u, 0.45) AS iou_threshold, coalesce(nullif(s, ''), 'manual_import') AS class_source FROM f""",
)
def legacy_header(spark, d):
    own = lambda prefix: F.concat(F.lit(prefix), F.col("doc_id").cast("string"))
    header = D.legacy_header(F.expr(_LEGACY), own("row"), own("clip"), model="base", confidence=0.25, iou=0.45, source="manual_import")
    return table(spark, d, "documents").select("doc_id", header.alias("h")).select("doc_id", "h.*")


# --- vectors -------------------------------------------------------------------------------


@query(
    "m17_silhouettes",
    """WITH p AS (SELECT a.vec_id, a.label, b.label AS other, avg(1 - list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[])) AS dist FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id GROUP BY ALL),
    s AS (SELECT vec_id, label, max(dist) FILTER (other = label) AS a, min(dist) FILTER (other <> label) AS b FROM p GROUP BY ALL),
    r AS (SELECT vec_id, label, round(coalesce((b - a) / nullif(greatest(a, b), 0), 0), 4) AS score FROM s WHERE b IS NOT NULL)
    SELECT vec_id, label, CASE WHEN score = 0 THEN 0.0::DOUBLE ELSE score END AS silhouette FROM r""",
)
def silhouettes(spark, d):
    # a zero has no sign
    score = F.round("silhouette", 4)
    return P.silhouettes(table(spark, d, "embeddings"), "vec_id", "embedding", "label").withColumn("silhouette", F.when(score == 0, 0.0).otherwise(score))


_POOL = "SELECT doc_id, (doc_id * 37 % 101) / 100.0::DOUBLE AS rare, (doc_id * 53 % 97) / 96.0::DOUBLE AS rep, CASE WHEN doc_id % 11 <> 0 THEN (doc_id * 71 % 89) / 88.0::DOUBLE END AS uniq FROM documents"


@query(
    "v12_label_queue",
    f"""WITH pool AS ({_POOL}), s AS (SELECT *, round(rare * 0.45::DOUBLE + rep * 0.30::DOUBLE + coalesce(uniq, 0) * 0.25::DOUBLE, 6) AS al, rare > 0.7 AS near FROM pool),
    f AS (SELECT *, NOT near AND row_number() OVER (PARTITION BY near ORDER BY al DESC, doc_id) <= 10 AS first FROM s),
    q AS (SELECT * FROM f ORDER BY first DESC, al DESC, doc_id LIMIT 50)
    SELECT doc_id, al, near, row_number() OVER (ORDER BY al DESC, doc_id) AS place FROM q""",
)
def label_queue(spark, d):
    number = F.col("doc_id")
    pool = table(spark, d, "documents").select("doc_id", (number * 37 % 101 / 100).alias("rare"), (number * 53 % 97 / 96).alias("rep"), F.when(number % 11 != 0, number * 71 % 89 / 88).alias("uniq"))
    return P.label_queue(pool, "doc_id", n=50).select("doc_id", "al", "near", "place")


@query("v13_clusters")
def clusters(spark, d):
    """Vectors with the cluster that seeded k-means gives their unit vectors, and the cluster's most common label."""
    rows = table(spark, d, "embeddings").select("vec_id", "label", unit(F.col("embedding")).alias("u"))
    features = rows.select("vec_id", "label", array_to_vector("u").alias("features"))
    found = KMeans(k=8, seed=42).fit(features).transform(features).select("vec_id", "label", F.col("prediction").alias("cluster"))
    return found.join(_most_common(found, "cluster", "label").withColumnRenamed("label", "dominant"), "cluster").select("vec_id", "label", "cluster", "dominant")


def _most_common(rows, key, value):
    """(key, value): the most frequent value of each key, the smallest of equals."""
    counts = rows.groupBy(key, value).agg(F.count("*").alias("n"))
    return counts.withColumn("k", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), value))).where("k = 1").select(key, value)


@query(
    "v18_projected_clusters",
    """WITH captions AS (SELECT vec_id % 100 AS asset, label AS cluster FROM embeddings WHERE vec_id % 3 = 0 AND vec_id % 100 < 60),
    c AS (SELECT asset, cluster, row_number() OVER (PARTITION BY asset ORDER BY count(*) DESC, cluster) AS k FROM captions GROUP BY asset, cluster)
    SELECT vec_id, coalesce('cap' || lpad(cluster::VARCHAR, 2, '0'), 'none') AS cluster FROM embeddings e LEFT JOIN c ON c.asset = e.vec_id % 100 AND k = 1 WHERE vec_id % 3 <> 0""",
)
def projected_clusters(spark, d):
    rows = table(spark, d, "embeddings").withColumn("asset", F.col("vec_id") % 100)
    captions = rows.where("vec_id % 3 = 0 AND asset < 60").select("asset", F.col("label").alias("cluster"))
    named = _most_common(captions, "asset", "cluster").withColumn("cluster", F.concat(F.lit("cap"), F.lpad(F.col("cluster").cast("string"), 2, "0")))
    return rows.where("vec_id % 3 <> 0").join(named, "asset", "left").select("vec_id", F.coalesce("cluster", F.lit("none")).alias("cluster"))
