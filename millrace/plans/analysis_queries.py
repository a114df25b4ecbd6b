"""Bank experiments, caption audits, review payloads, tree listings and readiness counts."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from millrace.functions import scalars as S
from millrace.functions.vectors import unit
from millrace.operators import banks as B
from millrace.operators.vector_search import top_k, with_query
from millrace.plans import fixtures as X
from millrace.plans.quality_queries import BOXES, boxes
from millrace.plans.vector_queries import BEST, PAIRS, means
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


def _dot(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


# --- sources and state -------------------------------------------------------------------


@query("s17_keyset_page", "SELECT doc_id, lang FROM documents WHERE doc_id > 100 ORDER BY doc_id LIMIT 50")
def keyset_page(spark, d):
    """The page after a key; the limit is the page's size."""
    return table(spark, d, "documents").where("doc_id > 100").select("doc_id", "lang").orderBy("doc_id").limit(50)


@query("u26_rerun_inserts", "SELECT md5(source || '/' || doc_id) AS id, CASE WHEN doc_id % 2 = 0 THEN 'first' ELSE 'again' END AS run FROM documents")
def rerun_inserts(spark, d):
    """Ids made of the content, so that a second run adds only what the first one lacks."""
    rows = table(spark, d, "documents").select("doc_id", F.md5(F.concat_ws("/", "source", "doc_id")).alias("id"))
    first = rows.where("doc_id % 2 = 0").select("id", F.lit("first").alias("run"))
    again = rows.select("id", F.lit("again").alias("run"))
    return first.unionAll(again.join(first, "id", "left_anti"))


@query("t13_review_poll", "SELECT user_id, count(*) AS waiting FROM events WHERE event_type = 'click' AND event_id NOT IN (SELECT event_id FROM events WHERE value > 50) GROUP BY user_id")
def review_poll(spark, d):
    """Finished reviews that haven't been submitted."""
    events = table(spark, d, "events")
    submitted = events.where("value > 50").select("event_id")
    return events.where("event_type = 'click'").join(submitted, "event_id", "left_anti").groupBy("user_id").agg(F.count("*").alias("waiting"))


@query("m28_readiness", f"WITH {X.JOBS} SELECT batch, count(DISTINCT engine) AS needed, count(DISTINCT engine) FILTER (status = 'done') AS met, count(DISTINCT engine) = count(DISTINCT engine) FILTER (status = 'done') AS ready FROM jobs GROUP BY batch")
def readiness(spark, d):
    """A batch is ready when each engine that it names has a finished job."""
    jobs = X.jobs(spark, d).groupBy("batch", "engine").agg(F.bool_or(F.col("status") == "done").alias("done"))
    return jobs.groupBy("batch").agg(F.count("*").alias("needed"), F.count_if("done").alias("met"), F.bool_and("done").alias("ready"))


# --- names and trees ------------------------------------------------------------------------


@query(
    "w10_tree_lines",
    f"""WITH {X.RAW_FILES}, u AS (SELECT unit, row_number() OVER (ORDER BY unit DESC) = 1 AS last FROM (SELECT DISTINCT unit FROM raw_files)),
    l AS (SELECT unit, lang, row_number() OVER (PARTITION BY unit ORDER BY lang DESC) = 1 AS last FROM (SELECT DISTINCT unit, lang FROM raw_files))
    SELECT unit AS path, CASE WHEN last THEN '└── ' ELSE '├── ' END || unit AS line FROM u
    UNION ALL SELECT l.unit || '/' || lang, CASE WHEN u.last THEN '    ' ELSE '│   ' END || CASE WHEN l.last THEN '└── ' ELSE '├── ' END || lang FROM l JOIN u USING (unit)""",
)
def tree_lines(spark, d):
    """Each folder's line of a tree: the last child of a folder has a corner, and nothing runs on below it."""
    folders = X.raw_files(spark, d).select("unit", "lang").distinct()
    units = folders.groupBy("unit").agg(F.max("lang").alias("last_lang"))
    # one row by construction
    marked = units.crossJoin(units.agg(F.max("unit").alias("last_unit"))).withColumn("end", F.col("unit") == F.col("last_unit"))
    branch = lambda last: F.when(last, "└── ").otherwise("├── ")
    upper = marked.select(F.col("unit").alias("path"), F.concat(branch(F.col("end")), "unit").alias("line"))
    stem = F.when(F.col("end"), "    ").otherwise("│   ")
    lower = folders.join(marked, "unit").select(F.concat_ws("/", "unit", "lang").alias("path"), F.concat(stem, branch(F.col("lang") == F.col("last_lang")), "lang").alias("line"))
    return upper.unionAll(lower)


@query("x10_output_names", "SELECT event_id, concat_ws(',', CASE WHEN event_type IN ('click', 'view') THEN event_type END, 'bbox', CASE WHEN event_id % 2 = 1 THEN 'caption' END) AS outputs FROM events")
def output_names(spark, d):
    """Comma-separated names, trimmed, in lower case, by their aliases; unknown ones and repeats are dropped."""
    wanted = F.concat("event_type", F.lit(", BBOX ,unknown,,"), F.when(F.col("event_id") % 2 == 0, "box").otherwise(" Caption"))
    named = F.transform(F.split(wanted, ","), lambda n: S.lookup(F.lower(F.trim(n)), {"box": "bbox"}, F.lower(F.trim(n))))
    known = F.array_distinct(F.filter(named, lambda n: n.isin("click", "view", "bbox", "caption")))
    return table(spark, d, "events").select("event_id", F.array_join(known, ",").alias("outputs"))


@F.pandas_udf(StringType())
def nfc(text: pd.Series) -> pd.Series:
    """Composed form of a text; null stays null."""
    return text.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


@query("x36_composed_form", "SELECT doc_id, text || chr(233) = text || 'e' || chr(769) AS same, md5(nfc_normalize(text || chr(233))) = md5(nfc_normalize(text || 'e' || chr(769))) AS same_composed FROM documents")
def composed_form(spark, d):
    one, other = F.concat("text", F.lit("\u00e9")), F.concat("text", F.lit("e\u0301"))
    return table(spark, d, "documents").select("doc_id", (one == other).alias("same"), (F.md5(nfc(one)) == F.md5(nfc(other))).alias("same_composed"))


# --- payloads -----------------------------------------------------------------------------------


@query("c6_declared_categories", "SELECT name, row_number() OVER (ORDER BY min(place)) AS category_id FROM (SELECT 'c' || ((l_linenumber + l_suppkey % 3) % 5) AS name, l_suppkey % 3 * 100 + l_linenumber - 1 AS place, l_linenumber - 1 AS id FROM lineitem) WHERE id <> 0 GROUP BY name")
def declared_categories(spark, d):
    """Categories of several sources, one for each name in order of declaration; number 0 is no category."""
    source = F.col("l_suppkey") % 3
    rows = table(spark, d, "lineitem").select(source.alias("source"), (F.col("l_linenumber") - 1).alias("id"), F.concat(F.lit("c"), ((F.col("l_linenumber") + source) % 5).cast("string")).alias("name")).where("id <> 0")
    first = rows.groupBy("name").agg(F.min(F.struct("source", "id")).alias("first"))
    # a row for each category
    return first.select("name", F.row_number().over(Window.orderBy("first")).alias("category_id"))


@query(
    "c8_reviewed_boxes",
    f"""WITH {BOXES}, r AS (SELECT image, pid, CASE category WHEN 'R' THEN 'red' ELSE category END AS label, 100 * x1 / 200 AS x_pct, 100 * (x2 - x1) / 200 AS w_pct FROM pred),
    k AS (SELECT label, 2 + row_number() OVER (ORDER BY label) AS id FROM (SELECT DISTINCT label FROM r WHERE label NOT IN ('A', 'N')))
    SELECT image, pid, CASE label WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE k.id END AS category_id, round(x_pct * 2, 2) AS x, round(w_pct * 2, 2) AS w FROM r LEFT JOIN k USING (label)""",
)
def reviewed_boxes(spark, d):
    """Reviewed rectangles in pixels again; known categories keep their numbers, and new labels follow by name."""
    _, pred = boxes(spark, d)
    label = S.lookup(F.col("category"), {"R": "red"}, F.col("category"))
    rows = pred.select("image", "pid", label.alias("label"), (100 * F.col("x1") / 200).alias("x_pct"), (100 * (F.col("x2") - F.col("x1")) / 200).alias("w_pct"))
    fresh = rows.where(~F.col("label").isin("A", "N")).select("label").distinct().select("label", (2 + F.row_number().over(Window.orderBy("label"))).alias("fresh"))
    number = F.when(F.col("label") == "A", 1).when(F.col("label") == "N", 2).otherwise(F.col("fresh"))
    return rows.join(fresh, "label", "left").select("image", "pid", number.alias("category_id"), F.round(F.col("x_pct") * 200 / 100, 2).alias("x"), F.round(F.col("w_pct") * 200 / 100, 2).alias("w"))


# --- captions and vectors --------------------------------------------------------------------------


@query(
    "m18_caption_alignment",
    """WITH e AS (SELECT vec_id, vec_id % 50 AS asset, embedding::DOUBLE[] AS v FROM embeddings),
    s AS (SELECT c.vec_id, f.asset = c.asset AS matched, list_cosine_similarity(c.v, f.v) AS cos FROM e c JOIN e f ON f.asset = c.asset OR f.asset = (c.asset + 1) % 50 WHERE c.vec_id % 4 = 0 AND f.vec_id % 4 <> 0)
    SELECT vec_id, round(avg(cos) FILTER (matched), 6) AS matched_mean, round(avg(cos) FILTER (NOT matched), 6) AS baseline, round(avg(cos) FILTER (matched) - avg(cos) FILTER (NOT matched), 6) AS gap FROM s GROUP BY vec_id""",
)
def caption_alignment(spark, d):
    """Mean cosine of a caption with its own asset's frames and with another's; a mean of unit vectors stands for each asset's frames."""
    rows = table(spark, d, "embeddings").select("vec_id", (F.col("vec_id") % 50).alias("asset"), unit(F.col("embedding")).alias("vec"))
    assets = means(rows.where("vec_id % 4 <> 0"), ["asset"])
    captions = rows.where("vec_id % 4 = 0").withColumn("foreign", (F.col("asset") + 1) % 50)
    own = captions.join(assets.withColumnRenamed("mean", "own"), "asset")
    both = own.join(assets.select(F.col("asset").alias("foreign"), F.col("mean").alias("other")), "foreign")
    scored = both.select("vec_id", _dot("vec", "own").alias("m"), _dot("vec", "other").alias("b"))
    return scored.select("vec_id", F.round("m", 6).alias("matched_mean"), F.round("b", 6).alias("baseline"), F.round(F.col("m") - F.col("b"), 6).alias("gap"))


@query("m19_keyword_anchoring", "SELECT source, count(*) AS n, round(avg(regexp_matches(lower(text), '(^|[^a-z])(the|and)([^a-z]|$)')::INT), 6) AS rate FROM documents WHERE text IS NOT NULL GROUP BY source")
def keyword_anchoring(spark, d):
    """The share of each class's captions that holds one of its words."""
    hit = F.lower("text").rlike("(^|[^a-z])(the|and)([^a-z]|$)")
    return table(spark, d, "documents").where("text IS NOT NULL").groupBy("source").agg(F.count("*").alias("n"), F.round(F.avg(hit.cast("int")), 6).alias("rate"))


@query(
    "m23_attribution_audit",
    """WITH r AS (SELECT md5(text) AS print, CAST(floor(embedding[1]::DOUBLE * 1000) AS BIGINT) AS vector FROM documents JOIN embeddings ON vec_id = doc_id),
    p AS (SELECT print FROM r GROUP BY print HAVING count(DISTINCT vector) > 1), v AS (SELECT vector FROM r GROUP BY vector HAVING count(DISTINCT print) > 1)
    SELECT 'text' AS side, count(*) AS n FROM p UNION ALL SELECT 'vector', count(*) FROM v""",
)
def attribution_audit(spark, d):
    """Texts with several vectors and vectors with several texts."""
    docs = table(spark, d, "documents").select("doc_id", F.md5("text").alias("print"))
    vectors = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), F.floor(F.element_at("embedding", 1).cast("double") * 1000).alias("vector"))
    rows = docs.join(vectors, "doc_id").select("print", "vector").distinct()
    several = lambda key, other, side: rows.groupBy(key).agg(F.count(other).alias("k")).agg(F.count_if(F.col("k") > 1).alias("n")).select(F.lit(side).alias("side"), "n")
    return several("print", "vector", "text").unionAll(several("vector", "print", "vector"))


_Q = "q AS (SELECT embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id = 0)"
_COS = "list_cosine_similarity(embedding::DOUBLE[], q.v)"


@query("v6_caption_search", f"WITH {_Q} SELECT vec_id, round({_COS}, 6) AS cos FROM embeddings, q WHERE vec_id % 4 = 0 AND vec_id <> 0 ORDER BY {_COS} DESC, vec_id LIMIT 10")
def caption_search(spark, d):
    emb = table(spark, d, "embeddings")
    scored = with_query(emb.where("vec_id % 4 = 0 AND vec_id <> 0"), emb.where("vec_id = 0"), "embedding", "embedding")
    return top_k(scored, 10, "vec_id").select("vec_id", F.round("cos", 6).alias("cos"))


@query(
    "v19_placement",
    f"""WITH {BEST}, n AS (SELECT vec_id, cos - min(cos) OVER (PARTITION BY vec_id) + 1e-6 AS w, cls, gidx % 10 AS y, gidx % 3 <> 0 AS placed FROM best WHERE rank <= 5)
    SELECT vec_id, round(coalesce(sum(w * cls) FILTER (placed) / sum(w) FILTER (placed), 0), 5) AS x, round(coalesce(sum(w * y) FILTER (placed) / sum(w) FILTER (placed), 0), 5) AS y, count(*) FILTER (placed) = 0 AS unplaced FROM n GROUP BY vec_id""",
)
def placement(spark, d):
    """Coordinates between those of the nearest sentences; neighbours without any are left out, and without others it is the origin."""
    near = B.best_sentences(X.frames(spark, d), X.bank(spark, d), 5)
    weighted = near.withColumn("w", F.col("cos") - F.min("cos").over(Window.partitionBy("vec_id")) + 1e-6).withColumn("placed", F.col("gidx") % 3 != 0)
    w = F.when(F.col("placed"), F.col("w"))
    at = lambda c: F.round(F.coalesce(F.sum(w * c) / F.sum(w), F.lit(0.0)), 5)
    return weighted.groupBy("vec_id").agg(at(F.col("cls")).alias("x"), at(F.col("gidx") % 10).alias("y"), (F.count(w) == 0).alias("unplaced"))


# --- banks ----------------------------------------------------------------------------------------------


@query("b1_class_similarity", f"WITH {PAIRS} SELECT vec_id, cls, round(avg(cos), 6) AS cos FROM pairs GROUP BY vec_id, cls")
def class_similarity(spark, d):
    """Mean cosine of a frame with each class: its product with the class's mean unit sentence."""
    classes = means(X.bank(spark, d).select("cls", unit(F.col("vec")).alias("vec")), ["cls"])
    # a row for each class
    pairs = X.frames(spark, d).select("vec_id", unit(F.col("vec")).alias("u")).crossJoin(F.broadcast(classes))
    return pairs.select("vec_id", "cls", F.round(_dot("u", "mean"), 6).alias("cos"))


@query(
    "b18_would_win",
    f"""WITH {BEST}, w AS (SELECT a.gidx, count(*) AS wins FROM best a LEFT JOIN best b ON a.vec_id = b.vec_id AND b.rank = 2 WHERE a.rank = 1 AND a.cos > coalesce(b.cos, -2) GROUP BY a.gidx)
    SELECT gidx, round(coalesce(wins, 0) / (SELECT count(*) FROM frames), 6) AS rate FROM bank LEFT JOIN w USING (gidx)""",
)
def would_win(spark, d):
    """The share of all frames in which a sentence beats the best of the others."""
    best = B.best_sentences(X.frames(spark, d), X.bank(spark, d), 2)
    frames = best.groupBy("vec_id").agg(F.min_by("gidx", "rank").alias("gidx"), F.max(F.when(F.col("rank") == 1, F.col("cos"))).alias("c1"), F.max(F.when(F.col("rank") == 2, F.col("cos"))).alias("c2"))
    wins = frames.where(F.col("c1") > F.coalesce("c2", F.lit(-2.0))).groupBy("gidx").agg(F.count("*").alias("wins"))
    # one row by construction
    total = X.frames(spark, d).agg(F.count("*").alias("frames"))
    return X.bank(spark, d).select("gidx").join(wins, "gidx", "left").crossJoin(F.broadcast(total)).select("gidx", F.round(F.coalesce("wins", F.lit(0)) / F.col("frames"), 6).alias("rate"))


@query("b20_main_effects", "WITH c AS (SELECT user_id % 16 AS mask, avg(value) AS v FROM events GROUP BY 1) SELECT f AS factor, round(avg(v) FILTER ((mask >> f) & 1 = 1) - avg(v) FILTER ((mask >> f) & 1 = 0), 6) AS effect FROM c, (SELECT unnest([0, 1, 2, 3]) AS f) GROUP BY f")
def main_effects(spark, d):
    """Two-level factorial design of four factors: the mean of the cells with a factor minus that of those without."""
    cells = table(spark, d, "events").groupBy((F.col("user_id") % 16).alias("mask")).agg(F.avg("value").alias("v"))
    each = cells.select("mask", "v", F.explode(F.array(*map(F.lit, range(4)))).alias("factor"))
    on = F.floor(F.col("mask") / F.pow(F.lit(2), F.col("factor"))) % 2
    effect = F.avg(F.when(on == 1, F.col("v"))) - F.avg(F.when(on == 0, F.col("v")))
    return each.groupBy("factor").agg(F.round(effect, 6).alias("effect"))


@query(
    "b22_wave_role",
    """WITH g AS (SELECT vec_id, label, CASE WHEN label = 0 THEN -embedding[1]::DOUBLE ELSE embedding[1]::DOUBLE END AS gain FROM embeddings),
    b AS (SELECT label, quantile_cont(gain, 0.9) AS high, quantile_cont(gain, 0.1) AS low FROM g GROUP BY label)
    SELECT vec_id, CASE WHEN gain >= high AND gain > 0 THEN 'beneficial' WHEN gain <= low AND gain < 0 THEN 'harmful' ELSE 'middle' END AS role FROM g JOIN b USING (label)""",
)
def wave_role(spark, d):
    """The best and worst tenth of each class by gain, if the gain has the right sign; class 0 has its sign flipped."""
    first = F.element_at("embedding", 1).cast("double")
    rows = table(spark, d, "embeddings").select("vec_id", "label", F.when(F.col("label") == 0, -first).otherwise(first).alias("gain"))
    # a row for each class
    bounds = rows.groupBy("label").agg(F.percentile("gain", 0.9).alias("high"), F.percentile("gain", 0.1).alias("low"))
    role = F.when((F.col("gain") >= F.col("high")) & (F.col("gain") > 0), "beneficial").when((F.col("gain") <= F.col("low")) & (F.col("gain") < 0), "harmful").otherwise("middle")
    return rows.join(bounds, "label").select("vec_id", role.alias("role"))


@query("b28_bank_links", f"WITH {PAIRS} SELECT vec_id, version, gidx, row_number() OVER (PARTITION BY vec_id, version ORDER BY cos DESC, gidx) AS rank FROM pairs QUALIFY rank <= 3")
def bank_links(spark, d):
    """The three nearest sentences of each of several banks."""
    bank = X.bank(spark, d)
    linked = [B.best_sentences(X.frames(spark, d), bank.where(F.col("version") == v), 3).select("vec_id", F.lit(v).alias("version"), "gidx", "rank") for v in "AB"]
    return linked[0].unionAll(linked[1])


@query("b29_domain_scores", f"WITH {BEST} SELECT grp % 2 AS domain, count(*) AS n, round(avg(CASE WHEN grp % 2 = 0 THEN (cls % 2 = gt % 2)::INT ELSE (cls = gt)::INT END), 6) AS recall FROM best WHERE rank = 1 GROUP BY 1")
def domain_scores(spark, d):
    """Recall of each domain by its own mapping of the classes."""
    won = B.predictions(B.best_sentences(X.frames(spark, d), X.bank(spark, d), 1)).withColumn("domain", F.col("grp") % 2)
    own = lambda c: F.when(F.col("domain") == 0, F.col(c) % 2).otherwise(F.col(c))
    return won.groupBy("domain").agg(F.count("*").alias("n"), F.round(F.avg((own("pred") == own("gt")).cast("int")), 6).alias("recall"))
