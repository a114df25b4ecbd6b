"""Vector search, label quality and prompt-bank queries over ``embeddings``."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions.scalars import trigram_similarity
from millrace.functions.vectors import cosine, unit
from millrace.operators import banks as B
from millrace.operators.vector_search import ranked, rrf, top_k, with_query
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


_Q = "q AS (SELECT embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id = 0)"
_COS = "list_cosine_similarity(embedding::DOUBLE[], q.v)"


def _scored(spark, d, where="vec_id <> 0"):
    emb = table(spark, d, "embeddings")
    return with_query(emb.where(where), emb.where("vec_id = 0"), "embedding", "embedding")


@query("v1_vector_topk", f"WITH {_Q} SELECT vec_id, label, round({_COS}, 6) AS cos FROM embeddings, q WHERE vec_id <> 0 ORDER BY {_COS} DESC, vec_id LIMIT 10")
def vector_topk(spark, d):
    return top_k(_scored(spark, d), 10, "vec_id").select("vec_id", "label", F.round("cos", 6).alias("cos"))


@query("v2_filtered_topk", f"WITH {_Q} SELECT vec_id, label, round({_COS}, 6) AS cos FROM embeddings, q WHERE vec_id <> 0 AND label IN (1, 3) AND vec_id % 7 < 4 ORDER BY {_COS} DESC, vec_id LIMIT 15")
def filtered_topk(spark, d):
    return top_k(_scored(spark, d, "vec_id <> 0 AND label IN (1, 3) AND vec_id % 7 < 4"), 15, "vec_id").select("vec_id", "label", F.round("cos", 6).alias("cos"))


@query("v3_count_within", f"WITH {_Q} SELECT label, count(*)::BIGINT AS n FROM embeddings, q WHERE 1 - {_COS} <= 0.9 GROUP BY label")
def count_within(spark, d):
    return _scored(spark, d, "true").where(1 - F.col("cos") <= 0.9).groupBy("label").agg(F.count("*").alias("n"))


_TRI = "list_distinct(flatten(list_transform(list_filter(regexp_split_to_array(lower({0}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"


@query(
    "v5_keyword_search",
    f"""WITH t AS (SELECT item_id, text, {_TRI.format("text")} AS a, {_TRI.format("'the answer of the'")} AS b FROM benchmark),
    s AS (SELECT item_id, contains(lower(text), 'the') AS hit, len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) AS sim FROM t)
    SELECT item_id, hit, round(sim, 6) AS sim FROM s WHERE hit OR sim > 0.05 ORDER BY hit DESC, sim DESC, item_id LIMIT 20""",
)
def keyword_search(spark, d):
    scored = table(spark, d, "benchmark").select("item_id", F.contains(F.lower("text"), F.lit("the")).alias("hit"), trigram_similarity(F.col("text"), F.lit("the answer of the")).alias("sim"))
    return scored.where("hit OR sim > 0.05").orderBy(F.desc("hit"), F.desc("sim"), "item_id").limit(20).select("item_id", "hit", F.round("sim", 6).alias("sim"))


@query(
    "v7_hybrid_rrf",
    f"""WITH {_Q}, s AS (SELECT vec_id, row_number() OVER (ORDER BY {_COS} DESC, vec_id) AS r FROM embeddings, q WHERE vec_id <> 0 QUALIFY r <= 50),
    k AS (SELECT vec_id, row_number() OVER (ORDER BY label DESC, vec_id) AS r FROM embeddings WHERE label >= 5 AND vec_id <> 0 QUALIFY r <= 50)
    SELECT coalesce(s.vec_id, k.vec_id) AS vec_id, round(coalesce(1 / (60.0 + s.r), 0) + coalesce(1 / (60.0 + k.r), 0), 6) AS score FROM s FULL JOIN k ON s.vec_id = k.vec_id""",
)
def hybrid_rrf(spark, d):
    semantic = ranked(_scored(spark, d), 50, "vec_id", "cos", "r1").select("vec_id", "r1")
    words = table(spark, d, "embeddings").where("label >= 5 AND vec_id <> 0")
    keyword = ranked(words, 50, "vec_id", "label", "r2").select("vec_id", "r2")
    fused = semantic.join(keyword, "vec_id", "full_outer")
    return fused.select("vec_id", F.round(rrf(F.col("r1")) + rrf(F.col("r2")), 6).alias("score"))


def means(frame, keys, vec="vec"):
    """Mean vector of each key: positions are averaged apart, so no list of vectors is gathered."""
    parts = frame.select(*keys, F.posexplode(vec).alias("pos", "x")).groupBy(*keys, "pos").agg(F.avg("x").alias("x"))
    return parts.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda p: p["x"]).alias("mean"))


_MEANS = "m AS (SELECT k, list(x ORDER BY pos) AS mean FROM (SELECT k, pos, avg(x) AS x FROM (SELECT k, generate_subscripts(v, 1) AS pos, unnest(v) AS x FROM src) GROUP BY k, pos) GROUP BY k)"


@query("v9_frame_pool", f"WITH src AS (SELECT vec_id % 50 AS k, embedding::DOUBLE[] AS v FROM embeddings), {_MEANS} SELECT k AS asset_id, round(mean[1] / sqrt(list_inner_product(mean, mean)), 6) AS x0, round(mean[64] / sqrt(list_inner_product(mean, mean)), 6) AS x63 FROM m")
def frame_pool(spark, d):
    emb = table(spark, d, "embeddings").select((F.col("vec_id") % 50).alias("asset_id"), F.col("embedding").alias("vec"))
    pooled = means(emb, ["asset_id"]).select("asset_id", unit(F.col("mean")).alias("u"))
    return pooled.select("asset_id", F.round(F.element_at("u", 1), 6).alias("x0"), F.round(F.element_at("u", 64), 6).alias("x63"))


@query("v10_pending_by_model", "SELECT label AS model, count(*)::BIGINT AS pending FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM labels) GROUP BY label")
def pending_by_model(spark, d):
    from millrace.operators.relational import backlog

    emb = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("label").alias("model"))
    return backlog(emb, table(spark, d, "labels"), ["doc_id"]).groupBy("model").agg(F.count("*").alias("pending"))


_CENTROIDS = f"src AS (SELECT label AS k, list_transform(embedding::DOUBLE[], lambda x: x / sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]))) AS v FROM embeddings), {_MEANS}"


def _centroids(spark, d):
    emb = table(spark, d, "embeddings").select("label", unit(F.col("embedding")).alias("vec"))
    return means(emb, ["label"])


@query("v11_class_centroids", f"WITH {_CENTROIDS} SELECT a.k AS a, b.k AS b, round(list_cosine_similarity(a.mean, b.mean), 6) AS cos FROM m a JOIN m b ON a.k < b.k")
def class_centroids(spark, d):
    # one row per class on either side
    c = _centroids(spark, d)
    other = c.select(F.col("label").alias("b"), F.col("mean").alias("other"))
    return c.crossJoin(other).where("label < b").select(F.col("label").alias("a"), "b", F.round(cosine(F.col("mean"), F.col("other")), 6).alias("cos"))


@query(
    "j13_group_min_distance",
    """WITH c AS (SELECT vec_id, vec_id % 50 AS asset, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id % 4 = 0), f AS (SELECT vec_id, vec_id % 50 AS asset, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id % 4 <> 0)
    SELECT c.vec_id, round(min(1 - list_cosine_similarity(c.v, f.v)), 6) AS nearest, round(avg(list_cosine_similarity(c.v, f.v)), 6) AS matched_mean, round(max(list_cosine_similarity(c.v, f.v)), 6) AS matched_best, count(*)::BIGINT AS n_frames FROM c JOIN f USING (asset) GROUP BY c.vec_id""",
)
def group_min_distance(spark, d):
    emb = table(spark, d, "embeddings").select("vec_id", (F.col("vec_id") % 50).alias("asset"), F.col("embedding").alias("v"))
    frames = emb.where("vec_id % 4 <> 0").select("asset", F.col("v").alias("fv"))
    pairs = emb.where("vec_id % 4 = 0").join(frames, "asset").withColumn("cos", cosine(F.col("v"), F.col("fv")))
    return pairs.groupBy("vec_id").agg(
        F.round(F.min(1 - F.col("cos")), 6).alias("nearest"), F.round(F.avg("cos"), 6).alias("matched_mean"), F.round(F.max("cos"), 6).alias("matched_best"), F.count("*").alias("n_frames")
    )


PAIRS = f"{X.FRAMES}, pairs AS (SELECT vec_id, gt, grp, gidx, cls, version, list_cosine_similarity(f.vec, b.vec) AS cos FROM frames f, bank b)"
BEST = f"{PAIRS}, best AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY cos DESC, gidx) AS rank FROM pairs)"


def _best(spark, d, k, per_class=False):
    return B.best_sentences(X.frames(spark, d), X.bank(spark, d), k, per_class)


@query("b2_best_per_class", f"WITH {PAIRS} SELECT vec_id, cls, arg_min(gidx, (-cos, gidx)) AS gidx, round(max(cos), 6) AS cos FROM pairs GROUP BY vec_id, cls")
def best_per_class(spark, d):
    return _best(spark, d, 1, True).select("vec_id", "cls", "gidx", F.round("cos", 6).alias("cos"))


@query("b3_top2_per_class", f"WITH {PAIRS} SELECT vec_id, cls, gidx, row_number() OVER (PARTITION BY vec_id, cls ORDER BY cos DESC, gidx) AS rank FROM pairs QUALIFY rank <= 2")
def top2_per_class(spark, d):
    return _best(spark, d, 2, True).select("vec_id", "cls", "gidx", "rank")


@query(
    "b5_majority_vote",
    f"""WITH {BEST}, v AS (SELECT vec_id, cls, count(*) AS votes, max(cos) AS top FROM best WHERE rank <= 7 GROUP BY ALL), o AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY votes DESC, top DESC, cls) AS k FROM v)
    SELECT vec_id, max(cls) FILTER (k = 1) AS pred, max(votes) FILTER (k = 1)::BIGINT AS votes, round((max(votes) FILTER (k = 1) - coalesce(max(votes) FILTER (k = 2), 0)) / 7, 6) AS margin FROM o GROUP BY vec_id""",
)
def majority_vote(spark, d):
    return B.majority_vote(_best(spark, d, 7), 7).select("vec_id", "pred", "votes", F.round("margin", 6).alias("margin"))


@query("b7_recalls", f"WITH {BEST} SELECT gt, count(*)::BIGINT AS n, round(avg((cls = gt)::INT), 6) AS recall FROM best WHERE rank = 1 GROUP BY gt")
def recalls(spark, d):
    predicted = B.predictions(_best(spark, d, 1))
    return predicted.groupBy("gt").agg(F.count("*").alias("n"), F.round(F.avg((F.col("gt") == F.col("pred")).cast("int")), 6).alias("recall"))


@query(
    "b8_class_report",
    f"""WITH {BEST}, p AS (SELECT gt, cls AS pred FROM best WHERE rank = 1), c AS (SELECT DISTINCT gt AS cls FROM p UNION SELECT DISTINCT pred FROM p)
    SELECT cls, count(*) FILTER (gt = cls AND pred = cls)::BIGINT AS tp, count(*) FILTER (gt <> cls AND pred = cls)::BIGINT AS fp, count(*) FILTER (gt = cls AND pred <> cls)::BIGINT AS fn FROM c, p GROUP BY cls""",
)
def class_report(spark, d):
    return B.class_report(B.predictions(_best(spark, d, 1)))


@query(
    "b9_reach",
    f"""WITH {PAIRS}, c AS (SELECT vec_id, cls, max(cos) AS cos, arg_min(gidx, (-cos, gidx)) AS gidx FROM pairs GROUP BY ALL), l AS (SELECT a.gidx, a.cos - max(b.cos) AS lead FROM c a JOIN c b ON a.vec_id = b.vec_id AND a.cls <> b.cls GROUP BY a.vec_id, a.gidx, a.cos)
    SELECT gidx, round(max(lead), 6) AS reach FROM l GROUP BY gidx""",
)
def sentence_reach(spark, d):
    return B.reach(_best(spark, d, 1, True)).select("gidx", F.round("reach", 6).alias("reach"))


_LOO = f"""{BEST}, w AS (SELECT a.vec_id, a.gt, a.grp, a.gidx, a.cls AS c1, b.cls AS c2 FROM best a LEFT JOIN best b ON a.vec_id = b.vec_id AND b.rank = 2 WHERE a.rank = 1)"""


@query("b10_loo_gains", f"WITH {_LOO} SELECT gidx, count(*)::BIGINT AS wins, sum((c2 = gt)::INT - (c1 = gt)::INT)::BIGINT AS gain FROM w GROUP BY gidx")
def loo_gains(spark, d):
    return B.loo_gains(_best(spark, d, 2))


@query("b11_greedy_prune")
def greedy_prune(spark, d):
    return spark.createDataFrame(B.prune(X.frames(spark, d), X.bank(spark, d)), "round long, sentences long, correct long")


@query(
    "b12_wins_and_purity",
    f"WITH {_LOO} SELECT gidx, count(*)::BIGINT AS wins, count(DISTINCT grp)::BIGINT AS groups, round(avg((gt = c1)::INT), 6) AS purity FROM w GROUP BY gidx",
)
def wins_and_purity(spark, d):
    won = B.predictions(_best(spark, d, 1))
    return won.groupBy("gidx").agg(F.count("*").alias("wins"), F.count_distinct("grp").cast("long").alias("groups"), F.round(F.avg((F.col("gt") == F.col("pred")).cast("int")), 6).alias("purity"))


@query("b13_group_win_matrix", f"WITH {_LOO} SELECT gidx, count(*) FILTER (grp = 0)::BIGINT AS g0, count(*) FILTER (grp = 1)::BIGINT AS g1, count(*) FILTER (grp >= 2)::BIGINT AS rest FROM w GROUP BY gidx")
def group_win_matrix(spark, d):
    won = B.predictions(_best(spark, d, 1))
    return won.groupBy("gidx").agg(F.count_if(F.col("grp") == 0).alias("g0"), F.count_if(F.col("grp") == 1).alias("g1"), F.count_if(F.col("grp") >= 2).alias("rest"))


@query(
    "b15_leave_group_out",
    f"""WITH {_LOO}, a AS (SELECT DISTINCT gidx FROM w WHERE grp = 0), b AS (SELECT DISTINCT gidx FROM w WHERE grp <> 0)
    SELECT (SELECT count(*) FROM a)::BIGINT AS held, (SELECT count(*) FROM b)::BIGINT AS others, (SELECT count(*) FROM a JOIN b USING (gidx))::BIGINT AS shared,
        round((SELECT count(*) FROM a JOIN b USING (gidx)) / (SELECT count(*) FROM (SELECT * FROM a UNION SELECT * FROM b)), 6) AS jaccard""",
)
def leave_group_out(spark, d):
    won = B.predictions(_best(spark, d, 1)).groupBy("gidx").agg(F.max((F.col("grp") == 0).cast("int")).alias("h"), F.max((F.col("grp") != 0).cast("int")).alias("o"))
    both = F.sum(F.col("h") * F.col("o"))
    return won.agg(F.sum("h").alias("held"), F.sum("o").alias("others"), both.alias("shared"), F.round(both / F.count("*"), 6).alias("jaccard"))


@query(
    "b16_deletion_score",
    f"""WITH {_LOO}, t AS (SELECT count(*) FILTER (gt = 0) AS nn, count(*) FILTER (gt <> 0) AS na FROM w)
    SELECT gidx, c1 AS cls, round(CASE WHEN c1 <> 0 THEN count(*) FILTER (gt = 0) / any_value(nn) - count(*) FILTER (gt <> 0) / any_value(na) ELSE count(*) FILTER (gt <> 0) / any_value(na) - count(*) FILTER (gt = 0) / any_value(nn) END, 6) AS score FROM w, t GROUP BY gidx, c1""",
)
def deletion_score(spark, d):
    return B.deletion_score(_best(spark, d, 1), F.col("gt") == 0).select("gidx", "cls", F.round("score", 6).alias("score"))


@query("b23_nearest_frame", f"WITH {PAIRS} SELECT gidx, arg_min(vec_id, (-cos, vec_id)) AS frame, round(max(cos), 6) AS cos FROM pairs GROUP BY gidx")
def nearest_frame(spark, d):
    # the roles are swapped: each sentence's best frame
    bank = X.bank(spark, d).select(F.col("gidx").alias("vec_id"), F.col("cls").alias("gt"), F.lit(0).cast("long").alias("grp"), "vec")
    frames = X.frames(spark, d).select(F.col("vec_id").alias("gidx"), F.col("gt").alias("cls"), "vec")
    return B.best_sentences(bank, frames, 1).select(F.col("vec_id").alias("gidx"), F.col("gidx").alias("frame"), F.round("cos", 6).alias("cos"))


_VERSIONS = f"{PAIRS}, pv AS (SELECT vec_id, gt, version, arg_min(cls, (-cos, gidx)) AS pred FROM pairs GROUP BY ALL), ab AS (SELECT a.vec_id, a.gt, a.pred AS pa, b.pred AS pb FROM pv a JOIN pv b ON a.vec_id = b.vec_id AND a.version = 'A' AND b.version = 'B')"


def _versions(spark, d):
    bank = X.bank(spark, d)
    a, b = (B.predictions(B.best_sentences(X.frames(spark, d), bank.where(F.col("version") == v), 1)) for v in "AB")
    return a.select("vec_id", "gt", F.col("pred").alias("pa")).join(b.select("vec_id", F.col("pred").alias("pb")), "vec_id")


@query("b24_version_flips", f"WITH {_VERSIONS} SELECT CASE WHEN pa <> gt AND pb = gt THEN 'improved' WHEN pa = gt AND pb <> gt THEN 'regressed' WHEN pa = gt THEN 'both_right' ELSE 'both_wrong' END AS outcome, count(*)::BIGINT AS n FROM ab GROUP BY 1")
def version_flips(spark, d):
    a, b = F.col("pa") == F.col("gt"), F.col("pb") == F.col("gt")
    outcome = F.when(~a & b, "improved").when(a & ~b, "regressed").when(a, "both_right").otherwise("both_wrong")
    return _versions(spark, d).groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))


@query("b27_confusion", f"WITH {BEST} SELECT gt, cls AS pred, count(*)::BIGINT AS n FROM best WHERE rank = 1 GROUP BY ALL")
def confusion(spark, d):
    return B.predictions(_best(spark, d, 1)).groupBy("gt", "pred").agg(F.count("*").alias("n"))


@query(
    "b26_asset_scores",
    f"""WITH {PAIRS}, r AS (SELECT vec_id % 50 AS asset, cls, cos, row_number() OVER (PARTITION BY vec_id % 50, cls ORDER BY cos DESC, gidx, vec_id) AS k FROM pairs)
    SELECT asset, cls, round(max(cos), 6) AS best, round(avg(cos) FILTER (k <= 10), 6) AS top10 FROM r GROUP BY asset, cls""",
)
def asset_scores(spark, d):
    # a frame can give at most ten of an asset's ten best, so ten a frame and class suffice
    best = B.best_sentences(X.frames(spark, d), X.bank(spark, d), 10, True).withColumn("asset", F.col("vec_id") % 50)
    rank = F.row_number().over(Window.partitionBy("asset", "cls").orderBy(F.desc("cos"), "gidx", "vec_id"))
    return best.withColumn("k", rank).where("k <= 10").groupBy("asset", "cls").agg(F.round(F.max("cos"), 6).alias("best"), F.round(F.avg("cos"), 6).alias("top10"))


@query(
    "b32_low_confidence_tail",
    f"WITH {BEST}, w AS (SELECT vec_id, cos FROM best WHERE rank = 1), t AS (SELECT quantile_cont(cos, 0.1) AS bar FROM w) SELECT vec_id, round(cos, 6) AS cos FROM w, t WHERE cos <= bar",
)
def low_confidence_tail(spark, d):
    won = B.predictions(_best(spark, d, 1))
    bar = won.agg(F.percentile("cos", 0.1).alias("bar"))
    return won.crossJoin(F.broadcast(bar)).where("cos <= bar").select("vec_id", F.round("cos", 6).alias("cos"))


@query("b33_bank_composition", f"WITH {X.FRAMES} SELECT version, cls, count(*)::BIGINT AS n FROM bank GROUP BY ALL")
def bank_composition(spark, d):
    return X.bank(spark, d).groupBy("version", "cls").agg(F.count("*").alias("n"))


@query(
    "b38_slice_ranking",
    f"""WITH {_LOO}, s AS (SELECT gidx, c1 AS cls, count(*) AS wins, count(*) FILTER (gt = c1) AS hits FROM w WHERE grp < 4 GROUP BY ALL HAVING count(*) >= 2)
    SELECT gidx, cls, wins::BIGINT AS wins, round(hits / wins, 4) AS purity, (2 * hits - wins)::BIGINT AS net FROM s QUALIFY row_number() OVER (PARTITION BY cls ORDER BY round(hits / wins, 4) DESC, wins DESC, gidx) <= 5""",
)
def slice_ranking(spark, d):
    won = B.predictions(_best(spark, d, 1)).where("grp < 4").groupBy("gidx", F.col("pred").alias("cls")).agg(F.count("*").alias("wins"), F.count_if(F.col("gt") == F.col("pred")).alias("hits")).where("wins >= 2")
    scored = won.select("gidx", "cls", "wins", F.round(F.col("hits") / F.col("wins"), 4).alias("purity"), (2 * F.col("hits") - F.col("wins")).alias("net"))
    rank = F.row_number().over(Window.partitionBy("cls").orderBy(F.desc("purity"), F.desc("wins"), "gidx"))
    return scored.withColumn("k", rank).where("k <= 5").drop("k")


@query(
    "m16_label_suspects",
    f"""WITH {BEST}, k AS (SELECT vec_id, gt, avg((cls <> gt)::INT) AS disagree, max((cls = gt)::INT) AS any_same FROM best WHERE rank <= 10 GROUP BY ALL)
    SELECT vec_id, round(least(1.0, 0.6 * disagree + 0.4 * (1 - any_same)), 6) AS suspicion FROM k ORDER BY round(least(1.0, 0.6 * disagree + 0.4 * (1 - any_same)), 6) DESC, vec_id LIMIT 200""",
)
def label_suspects(spark, d):
    near = _best(spark, d, 10).groupBy("vec_id", "gt").agg(F.avg((F.col("cls") != F.col("gt")).cast("int")).alias("disagree"), F.max((F.col("cls") == F.col("gt")).cast("int")).alias("same"))
    scored = near.select("vec_id", F.round(F.least(F.lit(1.0), 0.6 * F.col("disagree") + 0.4 * (1 - F.col("same"))), 6).alias("suspicion"))
    return scored.orderBy(F.desc("suspicion"), "vec_id").limit(200)


@query(
    "m10_recall_at_k",
    f"WITH {BEST}, h AS (SELECT vec_id, max((cls = gt AND rank <= 1)::INT) AS h1, max((cls = gt AND rank <= 3)::INT) AS h3 FROM best GROUP BY vec_id) SELECT round(avg(h1), 6) AS recall1, round(avg(h3), 6) AS recall3 FROM h",
)
def recall_at_k(spark, d):
    hit = lambda k: F.max(((F.col("cls") == F.col("gt")) & (F.col("rank") <= k)).cast("int"))
    hits = _best(spark, d, 3).groupBy("vec_id").agg(hit(1).alias("h1"), hit(3).alias("h3"))
    return hits.agg(F.round(F.avg("h1"), 6).alias("recall1"), F.round(F.avg("h3"), 6).alias("recall3"))
