"""Small fixtures for operators whose edge cases the driver's tables don't have."""

import json
import math

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.operators import detection as D
from millrace.operators import intervals as I
from millrace.operators import relational as R
from millrace.operators import sampling as P
from millrace.operators.filters import apply_filters, ids_of
from millrace.operators.phash import nearest_groups, similar
from millrace.operators.review import transition
from millrace.plans import registry
from millrace.sources import files
from millrace.streaming import monitors as M


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_chunk_plan_stops_at_the_end(spark):
    plan = lambda d: [(c.idx, c.start, c.end) for c in one(spark, I.plan_chunks(F.lit(d)))]
    assert plan(0.0) == [] and plan(-1.0) == []
    assert plan(660.0) == [(1, 0.0, 660.0)]
    assert plan(1300.0) == [(1, 0.0, 660.0), (2, 600.0, 1260.0), (3, 1200.0, 1300.0)]


def test_clip_window_is_clamped(spark):
    clip = lambda s, e, d: tuple(one(spark, F.struct(*[c.alias(n) for c, n in zip(I.clip_window(F.lit(s), F.lit(e), F.lit(d)), "ab", strict=True)])))
    assert clip(60.0, 70.0, 300.0) == (55.0, 75.0)
    assert clip(290.0, 298.0, 300.0) == (285.0, 300.0)


def test_merge_compares_the_last_event_only(spark):
    events = [(0.0, 5.0, "a", "x", 1), (4.0, 6.0, "b", "", 1), (5.0, 7.0, "a", "longer", 1), (7.0, 9.0, "A", "y", 1), (20.0, 21.0, None, "z", 1), (20.5, 22.0, None, "z", 1)]
    frame = spark.createDataFrame([(events,)], f"e array<{I.EVENT}>")
    got = frame.select(I.merge_events(F.col("e")).alias("m")).first().m
    assert [(m.start, m.end, m.category, m.caption, m["count"]) for m in got] == [(0.0, 5.0, "a", "x", 1), (4.0, 6.0, "b", "", 1), (5.0, 9.0, "a", "longer", 2), (20.0, 21.0, None, "z", 1), (20.5, 22.0, None, "z", 1)]


def test_interval_join_makes_each_pair_once(spark):
    left = spark.createDataFrame([(1, 0.0, 25.0), (1, 9.0, 10.0)], "k int, s double, e double")
    right = spark.createDataFrame([(1, 5.0, 40.0), (1, 10.0, 12.0), (2, 0.0, 9.0)], "k int, a double, b double")
    got = I.overlapping(left, right, "k", ("s", "e"), ("a", "b"), 10.0).select("s", "a").collect()
    assert sorted(map(tuple, got)) == [(0.0, 5.0), (0.0, 10.0), (9.0, 5.0)]


def test_timestamps(spark):
    assert one(spark, I.interval_timestamps(F.lit(0.0), 1.0)) == [0.0]
    assert one(spark, I.interval_timestamps(F.lit(2.5), 1.0)) == [0.0, 1.0, 2.0]
    assert one(spark, I.even_timestamps(F.lit(10.0), F.lit(3))) == [1.0, 5.0, 9.0]


def test_upsert_and_guard(spark):
    base = spark.createDataFrame([(1, "a"), (2, "final"), (None, "n")], "k int, v string")
    new = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z"), (None, "m")], "k int, v string")
    rows = lambda f: sorted(map(tuple, f.collect()), key=str)
    assert rows(R.upsert(base, new, ["k"])) == rows(spark.createDataFrame([(1, "x"), (2, "y"), (3, "z"), (None, "m")], base.schema))
    assert rows(R.upsert(base, new, ["k"], F.col("v") == "final")) == rows(spark.createDataFrame([(1, "x"), (2, "final"), (3, "z"), (None, "m")], base.schema))


def test_priority_rows_are_never_cut(spark):
    frame = spark.range(10).withColumn("u", F.col("id") >= 6)
    assert sorted(r.id for r in R.prioritised(frame, F.col("u"), 2, [F.asc("id")]).collect()) == [6, 7, 8, 9]
    assert sorted(r.id for r in R.prioritised(frame, F.col("u"), 6, [F.asc("id")]).collect()) == [0, 1, 6, 7, 8, 9]


@pytest.mark.parametrize(("done", "failed", "total", "state"), [(3, 0, 3, "succeeded"), (0, 3, 3, "failed"), (2, 1, 3, "partial_success"), (1, 0, 3, "running"), (0, 0, 3, "pending"), (0, 0, 0, "pending")])
def test_job_status(spark, done, failed, total, state):
    assert one(spark, R.job_status(F.lit(done), F.lit(failed), F.lit(total))) == state


def test_filter_edge_cases(spark):
    frame = spark.createDataFrame([(1, ""), (2, None), (3, "ab")], "n int, s string")
    ids = lambda *items, **k: sorted(r.n for r in apply_filters(frame, {"items": list(items), **k}).collect())
    assert ids({"filter": "s", "operator": "empty", "value": True}) == [1, 2]
    assert ids({"filter": "s", "operator": "regex", "value": "("}) == []
    assert ids({"filter": "n", "operator": "equal", "value": None}) == [1, 2, 3]
    assert ids({"filter": "n", "operator": "in_list", "value": ids_of("1 3,9")}) == [1, 3]
    assert ids({"filter": "s", "operator": "not_contains", "value": "B"}) == [1, 2]


def test_boxes_keep_their_place(spark):
    doc = {"images": [], "categories": [{"id": 1, "name": "car"}], "annotations": [{"id": 1, "image_id": 5, "category_id": 1, "bbox": [0, 0, 2.004, 2], "score": 1.5}, {"id": 2, "image_id": 5, "category_id": 1, "bbox": [0, 0, 0, 2]}, {"id": 3, "image_id": 5, "category_id": 9, "bbox": [1, 1, 3, 3], "score": 0.5}]}
    docs = spark.createDataFrame([("k", json.dumps(doc))], "key string, j string").select("key", F.from_json("j", D.COCO).alias("d"))
    got = sorted((r.box_index, r.category, r.w, r.score) for r in D.parse_boxes(docs, "key", "d").collect())
    assert got == [(0, "car", 2.0, None), (2, "9", 3.0, 0.5)]


def test_greedy_match_takes_each_box_once(spark):
    rows = [(1, 1, 0.9, 1, 1, 1, 0.6), (1, 1, 0.9, 1, 2, 2, 0.8), (1, 2, 0.8, 2, 2, 2, 0.9), (1, 2, 0.8, 2, 1, 1, 0.55), (1, 3, 0.7, 3, 1, 1, 0.99)]
    pairs = spark.createDataFrame(rows, "g int, pred long, score double, pred_pos int, truth long, truth_pos int, iou double")
    assert sorted((r.pred, r.truth) for r in D.greedy_matches(pairs, ["g"], 0.5).collect()) == [(1, 2), (2, 1)]


def test_coco_merge_renumbers(spark):
    images = spark.createDataFrame([("a", 7, "x"), ("b", 7, "y"), ("b", 9, "z")], "source string, id long, file_name string")
    annotations = spark.createDataFrame([("a", 1, 7, 3), ("b", 1, 7, 4), ("b", 2, 8, 4)], "source string, id long, old_image_id long, category_id long")
    categories = spark.createDataFrame([("a", 3, "dog"), ("b", 4, "dog")], "source string, id long, name string")
    new_images, new_annotations, new_categories = D.merge_coco(images, annotations, categories)
    assert sorted((r.image_id, r.file_name) for r in new_images.collect()) == [(1, "x"), (2, "y"), (3, "z")]
    assert sorted((r.annotation_id, r.image_id) for r in new_annotations.collect()) == [(1, 1), (2, 2)]
    assert [(r.category_id, r["name"]) for r in new_categories.collect()] == [(1, "dog")]


def test_split_keeps_groups_apart(spark):
    frame = spark.range(100).withColumn("g", F.col("id") % 9)
    got = {r.g: r.split for r in D.grouped_split(frame, "g", "s", (0.8, 0.1)).collect()}
    assert len(got) == 9 and set(got.values()) == {"train", "val", "test"}


def test_phash_high_bit(spark):
    frame = spark.createDataFrame([(1, "ffffffffffffffff"), (2, "fffffffffffffffe"), (3, "0000000000000000")], "k long, h string")
    pairs = similar(frame, frame, "k", "h", 5)
    assert sorted((r.k, r.other, r.distance) for r in pairs.collect()) == [(1, 2, 1), (2, 1, 1)]
    assert {r.k: r.dup_group for r in nearest_groups(pairs, "k").collect()} == {1: "dup_1_2", 2: "dup_1_2"}


def test_review_transition(spark):
    state = lambda *a: one(spark, transition(*(F.lit(x) for x in a)))
    assert state("approve", "admin", "pending", True, "") == "approved"
    assert state("approve", "reviewer", "approved", True, "") == "approved"
    assert state("approve", "reviewer", "pending", False, "") == "pending"
    assert state("reject", "reviewer", "pending", True, " ") == "pending"


def test_text_functions(spark):
    assert one(spark, S.parse_tags(F.lit('["a", " b "]'))) == ["a", "b"]
    assert one(spark, S.without_fences(F.lit('```json\n{"a":1}\n```'))) == '{"a":1}'
    assert one(spark, S.mcnemar(F.lit(0), F.lit(0))) == 1.0
    assert abs(one(spark, S.mcnemar(F.lit(1), F.lit(5))) - 0.21875) < 1e-12


def test_ledger_last_record_wins(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"k":"x","v":1}\nbroken\n{"k":"y","v":2}\n')
    (tmp_path / "b.jsonl").write_text('{"k":"x","v":3}\n')
    got = files.read_ledger(spark, str(tmp_path), "k string, v int", "k")
    assert sorted(map(tuple, got.collect())) == [("x", 3), ("y", 2)]


def test_bank_rows_keep_their_index(spark, tmp_path):
    (tmp_path / "bank.csv").write_text('prompt,class\n"a, b",1\n,2\nc,3\n')
    got = files.read_bank(spark, str(tmp_path / "bank.csv"))
    assert sorted((r.gidx, r.prompt) for r in got.collect()) == [(0, "a, b"), (2, "c")]


def test_sealed_data_sets(spark, tmp_path):
    path = f"{tmp_path}/set"
    with pytest.raises(FileNotFoundError):
        files.read_sealed(spark, path, "rows")
    files.seal({"rows": spark.range(3)}, path)
    assert files.read_sealed(spark, path, "rows").count() == 3
    assert files.list_files(spark, path, ["parquet"]).count() >= 1
    assert files.replace_table(spark.range(2).toDF("id"), f"{tmp_path}/t") == (0, 2)
    assert files.replace_table(spark.range(5).toDF("id"), f"{tmp_path}/t") == (2, 5)


def stream(spark, frame, path, build, schema=None):
    frame.write.mode("overwrite").parquet(path)
    out = build(spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(path))
    name = "s" + str(abs(hash(path)))
    query = out.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination(120)
    return spark.table(name).collect()


def test_stable_units(spark, tmp_path):
    rows = [("u", "directory", s, 0, m, f"2024-01-01 00:0{i}:00") for i, (s, m) in enumerate([("a", True), ("b", True), ("b", False), ("b", True), ("b", True)])]
    scans = spark.createDataFrame(rows, "unit_key string, unit_type string, signature string, max_mtime long, has_marker boolean, t string").withColumn("scan_ts", F.to_timestamp("t")).drop("t").coalesce(1)
    got = stream(spark, scans, f"{tmp_path}/scans", lambda s: M.stable_units(s, 2, 60))
    assert [(r.unit_key, r.signature, r.cycles) for r in got] == [("u", "b", 3)]


def test_retries_are_dropped_once(spark, tmp_path):
    rows = spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:00:05"), ("b", "2024-01-01 00:00:09")], "k string, t string").select("k", F.to_timestamp("t").alias("ts")).coalesce(1)
    got = stream(spark, rows, f"{tmp_path}/retries", lambda s: M.first_of_key(s, ["k"], "ts", "1 minute"))
    assert sorted(r.k for r in got) == ["a", "b"]


def test_near_duplicates_of_every_embedding_are_paired(spark, tmp_path):
    vectors = {3: [1.0, 0.0], 7: [0.9, 0.1], 10: [0.0, 1.0], 12: [0.1, 0.9], 100: [1.0, 0.05], 101: [-1.0, 0.0]}
    spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = registry.queries()["j12_near_duplicate_pairs"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == [(3, 7), (3, 100), (7, 100), (10, 12)]


def test_tree_deltas(spark):
    changes = spark.createDataFrame([("a/b/x", "create", 5), ("a/b/y", "create", 2), ("a/b/x", "delete", 5), ("a/z", "create", 1)], "p string, kind string, n int")
    got = M.tree_deltas(changes, "p", F.col("kind"), F.col("n"))
    assert sorted(map(tuple, got.collect())) == [("a", 2, 3), ("a/b", 1, 2)]


def test_mcnemar_of_many_cases(spark):
    cases = [(0, 0), (0, 5), (5, 0), (1, 9), (3, 3), (600, 600), (600, 480), (2000, 1900), (537, 538)]
    rows = spark.createDataFrame(cases, "b long, c long").select("b", "c", S.mcnemar(F.col("b"), F.col("c")).alias("p")).collect()
    for r in rows:
        n = r.b + r.c
        exact = min(1.0, 2 * sum(math.comb(n, i) for i in range(min(r.b, r.c) + 1)) / 2**n) if n else 1.0
        assert math.isclose(r.p, exact, rel_tol=1e-9)


def test_numbers_of_one_large_source(spark):
    rows = spark.range(5000).select(F.when(F.col("id") < 4800, "a").otherwise("b").alias("source"), ((F.col("id") * 7919) % 5000).alias("id"))
    got = [(r.source, r.id, r.k) for r in D.numbered(rows, ["source", "id"], "k").collect()]
    assert [k for *_, k in sorted(got)] == list(range(1, 5001))


def test_global_greedy_takes_the_best_pair_first(spark):
    rows = [(1, 1, 1, 0.6), (1, 1, 2, 0.9), (1, 2, 2, 0.95), (1, 2, 1, 0.1), (1, 3, 3, 0.0), (2, 1, 1, 0.5), (2, 2, 1, 0.5)]
    pairs = spark.createDataFrame(rows, "image int, pred int, truth int, iou double")
    assert sorted(map(tuple, D.global_greedy_matches(pairs, ["image"]).collect())) == [(1, 1, 1, 0.6), (1, 2, 2, 0.95), (2, 1, 1, 0.5)]
    assert D.global_greedy_matches(pairs.limit(0), ["image"]).count() == 0


def test_server_detections_of_odd_answers(spark):
    answers = [(1, None), (2, "no json"), (3, "[]"), (4, '[{"mask_bbox":[1,2,3,4]},{"prompt_class":"A"},{"prompt_class":" B ","mask_bbox":[1,2,3,4]}]')]
    got = spark.createDataFrame(answers, "id int, answer string").select("id", D.detections_of(F.col("answer")).alias("d")).orderBy("id").collect()
    assert got[0]["d"] is None and not got[1]["d"] and got[2]["d"] == []
    assert [tuple(e) for e in got[3]["d"]] == [("b", [1.0, 2.0, 3.0, 4.0], None)]


def test_bootstrap_interval_holds_the_mean(spark):
    rows = [("a", i % 4 == 0) for i in range(4000)] + [("b", True)] * 20 + [("c", None), ("c", False)]
    got = {r["g"]: r for r in P.bootstrap_interval(spark.createDataFrame(rows, "g string, hit boolean"), "g", "hit", seed=3).collect()}
    # 1.96 standard errors of a mean of 4,000
    assert got["a"]["mean"] == 0.25 and abs(got["a"]["low"] - 0.2366) < 0.003 and abs(got["a"]["high"] - 0.2634) < 0.003
    assert (got["b"]["low"], got["b"]["high"]) == (1.0, 1.0) and (got["c"]["n"], got["c"]["mean"], got["c"]["high"]) == (2, 0.0, 0.0)


def test_silhouettes_of_odd_rows(spark):
    rows = [(1, [1.0, 0.0], "a"), (2, [0.9, 0.1], "a"), (3, [0.0, 1.0], "b"), (4, None, "a"), (5, [0.0, 0.0], "b"), (6, [1.0, 1.0], None), (7, [None, 1.0], "b")]
    frame = spark.createDataFrame(rows, "id int, v array<double>, c string")
    got = {r["id"]: r["silhouette"] for r in P.silhouettes(frame, "id", "v", "c").collect()}
    near = 1 - 0.9 / math.hypot(0.9, 0.1)
    assert set(got) == {1, 2, 3} and got[3] == 0.0 and math.isclose(got[1], 1 - near, abs_tol=1e-12)
    assert P.silhouettes(frame.where("c = 'a'"), "id", "v", "c").count() == 0


def test_label_queue_keeps_a_share_of_the_others(spark):
    rows = [(i, 0.9, 0.9, 0.9) for i in range(10)] + [(100 + i, 0.1, None, 0.1) for i in range(3)]
    pool = spark.createDataFrame(rows, "id int, rare double, rep double, uniq double")
    got = P.label_queue(pool, "id", n=6).orderBy("place").collect()
    assert [r["id"] for r in got] == [0, 1, 2, 3, 100, 101] and [r["near"] for r in got] == [True] * 4 + [False] * 2
    assert P.label_queue(pool, "id", n=50).count() == 13 and P.label_queue(pool.limit(0), "id", n=5).count() == 0


def test_clusters_name_their_most_common_label(spark):
    got = registry.queries()["v13_clusters"](spark, "/root/testdata/sf0.001").toPandas()
    assert got["cluster"].nunique() <= 8 and got["vec_id"].is_unique
    for _, rows in got.groupby("cluster"):
        counts = rows["label"].value_counts()
        assert rows["dominant"].nunique() == 1 and counts[rows["dominant"].iloc[0]] == counts.max()


def test_event_quality_counts_every_event(spark):
    folder = "/root/testdata/sf0.001"
    row = registry.queries()["m6_event_quality"](spark, folder).first()
    events = spark.read.parquet(f"{folder}/events.parquet").where("value > 0")
    assert row["tp"] > 0 and row["tp"] + row["fp"] == events.where("event_id % 3 <> 0").count() and row["tp"] + row["fn"] == events.count()


def test_thousandths_round_the_binary_value(spark):
    values = [0.0, 0.0625, 0.1875, 1.0005, 2.0005, 0.9995, 999.9996, 12345.678, 2.0**49 + 0.0625, math.inf, math.nan, *((2 * i + 1) / 2000 for i in range(500))]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", S.thousandths(F.col("v")).alias("t")).collect()
    assert [r.t for r in rows] == [f"{r.v:.3f}" for r in rows]


def _event_table(spark, folder, rows):
    """Rows of (event_id, seconds since the first day, user_id, event_type, value) as an events table."""
    made = spark.createDataFrame(rows, "event_id long, s double, user_id long, event_type string, value double")
    moment = F.timestamp_micros((F.lit(1704067200.0) + F.col("s")).cast("long") * 1000000).cast("timestamp_ntz")
    made.select("event_id", moment.alias("ts"), "user_id", "event_type", "value", F.lit("{}").alias("props")).write.parquet(f"{folder}/events.parquet")
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet/*.parquet'")
    return con


def test_days_without_a_sound_event_have_no_row(spark, tmp_path):
    rows = [(1, 10.0, 1, "view", 0.0), (2, 90000.0, 1, "view", 2.5), (3, 20.0, 2, "click", 0.0001), (4, 30.0, 2, "click", 0.0), (5, 40.0, 3, None, 1.0), (6, 50.0, 4, None, 1.0), (7, 60.0, 4, "error", 0.0625 / 600)]
    con = _event_table(spark, tmp_path, rows)
    got = registry.queries()["e2_normalised_events"](spark, str(tmp_path)).select("asset_id", "day", "events").collect()
    expected = con.sql(registry.oracle_sql()["e2_normalised_events"]).fetchall()
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    assert (1, 0) not in {(r.asset_id, r.day) for r in got} and len(got) == 4


def _plain_ap(rows):
    """All-point AP of (hit, score, tie) rows, one after another."""
    odd = lambda s: (2, 0.0) if s is None else (0, 0.0) if math.isnan(s) else (1, -s)
    ranked = [bool(hit) for hit, _, _ in sorted(rows, key=lambda r: (odd(r[1]), r[2]))]
    precision = [sum(ranked[: i + 1]) / (i + 1) for i in range(len(ranked))]
    return sum(max(precision[i:]) for i, hit in enumerate(ranked) if hit) / len(ranked)


@pytest.mark.parametrize("blocks", [2, 7, 64])
def test_average_precision_across_blocks(spark, blocks):
    mixed = [(i * 7 % 3 == 0 or i % 11 == 4, [None, math.nan, 5.0, 5.0, -0.0, 0.0, i % 13 - 4.5][i % 7], i * 37 % 401) for i in range(401)]
    groups = {"mixed": mixed, None: [(i % 3 > 0, 1.0, i) for i in range(100)], "blank": [(None, 2.0, 1), (True, 1.0, 2)]}
    scored = spark.createDataFrame([(k, *r) for k, rows in groups.items() for r in rows], "category string, hit boolean, score double, tie long")
    got = {r.category: r.ap for r in D.average_precision(scored, "category", "score", "tie", blocks=blocks).collect()}
    assert got == {k: pytest.approx(_plain_ap(rows)) for k, rows in groups.items()}
    given = D.average_precision(scored.withColumn("boxes", F.lit(1000)), "category", "score", "tie", "boxes", blocks)
    assert {r.category: r.ap for r in given.collect()}["blank"] == pytest.approx(0.5 / 1000)


def test_average_precision_is_linear(spark, tmp_path):
    rows = [(i, float(i), 1, "view", i % 97 + 0.5) for i in range(1000)]
    con = _event_table(spark, tmp_path, rows)
    found = registry.queries()["m4_average_precision"](spark, str(tmp_path))
    assert [tuple(r) for r in found.select("category", "ap").collect()] == con.sql(registry.oracle_sql()["m4_average_precision"]).fetchall()
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "currentrow$(), unboundedfollowing" not in plan.lower()
