"""Detection documents and box evaluation: parsing, merging, matching and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.scalars import f1

COCO = (
    "struct<images:array<struct<id:long,file_name:string,width:double,height:double>>,"
    "annotations:array<struct<id:long,image_id:long,category_id:long,bbox:array<double>,score:double>>,"
    "categories:array<struct<id:long,name:string>>>"
)


def parse_boxes(docs: DataFrame, key: str, doc: str) -> DataFrame:
    """(key, image_id, box_index, category, x, y, w, h, score) of each sound annotation.

    box_index is the place in the array, skipped ones included. A box needs four
    numbers and a positive size; a score outside 0..1 is null; an unknown category
    is called by its id.
    """
    names = F.map_from_entries(F.transform(F.filter(f"{doc}.categories", lambda c: c["id"].isNotNull()), lambda c: F.struct(c["id"], c["name"])))
    rows = docs.select(key, names.alias("_names"), F.posexplode(f"{doc}.annotations").alias("box_index", "a"))
    box = lambda i: F.try_element_at("a.bbox", F.lit(i))
    sound = (F.size("a.bbox") == 4) & box(3).isNotNull() & box(4).isNotNull() & (box(3) > 0) & (box(4) > 0) & box(1).isNotNull() & box(2).isNotNull()
    score = F.when(F.col("a.score").between(0, 1), F.col("a.score"))
    category = F.coalesce(F.try_element_at("_names", F.col("a.category_id")), F.col("a.category_id").cast("string"))
    return rows.where(F.coalesce(sound, F.lit(False))).select(
        key, F.col("a.image_id").alias("image_id"), "box_index", category.alias("category"), *(F.round(box(i), 2).alias(n) for i, n in enumerate("xywh", 1)), score.alias("score")
    )


def merge_coco(images: DataFrame, annotations: DataFrame, categories: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One data set of several sources; ids are renumbered from 1 in order of (source, id).

    Categories are unified by name, numbered by their first kept annotation.
    Annotations without image or category are left out. Images without annotations
    stay. Numbering is a rank over sources, dealt by (source, block) offsets upstream
    of a single sort only for the small category table.
    """
    new_images = numbered(images.select("source", "id", "file_name"), ["source", "id"], "image_id")
    named = annotations.join(categories.select("source", F.col("id").alias("category_id"), "name"), ["source", "category_id"])
    kept = named.join(new_images.select("source", F.col("id").alias("old_image"), "image_id"), (named["source"] == new_images["source"]) & (named["old_image_id"] == F.col("old_image"))).select(
        named["source"], named["id"], "image_id", "name"
    )
    kept = numbered(kept, ["source", "id"], "annotation_id")
    first = kept.groupBy("name").agg(F.min("annotation_id").alias("first"))
    new_categories = first.withColumn("category_id", F.row_number().over(Window.orderBy("first")).cast("long")).select("category_id", "name")
    return new_images, kept.join(F.broadcast(new_categories), "name"), new_categories


def numbered(frame: DataFrame, order: list[str], name: str, blocks: int = 64) -> DataFrame:
    """Number rows from 1 in the order of columns, none of them null.

    Rows are dealt to blocks by the first column and, where the second is a number, by
    ``blocks`` ranges of it, so that one large value of the first is many groups. Blocks
    are counted first; only their counts are summed in one task.
    """
    lead = order[0]
    cut = F.lit(0)
    if len(order) > 1 and frame.schema[order[1]].dataType.typeName() in ("integer", "long", "double", "float", "short", "byte"):
        bounds = frame.agg(F.percentile_approx(order[1], [i / blocks for i in range(1, blocks)], 10_000).alias("b")).first()["b"] or []
        cut = F.lit(0)
        for bound in sorted(set(bounds)):
            cut = cut + (F.col(order[1]) > F.lit(bound)).cast("int")
    dealt = frame.withColumn("_block", cut)
    counts = dealt.groupBy(lead, "_block").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy(lead, "_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    rank = F.row_number().over(Window.partitionBy(lead, "_block").orderBy(*order[1:]))
    return dealt.withColumn("_rank", rank).join(before, [lead, "_block"]).withColumn(name, (F.col("_before") + F.col("_rank")).cast("long")).drop("_rank", "_before", "_block")


def greedy_matches(pairs: DataFrame, group: list[str], threshold: float) -> DataFrame:
    """(group, pred, truth, iou) of greedy matching inside each group.

    ``pairs`` has one row per prediction and truth box of a group: pred, score, pred_pos,
    truth, truth_pos, iou. Predictions go by score, then position; each takes the free
    truth box of the largest IoU (the first of equals) if that reaches the threshold.
    A group is one image's boxes of one class; its ordered pairs are folded in the JVM.
    """
    pair = F.struct((-F.col("score")).alias("s"), "pred_pos", "pred", (-F.col("iou")).alias("i"), "truth_pos", "truth", "iou")
    state = "struct<seen:array<long>,used:array<long>,found:array<struct<pred:long,truth:long,iou:double>>>"
    start = F.struct(F.array().alias("seen"), F.array().alias("used"), F.array().alias("found")).cast(state)

    def step(acc, p):
        free = ~F.array_contains(acc["seen"], p["pred"]) & ~F.array_contains(acc["used"], p["truth"])
        hit = F.struct(p["pred"].cast("long").alias("pred"), p["truth"].cast("long").alias("truth"), p["iou"].alias("iou"))
        seen = F.array_append(acc["seen"], p["pred"].cast("long"))
        matched = F.struct(seen.alias("seen"), F.array_append(acc["used"], p["truth"].cast("long")).alias("used"), F.array_append(acc["found"], hit).alias("found"))
        missed = F.struct(seen.alias("seen"), acc["used"].alias("used"), acc["found"].alias("found"))
        return F.when(free & (p["iou"] >= threshold), matched).when(free, missed).otherwise(acc).cast(state)

    ordered = F.array_sort(F.collect_list(pair))
    folded = pairs.groupBy(*group).agg(F.aggregate(ordered, start, step, lambda acc: acc["found"]).alias("found"))
    return folded.select(*group, F.inline("found"))


def _true_of(conditions: list[Column]) -> Column:
    """How many of the conditions hold, of which none does after one that doesn't; by bisection."""

    def pick(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high + 1) // 2
        return F.when(conditions[middle - 1], pick(middle, high)).otherwise(pick(low, middle - 1))

    return pick(0, len(conditions))


def average_precision(scored: DataFrame, category: str, score: str, tie: str, n_gt: str | None = None, blocks: int = 64) -> DataFrame:
    """(category, ap): all-point AP over rows of category, hit, score and tie; n_gt (of a category) is its row count without such a column.

    Rows rank by falling score, null scores last, then by ``tie``, a number without nulls that tells rows of one score apart.
    Precision is made monotone from the right; AP is its sum over the hits, over n_gt.

    Rows are dealt to blocks in the order of ranks: ranges of the score and, for scores so common that they fill a
    range, ranges of ``tie``. What is before and behind a block comes from one row for each, so no task holds a category;
    the bounds are approximate and decide the sizes of blocks alone.
    """
    total = F.col(n_gt) if n_gt else F.lit(None).cast("long")
    rows = scored.select(F.col(category).alias("_k"), F.coalesce("hit", F.lit(False)).cast("int").alias("_hit"), F.col(score).cast("double").alias("_s"), F.col(tie).alias("_t"), total.alias("_g"))
    cuts = [i / blocks for i in range(1, blocks)]
    seen = rows.agg(F.percentile_approx(F.when(~F.isnan("_s"), F.col("_s")), cuts, 10_000).alias("s"), F.percentile_approx("_t", cuts, 10_000).alias("t")).first()
    bounds, heavy, falling = seen["s"] or [], set(), []
    for bound in sorted(set(bounds), reverse=True):
        falling.append(F.col("_s") <= F.lit(bound))
        if bounds.count(bound) > 1:
            heavy.add(bound)
            falling.append(F.col("_s") < F.lit(bound))
    place = F.when(F.col("_s").isNull(), 2 * blocks).when(F.isnan("_s"), 0).otherwise(_true_of(falling) + 1)
    common = F.col("_s").isNull() | F.isnan("_s") | F.col("_s").isin(*heavy)
    within = F.when(common, _true_of([F.col("_t") > F.lit(t) for t in sorted(set(seen["t"] or []))])).otherwise(0)
    dealt = rows.withColumn("_at", place * blocks + within)

    kind = Window.partitionBy("_key")
    up_to = kind.orderBy("_block")
    keyed = lambda frame, *more: frame.groupBy(F.col("_k").alias("_key"), F.col("_at").alias("_block"), *more)
    same = F.col("_k").eqNullSafe(F.col("_key")) & (F.col("_at") == F.col("_block"))
    counts = keyed(dealt).agg(F.count("*").alias("_n"), F.sum("_hit").alias("_h"), F.max("_g").alias("_m"))
    known = F.max("_m").over(kind) if n_gt else F.sum("_n").over(kind)
    offsets = counts.select("_key", "_block", (F.sum("_n").over(up_to) - F.col("_n")).alias("_ranks"), (F.sum("_h").over(up_to) - F.col("_h")).alias("_hits"), known.alias("_total"))
    block = Window.partitionBy("_k", "_at")
    falls = block.orderBy(F.desc_nulls_last("_s"), "_t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # a frame that ends behind all rows is summed anew for each row; one that begins before them isn't
    rises = block.orderBy(F.asc_nulls_first("_s"), F.desc("_t")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    curve = dealt.join(offsets, same).withColumn("_p", (F.col("_hits") + F.sum("_hit").over(falls)) / (F.col("_ranks") + F.row_number().over(falls)))
    steps = curve.withColumn("_best", F.max("_p").over(rises)).groupBy("_k", "_at", "_best").agg(F.sum("_hit").alias("_n"), F.max("_total").alias("_total"))
    behind = kind.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    later = keyed(steps).agg(F.max("_best").alias("_m")).select("_key", "_block", F.max("_m").over(behind).alias("_later"))
    area = F.sum(F.col("_n") * F.greatest("_best", "_later"))
    return steps.join(later, same).groupBy(F.col("_k").alias(category)).agg((area / F.max("_total")).alias("ap"))


def quality(counts: DataFrame) -> DataFrame:
    """Add precision, recall and f1, rounded to 6 digits, to rows of tp, fp and fn."""
    p, r, f = f1(F.col("tp"), F.col("fp"), F.col("fn"))
    return counts.withColumns({"precision": F.round(p, 6), "recall": F.round(r, 6), "f1": F.round(f, 6)})


def promotion_gate(metrics: DataFrame, margin: float, floor: float) -> DataFrame:
    """(promote, reason) from rows of metric, old and new; the primary metric is 'map', others are per class.

    Promote when the primary gains at least the margin and no class loses more than the floor.
    """
    delta = F.col("new") - F.col("old")
    primary = F.max(F.when(F.col("metric") == "map", delta))
    worst = F.min(F.when(F.col("metric") != "map", delta))
    reason: Column = F.when(primary.isNull(), "no_primary").when(primary < margin, "below_margin").when(worst < floor, "class_regression").otherwise("ok")
    return metrics.agg(reason.alias("reason")).select((F.col("reason") == "ok").alias("promote"), "reason")


def grouped_split(frame: DataFrame, key: str, seed: str, ratios: tuple[float, float]) -> DataFrame:
    """(key, split): keys in the order of a seeded hash, cut at the ratios; no key is in two splits.

    With three keys or more, val and test get one at least. Ranks come from hash
    ranges that are counted first, so no task sorts all keys.
    """
    hashed = frame.select(key).distinct().withColumn("_h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256))
    ranked = numbered(hashed.withColumn("_block", F.substring("_h", 1, 2)).select("_block", "_h", key), ["_block", "_h", key], "_k")
    total = ranked.agg(F.count("*").alias("_n"))
    n = F.col("_n")
    val = F.greatest(F.floor(n * ratios[1]), F.when(n >= 3, 1).otherwise(0))
    test = F.greatest(n - F.floor(n * ratios[0]) - F.floor(n * ratios[1]), F.when(n >= 3, 1).otherwise(0))
    split = F.when(F.col("_k") <= n - val - test, "train").when(F.col("_k") <= n - test, "val").otherwise("test")
    return ranked.crossJoin(F.broadcast(total)).select(key, split.alias("split"))


def global_greedy_matches(pairs: DataFrame, group: list[str]) -> DataFrame:
    """(group, pred, truth, iou): pairs of a group by falling IoU above 0, then pred and truth; each box is used once.

    ``pairs`` has pred, truth and iou. A group is one image's boxes; pairs that don't overlap never reach it.
    """
    pair = F.struct((-F.col("iou")).alias("i"), F.col("pred").cast("long").alias("pred"), F.col("truth").cast("long").alias("truth"), "iou")
    state = "array<struct<pred:long,truth:long,iou:double>>"

    def step(found, p):
        used = F.exists(found, lambda m: (m["pred"] == p["pred"]) | (m["truth"] == p["truth"]))
        return F.when(used, found).otherwise(F.array_append(found, F.struct(p["pred"].alias("pred"), p["truth"].alias("truth"), p["iou"].alias("iou")).cast(state[6:-1])))

    ordered = F.array_sort(F.collect_list(pair))
    folded = pairs.where("iou > 0").groupBy(*group).agg(F.aggregate(ordered, F.array().cast(state), step).alias("found"))
    return folded.select(*group, F.inline("found"))


def detections_of(answer: Column) -> Column:
    """Array of class, bbox and confidence from a segmentation server's JSON list.

    An entry has prompt_class, mask_bbox (four corners) and score. Entries without a class or
    with fewer than four numbers are dropped; the class is trimmed and lower-cased; null answers give null.
    """
    entries = F.from_json(answer, "array<struct<prompt_class:string,mask_bbox:array<double>,score:double>>")
    label = lambda e: F.lower(F.trim(e["prompt_class"]))
    kept = F.filter(entries, lambda e: (F.coalesce(label(e), F.lit("")) != "") & (F.coalesce(F.size(e["mask_bbox"]), F.lit(0)) >= 4))
    return F.transform(kept, lambda e: F.struct(label(e).alias("class"), F.slice(e["mask_bbox"], 1, 4).alias("bbox"), e["score"].alias("confidence")))


def legacy_header(payload: Column, image: Column, clip: Column, *, model: str, confidence: float, iou: float, source: str) -> Column:
    """Struct of an older payload's header: image_id, source_clip_id, model, both thresholds, class_source.

    A missing or blank image id is the row's own; a missing clip is the row's, a blank one null;
    missing models, thresholds and sources take the defaults.
    """
    text = lambda name: F.trim(F.get_json_object(payload, f"$.{name}"))
    number = lambda name, other: F.coalesce(text(name).try_cast("double"), F.lit(other))
    return F.struct(
        F.coalesce(F.nullif(text("image_id"), F.lit("")), image).alias("image_id"),
        F.nullif(F.coalesce(text("source_clip_id"), clip), F.lit("")).alias("source_clip_id"),
        F.coalesce(F.nullif(text("model"), F.lit("")), F.lit(model)).alias("model"),
        number("confidence_threshold", confidence).alias("confidence_threshold"),
        number("iou_threshold", iou).alias("iou_threshold"),
        F.coalesce(F.nullif(text("class_source"), F.lit("")), F.lit(source)).alias("class_source"),
    )
