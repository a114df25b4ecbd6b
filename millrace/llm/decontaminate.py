"""Benchmark decontamination: which documents contain which test items.

Containment search with size-partitioned MinHash sketches. Test items are
dealt into partitions by the power of two of their shingle count. An item's
sketch is its bottom-k MinHash: the k smallest hashes of its shingle set, with
k = n - ceil(t * n) + 1, so that a document with at least the share t of the
item's shingles holds one sketch value at least. Candidate search is thereby
lossless. A partition is skipped for documents too small to reach t of its
smallest item. Each candidate is verified by counting shared shingles.

An item of fewer words than a shingle has is one shingle of its whole sequence, which
only documents of exactly these words have too: inside longer documents it isn't found.

Documents are read once. Items are hashed by executors. Where all their sets fit into
``broadcast_bytes``, which is checked, they are broadcast and no text is shuffled.
Beyond that, documents' shingles that pass a filter of bounded size are joined with
the items' shingles; candidates are the pairs that meet in a sketch value, of a
partition that the document is large enough for.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import written
from millrace.llm.text import SHINGLE, THRESHOLD_PERCENT, as_bytes, prefix_size, shingles, slices

#: Bytes of item sets, at most, that are broadcast.
BROADCAST_BYTES = 64 << 20
#: Bits of the filter of sketch and set values beyond that.
FILTER_BITS = 22


@dataclass
class Sketches:
    """All test items: their sets, and the sketch values by partition."""

    ids: list
    sets: list[np.ndarray]
    #: (fewest shingles a document needs, sorted sketch values, item of each value)
    partitions: list[tuple[int, np.ndarray, np.ndarray]]
    bitmap: np.ndarray


_BITS = 18


def build_sketches(ids: list, sets: list[np.ndarray], percent: int) -> Sketches:
    by_size: dict[int, list[int]] = {}
    for i, s in enumerate(sets):
        if len(s):
            by_size.setdefault(len(s).bit_length(), []).append(i)
    partitions, bitmap = [], np.zeros(1 << _BITS, dtype=bool)
    for size, members in sorted(by_size.items()):
        values = np.concatenate([sets[i][: prefix_size(len(sets[i]), percent)] for i in members])
        owners = np.repeat(members, [prefix_size(len(sets[i]), percent) for i in members])
        order = np.argsort(values, kind="stable")
        fewest = ((1 << (size - 1)) * percent + 99) // 100
        partitions.append((fewest, values[order], owners[order]))
        bitmap[values >> np.uint64(64 - _BITS)] = True
    return Sketches(ids, sets, partitions, bitmap)


def _candidates(sketches: Sketches, hashes: np.ndarray, rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Distinct (row, item) pairs that share a sketch value."""
    near = np.flatnonzero(sketches.bitmap[hashes >> np.uint64(64 - _BITS)])
    hashes, rows = hashes[near], rows[near]
    pairs = []
    for fewest, values, owners in sketches.partitions:
        lo, hi = np.searchsorted(values, hashes, side="left"), np.searchsorted(values, hashes, side="right")
        hit = np.flatnonzero((hi > lo) & (counts[rows] >= fewest))
        if len(hit):
            n = (hi - lo)[hit]
            shift = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            pairs.append(np.stack([np.repeat(rows[hit], n), owners[np.repeat(lo[hit], n) + shift]], axis=1))
    return np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), dtype=np.int64)


def search(sketches: Sketches, data: np.ndarray, offsets: np.ndarray, shingle: int, percent: int) -> list[tuple[int, int, int, int]]:
    """(row, item, item's shingles, shared shingles) of all contained items."""
    found = []
    for lo, hi in slices(offsets):
        hashes, at = shingles(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], shingle)
        counts = np.diff(at)
        pairs = _candidates(sketches, hashes, np.repeat(np.arange(hi - lo), counts), counts)
        last, own = -1, None
        for row, item in pairs.tolist():
            if row != last:
                last, own = row, np.unique(hashes[at[row] : at[row + 1]])
            wanted = sketches.sets[item]
            place = np.searchsorted(own, wanted)
            place[place == len(own)] = 0
            common = int((own[place] == wanted).sum())
            if 100 * common >= percent * len(wanted):
                found.append((lo + row, item, len(wanted), common))
    return found


def _item_sets(items: DataFrame, item_id: str, item_text: str, shingle: int) -> DataFrame:
    """(_name, _set) of each item with words: its sorted shingle hashes, packed."""
    kind = items.schema[item_id].dataType.simpleString()

    def run(batches):
        for batch in batches:
            data, offsets = as_bytes(batch.column(1))
            hashes, at = shingles(data, offsets, shingle)
            sets = [np.unique(hashes[a:b]).tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["_name", "_set"])

    read = items.select(F.col(item_id).alias("_name"), F.col(item_text).cast("string").alias("_text"))
    return read.mapInArrow(run, f"_name {kind}, _set binary").where(F.length("_set") > 0)


def _small_sketches(sets: DataFrame, percent: int, broadcast_bytes: int) -> Sketches | None:
    """The sketches of all items, unless they are larger than ``broadcast_bytes``."""
    size = sets.agg(F.sum(F.length("_set") + 64).alias("s")).first()["s"] or 0
    if size > broadcast_bytes:
        return None
    rows = sets.collect()
    return build_sketches([r["_name"] for r in rows], [np.frombuffer(bytes(r["_set"]), dtype=np.uint64) for r in rows], percent)


def _joined(docs: DataFrame, sets: DataFrame, text: str, shingle: int, percent: int) -> DataFrame:
    """The rows of ``docs`` without the text, with _name, n_shingles and n_common of each contained item, by joins."""
    spark = docs.sparkSession

    def entries(batches):
        for batch in batches:
            rows = [np.frombuffer(s, dtype=np.uint64) for s in batch.column(1).to_pylist()]
            n = np.array([len(r) for r in rows], dtype=np.int64)
            sketch = prefix_size(n, percent)
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            fewest = ((1 << (np.floor(np.log2(np.maximum(n, 1))).astype(np.int64))) * percent + 99) // 100
            owner = np.repeat(np.arange(len(rows)), n)
            values = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
            columns = [batch.column(0).take(pa.array(owner)), pa.array(n[owner]), pa.array(fewest[owner]), pa.array(values.view(np.int64)), pa.array(place < sketch[owner])]
            yield pa.RecordBatch.from_arrays(columns, names=["_name", "n_shingles", "_fewest", "_hash", "_sketch"])

    name = sets.schema["_name"].dataType.simpleString()
    values = written(sets.mapInArrow(entries, f"_name {name}, n_shingles long, _fewest long, _hash long, _sketch boolean"), "items")
    # at most 2 ** FILTER_BITS places reach the driver
    places = values.select(F.shiftrightunsigned("_hash", 64 - FILTER_BITS).alias("p")).distinct().toPandas()["p"].to_numpy()
    bits = np.zeros(1 << FILTER_BITS, dtype=bool)
    bits[places.astype(np.int64)] = True
    shared = spark.sparkContext.broadcast(bits)
    others = [n for n in docs.columns if n != "_text"]

    def look(batches):
        for batch in batches:
            data, offsets = as_bytes(batch.column(batch.schema.get_field_index("_text")))
            for lo, hi in slices(offsets):
                hashes, at = shingles(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], shingle)
                own = [np.unique(hashes[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                own = [o[shared.value[o >> np.uint64(64 - FILTER_BITS)]] for o in own]
                sizes = np.array([len(o) for o in own], dtype=np.int64)
                rows = pa.array(lo + np.repeat(np.arange(len(own)), sizes))
                found = np.concatenate(own) if own else np.zeros(0, np.uint64)
                counts = np.repeat(np.diff(at), sizes)
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(rows) for c in others), pa.array(counts), pa.array(found.view(np.int64))], names=[*others, "_count", "_hash"])

    kinds = ", ".join(f"{n} {docs.schema[n].dataType.simpleString()}" for n in others)
    met = docs.mapInArrow(look, f"{kinds}, _count long, _hash long").join(values, "_hash").where(F.col("_count") >= F.col("_fewest"))
    counted = met.groupBy(*others, "_name", "n_shingles").agg(F.count("*").alias("n_common"), F.max("_sketch").alias("_met"))
    return counted.where(F.col("_met") & (F.lit(100) * F.col("n_common") >= F.lit(percent) * F.col("n_shingles"))).drop("_met")


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    shingle: int = SHINGLE,
    percent: int = THRESHOLD_PERCENT,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Pairs (doc_id, item_id, n_shingles, n_common) with 100 * n_common >= percent * n_shingles.

    n_shingles is the size of the item's shingle set, n_common how many of them the
    document has. Null and empty texts and items without words are in no pair. A
    repeated document row gives a row each; item ids must not repeat with texts of
    one size. Other columns of either table are ignored. Empty tables give no rows.
    """
    spark = docs.sparkSession
    id_type = docs.schema[doc_id].dataType.simpleString()
    item_type = items.schema[item_id].dataType
    read = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text"))
    sets = _item_sets(items, item_id, item_text, shingle)
    sketches = _small_sketches(sets, percent, broadcast_bytes)
    if sketches is None:
        keyed = read.withColumn("_row", F.monotonically_increasing_id())
        found = _joined(keyed, sets, text, shingle, percent)
        return found.select(F.col("_id").alias(doc_id), F.col("_name").alias(item_id), "n_shingles", "n_common")
    shared = spark.sparkContext.broadcast(sketches)

    def scan(batches):
        for batch in batches:
            data, offsets = as_bytes(batch.column(1))
            found = search(shared.value, data, offsets, shingle, percent)
            rows = [f[0] for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array([f[k] for f in found], kind) for k, kind in ((1, pa.int32()), (2, pa.int64()), (3, pa.int64())))],
                names=["_id", "_item", "n_shingles", "n_common"],
            )

    pairs = read.mapInArrow(scan, f"_id {id_type}, _item int, n_shingles long, n_common long")
    names = spark.createDataFrame(list(enumerate(sketches.ids)), f"_item int, _name {item_type.simpleString()}")
    # one row per test item, whose sets broadcast_bytes bounds
    return pairs.join(F.broadcast(names), "_item").select(F.col("_id").alias(doc_id), F.col("_name").alias(item_id), "n_shingles", "n_common")


def decontaminated(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_text: str = "text", shingle: int = SHINGLE, percent: int = THRESHOLD_PERCENT, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Rows of ``docs``, with all their columns, that contain no test item.

    One pass without a shuffle where the items are broadcast, else an anti-join by a digest of the text.
    """
    spark = docs.sparkSession
    item = [n for n in items.columns if n != item_text]
    sets = _item_sets(items.select(F.lit(0).alias("_item"), item_text) if not item else items, item[0] if item else "_item", item_text, shingle)
    sketches = _small_sketches(sets, percent, broadcast_bytes)
    if sketches is None:
        digest = "_digest"
        while digest.lower() in {n.lower() for n in docs.columns}:
            digest = f"_{digest}"
        read = docs.select(F.col(text).cast("string").alias("_text"), F.md5(F.col(text).cast("string")).alias("_of")).withColumn("_row", F.monotonically_increasing_id())
        hit = written(_joined(read, sets, text, shingle, percent).select(F.col("_of").alias(digest)).distinct(), "contaminated")
        return docs.withColumn(digest, F.md5(F.col(text).cast("string"))).join(hit, digest, "left_anti").select(*docs.columns)
    shared = spark.sparkContext.broadcast(sketches)

    def keep(batches):
        for batch in batches:
            data, offsets = as_bytes(batch.column(batch.schema.get_field_index(text)))
            mask = np.ones(batch.num_rows, dtype=bool)
            mask[[f[0] for f in search(shared.value, data, offsets, shingle, percent)]] = False
            yield batch.filter(pa.array(mask))

    return docs.mapInArrow(keep, docs.schema)
