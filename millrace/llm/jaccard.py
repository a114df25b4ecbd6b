"""Similarity join of documents by the Jaccard index of their word shingles.

Multiple-global-order filtering: in any order of all shingles, the first
n - ceil(t * n) + 1 shingles of two linked sets have one in common. Candidates must
have that under several orders, each by another hash of the shingle. Filters, each of
which loses no link:

1. Equal sets are one class; the class is a node, of which one row stands for all.
2. By the first order, a longer prefix: with k more shingles, linked sets have at
   least k in common in it. A set stays when so many of its prefix are in prefixes
   of other sets too.
3. By all shingles: at least the share t of a set must be in other remaining sets.
4. Quick links: under each of several orders, sets with the same first shingle are
   compared with the smallest id among them. Verified links make components.
5. Stars: of the sets that share a prefix shingle, each meets one drawn by a hash, if that
   is in another component; a set's few nearest by their bitmaps are verified. Twice.
6. Prefix entries under three orders, each of which has rare shingles first and those
   of one rarity by another hash. A shingle whose sets are all in one component needs no
   more work, and a set without others under some order neither. Sets of different
   components that share a prefix shingle of the first order, and whose sizes and parity
   bitmaps allow a link, are a pair; a shingle of many sets is dealt in blocks. Pairs that
   also share prefix shingles under the other orders are verified by their exact index.

No step makes the pairs of a group of copies: copies are one class, and near copies
are one component after steps 4 and 5, in which a set has a bounded number of links. Sets are 64-bit shingle hashes throughout.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.chunks import BUCKET_BYTES, CHUNK_BYTES, chunked, counts_of, in_order, key_counts
from millrace.llm.components import components
from millrace.llm.shared import result, written
from millrace.llm.text import SHINGLE, THRESHOLD_PERCENT, as_bytes, mix, prefix_size, release, shingles

QUICK_ORDERS = 6
PREFIX_ORDERS = 3
STAR_ROUNDS, STARS, NEAREST = 2, 64, 4
BITMAP_BITS = 2048
#: Sets in one block of a shingle that many sets share, about.
BLOCK_SETS = 4096
#: Entries, of about 300 bytes, in a group of small shingles; pairs that meet in one several times are one row.
GROUP_ENTRIES = 100_000
#: Pairs whose bitmaps are compared at once.
_PAIRS = 1 << 16
_U = np.uint64


def under_order(tokens: np.ndarray, order: int) -> np.ndarray:
    """Place values of shingles in a global order; order 0 is that of the hashes themselves."""
    return tokens if order == 0 else mix(tokens ^ mix(np.array([order], dtype=np.uint64) * _U(0xA24BAED4963EE407)))


def _sets(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of all rows, one row after another, and their offsets."""
    hashes, at = shingles(data, offsets, shingle)
    parts = [np.unique(hashes[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    return (np.concatenate(parts) if parts else hashes), np.concatenate(([0], np.cumsum(sizes)))


def _extra(n: np.ndarray) -> np.ndarray:
    """The k of filter 2 for a set of n."""
    return 1 + n // 8


def _signature(tokens: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each row's set."""
    out = []
    for order in (101, 102):
        sums = np.concatenate(([_U(0)], np.cumsum(under_order(tokens, order))))
        out.append(mix(sums[at[1:]] - sums[at[:-1]]).view(np.int64))
    return out[0], out[1]


def _first_of_class(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    order = np.lexsort((np.arange(len(h1)), h2, h1))
    first = np.zeros(len(h1), dtype=bool)
    if len(order):
        a, b = h1[order], h2[order]
        first[order[np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))]] = True
    return first


def _text_sets(rows: DataFrame, buckets: int, shingle: int, percent: int) -> DataFrame:
    """(row, id, digest, n, h1, h2, tokens) of each document; tokens are null beyond filter 2 and for repeats in a chunk.

    row is a number of its own for each row, and digest the MD5 of the text.
    """

    def parse(table: pa.Table):
        table = in_order(table)
        data, offsets = as_bytes(table.column("text"))
        tokens, at = _sets(data, offsets, shingle)
        h1, h2 = _signature(tokens, at)
        return table, tokens, at, h1, h2, _first_of_class(h1, h2)

    def keys_of(table: pa.Table, parsed=None):
        _, tokens, at, _, _, first = parsed or parse(table)
        n = np.diff(at)
        size = np.where(first, np.minimum(n, prefix_size(n, percent) - 1 + _extra(n)), 0)
        row = np.repeat(np.arange(len(n)), size)
        return row, tokens[at[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)]

    counts = key_counts(rows, keys_of, buckets)
    schema = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("digest", pa.binary()), ("n", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("tokens", pa.binary())])

    def keep(table: pa.Table, said: pa.Table) -> pa.Table:
        release()
        if not table.num_rows:
            return schema.empty_table()
        parsed = parse(table)
        table, tokens, at, h1, h2, first = parsed
        n = np.diff(at)
        needed = _extra((n * percent + 99) // 100)
        row, keys = keys_of(table, parsed)
        others = np.bincount(row, weights=counts_of(keys, said, buckets) > 1, minlength=len(n))
        stays = first & (n > 0) & (others >= needed)
        bounds = at.tolist()
        packed = [tokens[bounds[i] : bounds[i + 1]].tobytes() if s else None for i, s in enumerate(stays.tolist())]
        number = (table.column("chunk")[0].as_py() << 32) + np.arange(table.num_rows)
        digest = pa.array([hashlib.md5((t or "").encode()).digest() for t in table.column("text").to_pylist()], pa.binary())
        return pa.table({"row": number, "id": table.column("id"), "digest": digest, "n": n, "h1": h1, "h2": h2, "tokens": pa.array(packed, pa.binary())}, schema=schema)

    return rows.groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInArrow(keep, "row long, id long, digest binary, n long, h1 long, h2 long, tokens binary")


def _unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = as_bytes(table.column("tokens"))
    return np.frombuffer(data.tobytes(), dtype=np.uint64), offsets // 8


def _mostly_shared(sets: DataFrame, chunks: int, buckets: int, percent: int) -> DataFrame:
    """Filter 3: sets of which the share ``percent`` at least is in other sets, with each shingle's rarity.

    rarity is the number of sets with the shingle, the first part of the orders of step 5.
    """
    rows = sets.withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int"))

    def keys_of(table: pa.Table):
        tokens, at = _unpacked(table)
        return np.repeat(np.arange(table.num_rows), np.diff(at)), tokens

    counts = key_counts(rows, keys_of, buckets)

    def keep(table: pa.Table, said: pa.Table) -> pa.Table:
        release()
        row, keys = keys_of(table)
        rarity = counts_of(keys, said, buckets)
        n = table.column("n").to_numpy()
        stays = 100 * np.bincount(row, weights=rarity > 1, minlength=len(n)) >= percent * n
        ends = np.cumsum(n)
        packed = [rarity[e - k : e].tobytes() for e, k in zip(ends.tolist(), n.tolist(), strict=True)]
        return table.select(["id", "n", "tokens"]).append_column("rarity", pa.array(packed, pa.binary())).filter(pa.array(stays))

    return rows.groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInArrow(keep, "id long, n long, tokens binary, rarity binary")


def parity(tokens: np.ndarray) -> bytes:
    """A bitmap with the parity of the number of shingles that fall on each bit.

    Two bitmaps differ in at most as many bits as their sets differ in shingles.
    """
    bits = np.bincount((tokens >> _U(20)).astype(np.int64) % BITMAP_BITS, minlength=BITMAP_BITS) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def _common(x: np.ndarray, y: np.ndarray) -> int:
    if len(x) > len(y):
        x, y = y, x
    place = np.searchsorted(y, x)
    place[place == len(y)] = 0
    return int((y[place] == x).sum()) if len(x) else 0


def _prefix(tokens: np.ndarray, rarity: np.ndarray, order: int, percent: int) -> np.ndarray:
    """The first shingles of a set in one of the orders that have rare ones first."""
    return tokens[np.lexsort((under_order(tokens, order), rarity))[: int(prefix_size(len(tokens), percent))]]


def verified(pairs: DataFrame, sets: DataFrame, percent: int, orders: range = range(0)) -> DataFrame:
    """The pairs (a, b) whose sets have 100 * intersection >= percent * union.

    The index of those without a common prefix shingle in one of ``orders`` isn't computed.
    """

    @F.pandas_udf("long")
    def common(a: pd.Series, left: pd.Series, left_rarity: pd.Series, b: pd.Series, right: pd.Series, right_rarity: pd.Series) -> pd.Series:
        out = np.zeros(len(left), dtype=np.int64)
        known: dict[tuple[int, int], np.ndarray] = {}

        def prefix(i: int, tokens: np.ndarray, rarity: bytes, order: int) -> np.ndarray:
            if (i, order) not in known:
                known[i, order] = np.sort(_prefix(tokens, np.frombuffer(rarity, dtype=np.uint16), order, percent))
            return known[i, order]

        for row, (i, x, p, j, y, q) in enumerate(zip(a, left, left_rarity, b, right, right_rarity, strict=True)):
            x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
            if all(_common(prefix(i, x, p, k), prefix(j, y, q, k)) for k in orders):
                out[row] = _common(x, y)
        return pd.Series(out)

    left = sets.select(F.col("id").alias("a"), F.col("n").alias("_na"), F.col("tokens").alias("_ta"), F.col("rarity").alias("_ra"))
    right = sets.select(F.col("id").alias("b"), F.col("n").alias("_nb"), F.col("tokens").alias("_tb"), F.col("rarity").alias("_rb"))
    counted = pairs.join(left, "a").join(right, "b").select("a", "b", (F.col("_na") + F.col("_nb")).alias("_sum"), common("a", "_ta", "_ra", "b", "_tb", "_rb").alias("_c"))
    return counted.where(F.lit(100) * F.col("_c") >= F.lit(percent) * (F.col("_sum") - F.col("_c"))).select("a", "b")


def _entries(sets: DataFrame, pick, extra: tuple[str, ...] = ()) -> DataFrame:
    """(kind, token, id, ...) rows; pick(tokens and rarities of a set) gives the kinds and the tokens."""

    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            tokens, at = _unpacked(table)
            rarity = np.frombuffer(as_bytes(table.column("rarity"))[0].tobytes(), dtype=np.uint16)
            picked = [pick(tokens[a:b], rarity[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            rows = pa.array(np.repeat(np.arange(len(picked)), [len(k) for k, _ in picked]))
            kinds = np.concatenate([k for k, _ in picked]) if picked else np.zeros(0)
            found = np.concatenate([t for _, t in picked]) if picked else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(found.view(np.int64)), *(batch.column(c).take(rows) for c in ("id", *extra))], names=["kind", "token", "id", *extra])

    return sets.select("id", "tokens", "rarity", *extra).mapInArrow(run, ", ".join(["kind int, token long, id long", *(f"{c} long" for c in extra)]))


def _quick_pairs(sets: DataFrame) -> DataFrame:
    """Each set with the smallest id that has the same first shingle, under several orders."""

    def pick(tokens: np.ndarray, _):
        return np.arange(QUICK_ORDERS), np.array([tokens[under_order(tokens, 11 + k).argmin()] for k in range(QUICK_ORDERS)], dtype=np.uint64)

    rows = _entries(sets, pick)
    least = rows.groupBy("kind", "token").agg(F.min("id").alias("a"), F.count("*").alias("c")).where("c > 1").drop("c")
    return rows.join(least, ["kind", "token"]).where("id <> a").select("a", F.col("id").alias("b")).distinct()


def _open_entries(sets: DataFrame, percent: int) -> DataFrame:
    """(kind, token, id) of the prefix shingles that several components share, under each order."""

    def pick(tokens: np.ndarray, rarity: np.ndarray):
        size = int(prefix_size(len(tokens), percent))
        parts = [_prefix(tokens, rarity, k, percent) for k in range(PREFIX_ORDERS)]
        return np.repeat(np.arange(PREFIX_ORDERS), size), np.concatenate(parts)

    rows = _entries(sets, pick, ("component",))
    mixed = rows.groupBy("kind", "token").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("kind", "token")
    return rows.join(mixed, ["kind", "token"]).select("kind", "token", "id")


def _bitmaps(sets: DataFrame) -> DataFrame:
    """(id, n, bitmap) of each set."""

    def mapped(batches):
        for batch in batches:
            tokens, at = _unpacked(pa.Table.from_batches([batch.select(["tokens"])]))
            maps = [parity(tokens[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n"), pa.array(maps, pa.binary())], names=["id", "n", "bitmap"])

    return sets.select("id", "n", "tokens").mapInArrow(mapped, "id long, n long, bitmap binary")


def _may_link(n: np.ndarray, m: np.ndarray, one: np.ndarray, other: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of n and m shingles with these parity bitmaps can have the index ``percent``."""
    apart = np.maximum(np.bitwise_count(one ^ other).sum(axis=1, dtype=np.int64), np.abs(n - m))
    # intersection <= (n + m - apart) / 2 and union >= (n + m + apart) / 2
    return 100 * (n + m - apart) >= percent * (n + m + apart)


def _as_maps(column) -> np.ndarray:
    return np.frombuffer(as_bytes(column)[0].tobytes(), dtype=np.uint64).reshape(-1, BITMAP_BITS // 64)


def _stars(entries: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of each set with one of another component for some of its shingles; ``entries`` has component."""
    drawn = entries.groupBy("kind", "token").agg(F.min_by(F.struct("id", "component"), F.xxhash64("id", "token")).alias("r")).select("kind", "token", F.col("r.id").alias("a"), F.col("r.component").alias("other"))
    # a set has no more shingles here than its prefixes
    few = entries.join(drawn, ["kind", "token"]).where("component <> other").groupBy("id").agg(F.slice(F.collect_set("a"), 1, STARS).alias("few"))
    pairs = few.select(F.explode("few").alias("a"), F.col("id").alias("b"))
    left = bits.select(F.col("id").alias("a"), F.col("n").alias("n1"), F.col("bitmap").alias("m1"))
    right = bits.select(F.col("id").alias("b"), F.col("n").alias("n2"), F.col("bitmap").alias("m2"))

    def near(batches):
        for batch in batches:
            n, m, one, other = batch.column("n1").to_numpy(), batch.column("n2").to_numpy(), _as_maps(batch.column("m1")), _as_maps(batch.column("m2"))
            apart = np.bitwise_count(one ^ other).sum(axis=1, dtype=np.int64) / (n + m)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(apart)], names=["a", "b", "apart"]).filter(pa.array(_may_link(n, m, one, other, percent)))

    met = pairs.join(left, "a").join(right, "b").select("a", "b", "n1", "n2", "m1", "m2").mapInArrow(near, "a long, b long, apart double")
    nearest = met.groupBy("b").agg(F.slice(F.sort_array(F.collect_list(F.struct("apart", "a"))), 1, NEAREST).alias("k"))
    return nearest.select(F.explode("k.a").alias("a"), "b")


def close_pairs(group: np.ndarray, part: np.ndarray, mixed: np.ndarray, ids: np.ndarray, n: np.ndarray, component: np.ndarray, maps: np.ndarray, percent: int) -> np.ndarray:
    """Pairs (i, j) of rows of one group, of different components, that sizes and parity bitmaps don't rule out.

    ``group`` is sorted. Where ``mixed``, only pairs of different parts are looked at.
    """
    found = [np.zeros((2, 0), dtype=np.int64)]
    for d in range(1, len(group)):
        left = np.flatnonzero(group[d:] == group[:-d])
        if not len(left):
            break
        left = left[(component[left] != component[left + d]) & ~(mixed[left] & (part[left] == part[left + d]))]
        for at in range(0, len(left), _PAIRS):
            x = left[at : at + _PAIRS]
            y = x + d
            may = _may_link(n[x], n[y], maps[x], maps[y], percent)
            x, y = x[may], y[may]
            found.append(np.where(ids[x] < ids[y], np.stack([x, y]), np.stack([y, x])))
    return np.concatenate(found, axis=1)


def _candidates(entries: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that share a prefix shingle of the first order.

    ``entries`` has component; sets that share none under some order are left out. Sets of a shingle are dealt into blocks of about BLOCK_SETS,
    and each pair of blocks is one group with its bitmaps, so that pairs which fail are
    never rows. Shingles of one block share groups.
    """
    token = entries.groupBy("kind", "token").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("m"))
    mixed = token.where("x < y").select("kind", "token", F.ceil(F.col("m") / BLOCK_SETS).alias("blocks"))
    open_rows = written(entries.join(mixed, ["kind", "token"]).select("kind", "token", "id", "component", "blocks"), "open")
    # one bit for each order
    every = (1 << PREFIX_ORDERS) - 1
    met = open_rows.groupBy("id").agg(F.bit_or(F.expr("shiftleft(1, kind)")).alias("orders")).where(F.col("orders") == every).select("id")
    groups = 8 + open_rows.where("kind = 0").count() // GROUP_ENTRIES
    own = F.pmod(F.xxhash64("id"), F.col("blocks"))
    dealt = open_rows.where("kind = 0").join(bits.join(met, "id", "left_semi"), "id").withColumn("own", own).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    single = F.col("blocks") == 1
    spread = F.when(single, F.pmod(F.xxhash64("token"), F.lit(groups))).otherwise(F.xxhash64("token"))
    dealt = dealt.select("token", "id", "n", "component", "own", "bitmap", single.alias("single"), spread.alias("grp"), F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))

    def compare(table: pa.Table) -> pa.Table:
        token, own, ids, n, component = (table.column(c).to_numpy() for c in ("token", "own", "id", "n", "component"))
        maps = _as_maps(table.column("bitmap"))
        order = np.lexsort((own, token))
        token, own, ids, n, component, maps = (c[order] for c in (token, own, ids, n, component, maps))
        group = np.cumsum(np.concatenate(([False], token[1:] != token[:-1])))
        across = np.full(len(ids), table.column("lo")[0].as_py() != table.column("hi")[0].as_py())
        i, j = close_pairs(group, own, across, ids, n, component, maps, percent)
        pairs = np.unique(np.stack([ids[i], ids[j]]), axis=1)
        return pa.table({"a": pa.array(pairs[0], pa.int64()), "b": pa.array(pairs[1], pa.int64())})

    return dealt.groupBy("single", "grp", "lo", "hi").applyInArrow(compare, "a long, b long").distinct()


def _rows(docs: DataFrame, doc_id: str, text: str, shingle: int, percent: int) -> DataFrame:
    """(id, digest, n, component, least) of each row; component is a number of the component, least its smallest id."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    corpus = chunked(docs, doc_id, text, 0.3, ordered=False)
    sets = written(_text_sets(corpus.rows, corpus.buckets, shingle, percent), "sets")
    # the least row of a class is the first in its chunk, so that it has the tokens
    classes = written(sets.where("n > 0").groupBy("h1", "h2", "n").agg(F.min("row").alias("node"), F.min("id").alias("least")), "classes")
    first = written(sets.where("tokens is not null").select(F.col("row").alias("id"), "n", "tokens").join(classes.select(F.col("node").alias("id")), "id", "left_semi"), "representatives")
    size = 8 * (first.agg(F.sum("n").alias("s")).first()["s"] or 0)
    near = written(_mostly_shared(first, max(partitions, -(-size // CHUNK_BYTES)), max(2 * partitions, size // BUCKET_BYTES), percent), "near")
    found = components(verified(_quick_pairs(near), near, percent))
    # components are stars already, so that their rows stand for the links they came from
    known = lambda: found.select(F.col("component").alias("a"), F.col("node").alias("b"))
    labelled = lambda rows: rows.join(found.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    entries = written(_open_entries(labelled(near), percent), "entries")
    bits = written(_bitmaps(near.join(entries.select("id").distinct(), "id", "left_semi")), "bitmaps")
    for _ in range(STAR_ROUNDS):
        found = components(known().unionAll(verified(_stars(labelled(entries), bits, percent), near, percent)))
    candidates = written(_candidates(labelled(entries), bits, percent), "pairs")
    final = components(known().unionAll(verified(candidates, near, percent, range(1, PREFIX_ORDERS))))
    of_class = classes.join(final, "node", "left").select("h1", "h2", F.col("n").alias("m"), F.coalesce("component", "node").alias("component"), "least")
    smallest = of_class.groupBy("component").agg(F.min("least").alias("least"))
    of_class = of_class.drop("least").join(smallest, "component")
    full = sets.where("n > 0").select("id", "digest", "n", "h1", "h2")
    joined = full.join(of_class, (full["h1"] == of_class["h1"]) & (full["h2"] == of_class["h2"]) & (full["n"] == of_class["m"])).select("id", "digest", "n", "component", "least")
    return joined.unionAll(sets.where("n = 0").select("id", "digest", "n", F.lit(None).cast("long").alias("component"), F.col("id").alias("least")))


def similarity_components(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Two rows link when 100 * |intersection| >= percent * |union| of their shingle sets;
    component_id is the smallest id that links reach. Null and empty texts and texts
    without words have no shingles and are alone. Ids must be integers; a repeated id is
    a row each, with its own text's component. A row without id is linked like others;
    component_id is null only where no row of a component has an id. Other columns are ignored.
    """
    kind = docs.schema[doc_id].dataType

    def make() -> DataFrame:
        rows = _rows(docs, doc_id, text, shingle, percent)
        return rows.select(F.col("id").cast(kind).alias(doc_id), F.col("n").alias("n_shingles"), F.col("least").cast(kind).alias("component_id"))

    return result(docs.sparkSession, "components", make)


def one_of_each(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """One row, with all its columns, of each component: that of the smallest id, null ids last, then by a digest of the text.

    Rows that repeat id and text count as copies, of which one stays. Texts without words all stay.
    """
    spark = docs.sparkSession
    names = docs.columns
    id_, digest, place = (_unused(names, n) for n in ("id", "digest", "place"))

    def make() -> DataFrame:
        rows = _rows(docs, doc_id, text, shingle, percent).where("n > 0")
        return rows.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "digest")).alias("k")).select(F.col("k.id").alias(id_), F.col("k.digest").alias(digest))

    kept = result(spark, "kept", make)
    body = F.col(text).cast("string")
    worded = F.coalesce(body.rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    keyed = docs.where(worded).withColumns({id_: F.col(doc_id).cast("long"), digest: F.unhex(F.md5(body))})
    left, right = keyed.alias("l"), kept.alias("r")
    same = F.col(f"l.{id_}").eqNullSafe(F.col(f"r.{id_}")) & (F.col(f"l.{digest}") == F.col(f"r.{digest}"))
    held = left.join(right, same, "left_semi")
    one = Window.partitionBy(id_, digest).orderBy(F.xxhash64(*names))
    return docs.where(~worded).unionAll(held.withColumn(place, F.row_number().over(one)).where(F.col(place) == 1).select(*names))


def _unused(names: list[str], name: str) -> str:
    taken = {n.lower() for n in names}
    name = f"_{name}"
    while name in taken:
        name = f"_{name}"
    return name
