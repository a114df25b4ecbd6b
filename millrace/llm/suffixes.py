"""Repeated passages: bytes of every string of 50 bytes that an earlier document has.

The index is a logarithmic family of suffix arrays (suffixes count up to 50 bytes).
Documents come in batches in order of id. A new batch gets its own suffix array, the
places of its suffixes in order; it is merge-scanned against the arrays of all levels
for suffixes that agree in 50 bytes; its new suffixes become the lowest level, and
levels of equal size are merged, so that each suffix takes part in a logarithmic
number of merges.

To spread this over tasks, suffixes are dealt by content. Among the 16-byte grams of
a 50-byte string, the one with the smallest hash (the leftmost of equals) is its
anchor; equal strings have equal anchors, at the same place. A run of consecutive
strings with one anchor is a *stretch*: anchor, bytes and position of the anchor in
them. All stretches with one anchor hash meet in one bucket.

1. Each chunk of documents sends its distinct stretches as pairs of hashes. A
   bucket learns which stretches an earlier chunk has too - all their strings are
   repeats - and which are first but share their anchor with different stretches.
   Equality here is that of 88 or more bits of two hashes, not of bytes.
2. Chunks send the bytes of the latter only, at their first document. Each bucket
   runs the index of suffix arrays over them. An anchor of more than HOT different
   stretches is no place to meet: chunks send its strings one by one, each to one of
   several places by its own hash, and of equal ones (told by that hash) those of the
   first document only, so that no task holds what surrounds a common passage.
3. Chunks gather the repeated strings and remove what they cover.

The three steps read the same exchange of documents. A very common passage is one
stretch in each chunk, never a row for each document.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.chunks import bucket_of, chunked, in_order, rank_of, runs, unpack
from millrace.llm.text import _BASE, BLOCK, _power_tables, as_bytes, mix

SPAN = 50
GRAM = 16
#: Suffixes in a batch of the index, at least.
BATCH = 1 << 16
#: The index has so many times the buckets of the first step, as it holds bytes instead of hashes.
FINER = 4
#: Suffixes of which an index in memory is made at once, about.
SHARE = 400_000
#: Different stretches from which on an anchor's strings are dealt by their own hashes.
HOT = 2048
_U = np.uint64
_LOW = _U((1 << 24) - 1)
#: Codes for hashing exact bytes; those of ``text`` fold case.
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


class SuffixLevels:
    """Suffix arrays over one text, of distinct suffixes of ``span`` bytes, each with its first document."""

    def __init__(self, data: np.ndarray, span: int = SPAN) -> None:
        self.kind = f"S{span}"
        self.views = sliding_window_view(data, span)
        #: (places of suffixes in order of their bytes, first document of each), largest level first
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def bytes_at(self, places: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(self.views[places]).view(self.kind).ravel()

    def add(self, places: np.ndarray, documents: np.ndarray) -> np.ndarray:
        """Whether the suffix at each place occurs in an earlier document; documents must not precede those of earlier calls."""
        suffixes = self.bytes_at(places)
        order = np.argsort(suffixes, kind="stable")
        array = suffixes[order]
        start, end = runs(array)
        owners = documents[order]
        first = np.minimum.reduceat(owners, start) if len(start) else owners
        array, heads = array[start], places[order][start]
        earliest = first.copy()
        for known, owner in self.levels:
            keys = self.bytes_at(known)
            place = np.searchsorted(keys, array)
            place[place == len(keys)] = 0
            same = keys[place] == array
            earliest[same] = np.minimum(earliest[same], owner[place[same]])
        seen = np.empty(len(places), dtype=bool)
        seen[order] = owners > np.repeat(earliest, end - start)
        fresh = earliest == first
        self._push(heads[fresh], first[fresh])
        return seen

    def _push(self, places: np.ndarray, documents: np.ndarray) -> None:
        while self.levels and len(self.levels[-1][0]) < 2 * len(places):
            other, known = self.levels.pop()
            places, documents = np.concatenate((other, places)), np.concatenate((known, documents))
            keys = self.bytes_at(places)
            order = np.argsort(keys, kind="stable")  # merges the two sorted runs
            keys, places, documents = keys[order], places[order], documents[order]
            start, _ = runs(keys)
            if len(start) < len(keys):
                places, documents = places[start], np.minimum.reduceat(documents, start)
        if len(places):
            self.levels.append((places, documents))


def _grams(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position on (GRAM is a power of two)."""
    found, size = _BYTE[data], 1
    while size < GRAM:
        found = found[:-size] * _U(pow(int(_BASE), size, 1 << 64)) + found[size:]
        size *= 2
    return mix(found)


def _stretches_of(data: np.ndarray, offsets: np.ndarray, span: int) -> list[np.ndarray]:
    """Rows, starts, lengths, anchor hashes and stretch hashes in texts of BLOCK bytes or less together."""
    n = len(data)
    grams = _grams(data)
    width = span - GRAM + 1
    least = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
    size = 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    count = n - span + 1
    least = np.minimum(least[:count], least[width - size : width - size + count])
    inside = np.zeros(count + 1, dtype=np.int32)
    ends = offsets[1:-1]
    np.add.at(inside, np.minimum(np.maximum(ends - span + 1, 0), count), 1)
    np.add.at(inside, np.minimum(ends, count), -1)
    at = np.flatnonzero(np.cumsum(inside[:-1]) == 0)
    if not len(at):
        return [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)] * 2
    anchor = (least[at] & _LOW).astype(np.int64)
    first, last = runs(anchor)
    start, length, anchor = at[first], last - first, anchor[first]
    power, inverse = _power_tables(n)
    sums = np.empty(n + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[data] * power[:n], out=sums[1:])
    content = (sums[start + length + span - 1] - sums[start]) * inverse[start]
    content = mix(content + ((anchor - start) * 64 + length).astype(np.uint64))
    row = np.searchsorted(offsets, start, side="right") - 1
    # anchors are minima, so their hashes are mixed anew to fill all buckets
    return [row, start - offsets[row], length, mix(grams[anchor]), content]


def stretches(data: np.ndarray, offsets: np.ndarray, span: int = SPAN) -> list[np.ndarray]:
    """Row, start, number of strings, anchor hash and stretch hash of all stretches, in order."""
    parts = []
    step = BLOCK - span
    lo, rows = 0, len(offsets) - 1
    while lo < rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + BLOCK, side="right")) - 1)
        size = int(offsets[hi] - offsets[lo])
        if size <= BLOCK:
            if size >= span:
                part = _stretches_of(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], span)
                part[0] = part[0] + lo
                parts.append(part)
        else:
            # a long text in blocks that overlap, so that each string is in one of them
            for a in range(0, size - span + 1, step):
                block = data[offsets[lo] + a : offsets[lo] + min(size, a + step + span - 1)]
                part = _stretches_of(block, np.array([0, len(block)]), span)
                part[0], part[1] = part[0] + lo, part[1] + a
                parts.append(part)
        lo = hi
    if not parts:
        return [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)] * 2
    return [np.concatenate(c) for c in zip(*parts, strict=True)]


def _distinct(anchors: np.ndarray, contents: np.ndarray):
    """Order of stretches by (anchor, content), and the starts of equal ones in it."""
    order = np.lexsort((contents, anchors))
    a, c = anchors[order], contents[order]
    start = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (c[1:] != c[:-1])))) if len(a) else np.zeros(0, np.int64)
    return order, start


def _share_of(data: np.ndarray, span: int, shares: int) -> np.ndarray:
    """A share for each position, by the eight bytes from there on."""
    n = len(data) - span + 1
    hashed = np.zeros(n, dtype=np.uint32)
    for j in range(8):
        hashed *= np.uint32(0x9E3779B1)
        hashed += data[j : j + n]
    hashed ^= hashed >> np.uint32(15)
    return hashed % np.uint32(shares)


#: From SCATTERED on, the code less CONTESTED is the logarithm of an anchor's number of places.
REPEATED, CONTESTED, SCATTERED = 1, 2, 3


def _judge(chunk: np.ndarray, anchors: np.ndarray, contents: np.ndarray) -> np.ndarray:
    """What each of a bucket's stretches is: repeated from an earlier chunk, or first but contested, by so many that it's scattered."""
    order = np.lexsort((chunk, contents, anchors))
    a, c, k = anchors[order], contents[order], chunk[order]
    new_anchor = np.concatenate(([True], a[1:] != a[:-1]))
    new_class = new_anchor | np.concatenate(([True], c[1:] != c[:-1]))
    of_class = np.cumsum(new_class) - 1
    of_anchor = np.cumsum(new_anchor) - 1
    repeated = k != k[new_class][of_class]
    classes = np.bincount(of_anchor[new_class])[of_anchor]
    codes = np.empty(len(order), dtype=np.uint8)
    places = np.ceil(np.log2(np.maximum(classes / HOT, 1))).astype(np.int64)
    codes[order] = np.where(repeated, REPEATED, np.where(classes > 1, CONTESTED + places, 0))
    return codes


def _string_hashes(data: np.ndarray, begin: np.ndarray, span: int) -> np.ndarray:
    """Hash of the ``span`` bytes from each place on."""
    out = np.zeros(len(begin), dtype=np.uint64)
    for j in range(span):
        out = out * _BASE + _BYTE[data[begin + j]]
    return mix(out)


def _later_rows(hashes: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Whether an earlier row than its own has an entry's hash."""
    order = np.lexsort((ranks, hashes))
    first, last = runs(hashes[order])
    out = np.empty(len(hashes), dtype=bool)
    out[order] = ranks[order] > np.repeat(ranks[order][first], last - first)
    return out


def _covered(offsets: np.ndarray, runs_: np.ndarray, span: int) -> np.ndarray:
    """Mask of the bytes that repeated strings cover; runs_ has rows (row, start, number)."""
    edge = np.zeros(int(offsets[-1]) + 1, dtype=np.int32)
    first = offsets[runs_[:, 0]] + runs_[:, 1]
    np.add.at(edge, first, 1)
    np.add.at(edge, first + runs_[:, 2] + span - 1, -1)
    return np.cumsum(edge, out=edge)[:-1] > 0


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", span: int = SPAN, with_text: bool = True) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with ``with_text`` kept (binary) and spans.

    A byte is removed when a string of ``span`` bytes covers it that also starts in a
    document with a smaller id, judged on the input. spans lists the maximal removed
    runs as (start, end). Ids must be integers; a null id counts as larger than all
    others. Rows with equal ids, or without one, don't remove each other. Null and
    empty texts, and texts shorter than ``span``, lose nothing. Other columns are ignored.
    """
    corpus = chunked(docs, doc_id, text, 0.8)
    buckets = corpus.buckets
    rows = corpus.rows

    def send(table: pa.Table) -> pa.Table:
        data, offsets = as_bytes(table.column("text"))
        _, _, _, anchors, contents = stretches(data, offsets, span)
        order, start = _distinct(anchors, contents)
        anchors, contents = anchors[order][start], contents[order][start]
        bucket = bucket_of(anchors, buckets)
        first, last = runs(bucket)
        chunk = table.column("chunk")[0].as_py()
        return pa.table(
            {
                "bucket": pa.array(bucket[first], pa.int32()),
                "chunk": pa.array(np.full(len(first), chunk), pa.int32()),
                "anchors": pa.array([anchors[a:b].astype(np.uint32).tobytes() for a, b in zip(first, last, strict=True)], pa.binary()),
                "contents": pa.array([contents[a:b].tobytes() for a, b in zip(first, last, strict=True)], pa.binary()),
            }
        )

    sent = rows.groupBy("chunk").applyInArrow(send, "bucket int, chunk int, anchors binary, contents binary")

    def judge(table: pa.Table) -> pa.Table:
        anchors, counts = unpack(table.column("anchors"), np.uint32)
        contents, _ = unpack(table.column("contents"), np.uint64)
        chunk = table.column("chunk").to_numpy()
        codes = _judge(np.repeat(chunk, counts), anchors, contents)
        ends = np.cumsum(counts)
        parts = [codes[e - n : e] for e, n in zip(ends, counts, strict=True)]
        said = [i for i, p in enumerate(parts) if p.any()]
        return pa.table({"chunk": pa.array(chunk[said], pa.int32()), "bucket": table.column("bucket").take(pa.array(said, pa.int64())).cast(pa.int32()), "codes": pa.array([parts[i].tobytes() for i in said], pa.binary())})

    verdicts = sent.groupBy("bucket").applyInArrow(judge, "chunk int, bucket int, codes binary")

    contested_schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("places", pa.binary()), ("lengths", pa.binary()), ("bytes", pa.binary()), ("repeats", pa.binary())])

    def contest(table: pa.Table, said: pa.Table) -> pa.Table:
        if not table.num_rows:
            return contested_schema.empty_table()
        table = in_order(table)
        chunk = table.column("chunk")[0].as_py()
        rank = rank_of(table)
        data, offsets = as_bytes(table.column("text"))
        row, start, length, anchors, contents = stretches(data, offsets, span)
        order, first = _distinct(anchors, contents)
        bucket = bucket_of(anchors[order][first], buckets)
        codes = np.zeros(len(first), dtype=np.uint8)
        for b, c in zip(said.column("bucket").to_pylist(), said.column("codes").to_pylist(), strict=True):
            at = np.searchsorted(bucket, b)
            codes[at : at + len(c)] = np.frombuffer(c, dtype=np.uint8)
        size = np.diff(np.append(first, len(order)))
        code = np.empty(len(order), dtype=np.uint8)
        code[order] = np.repeat(codes, size)
        earliest = np.empty(len(order), dtype=np.int64)
        earliest[order] = np.repeat(np.minimum.reduceat(rank[row[order]], first), size) if len(first) else 0
        repeated = (code == REPEATED) | (rank[row] > earliest)
        repeats = np.column_stack([row, start, length])[repeated].astype(np.int64)
        first_here = order[~repeated[order]]
        whole = first_here[code[first_here] == CONTESTED]
        loose = first_here[code[first_here] >= SCATTERED]
        # (row, start, number of strings) of what is sent; strings of a hot anchor one by one
        inner = np.arange(length[loose].sum()) - np.repeat(np.cumsum(length[loose]) - length[loose], length[loose])
        loose = np.repeat(loose, length[loose])
        hashes = _string_hashes(data, offsets[row[loose]] + start[loose] + inner, span)
        later = _later_rows(hashes, rank[row[loose]])
        repeats = np.concatenate((repeats, np.column_stack([row[loose], start[loose] + inner, np.ones(len(loose), dtype=np.int64)])[later]))
        loose, inner, hashes = loose[~later], inner[~later], hashes[~later]
        sent_row, sent_start = np.concatenate((row[whole], row[loose])), np.concatenate((start[whole], start[loose] + inner))
        sent_length = np.concatenate((length[whole], np.ones(len(loose), dtype=np.int64)))
        place = hashes & ((_U(1) << (code[loose] - CONTESTED).astype(np.uint64)) - _U(1))
        meets = np.concatenate((anchors[whole], mix(anchors[loose] + (place + _U(1)) * _BASE)))
        target = bucket_of(meets, FINER * buckets)
        by_bucket = np.argsort(target, kind="stable")
        target, sent_row, sent_start, sent_length = target[by_bucket], sent_row[by_bucket], sent_start[by_bucket], sent_length[by_bucket]
        lo, hi = runs(target)
        sizes = sent_length + span - 1
        begin = offsets[sent_row] + sent_start
        ends = np.cumsum(sizes)
        picked = data[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begin - (ends - sizes), sizes)]
        bounds = np.concatenate(([0], ends))
        places = np.column_stack([rank[sent_row], sent_row, sent_start]).astype(np.int32)
        spans = list(zip(lo.tolist(), hi.tolist(), strict=True))
        out = {
            "bucket": [*target[lo].tolist(), chunk % (FINER * buckets)],
            "chunk": [chunk] * (len(spans) + 1),
            "places": [*(places[a:b].tobytes() for a, b in spans), b""],
            "lengths": [*(sent_length[a:b].astype(np.int16).tobytes() for a, b in spans), b""],
            "bytes": [*(picked[bounds[a] : bounds[b]].tobytes() for a, b in spans), b""],
            "repeats": [*(b"" for _ in spans), repeats.tobytes()],
        }
        return pa.table(out, schema=contested_schema)

    contested = rows.groupBy("chunk").cogroup(verdicts.groupBy("chunk")).applyInArrow(contest, "bucket int, chunk int, places binary, lengths binary, bytes binary, repeats binary")

    def index(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        chunks = table.column("chunk").to_numpy()
        places, counts = unpack(table.column("places"), np.int32)
        places = places.reshape(-1, 3).astype(np.int64)
        length, _ = unpack(table.column("lengths"), np.int16)
        data, _ = unpack(table.column("bytes"), np.uint8)
        chunk = np.repeat(chunks, counts // 3).astype(np.int64)
        document = (chunk << 32) + places[:, 0]
        length = length.astype(np.int64)
        begin = np.cumsum(length + span - 1) - (length + span - 1)
        order = np.argsort(document, kind="stable")
        found = [(int(k), r) for k, r in zip(chunks, table.column("repeats").to_pylist(), strict=True) if r]
        if not len(order):
            return pa.table({"chunk": pa.array([f[0] for f in found], pa.int32()), "repeats": pa.array([f[1] for f in found], pa.binary())})
        total = np.cumsum(length[order])
        # a large bucket is gone through several times, each with an index of one part of the suffixes
        shares = 1 + int(total[-1]) // SHARE
        share = _share_of(data, span, shares)
        for k in range(shares):
            levels, at = SuffixLevels(data, span), 0
            while at < len(order):
                to = int(np.searchsorted(total, (total[at - 1] if at else 0) + min(shares, 8) * BATCH, side="left")) + 1
                batch = order[at:to]
                n = length[batch]
                inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                owner = np.repeat(np.arange(len(batch)), n)
                mine = np.flatnonzero(share[begin[batch][owner] + inner] == k) if shares > 1 else slice(None)
                inner, owner = inner[mine], owner[mine]
                seen = levels.add(begin[batch][owner] + inner, document[batch][owner])
                owner, inner = owner[seen], inner[seen]
                if len(owner):
                    new = np.concatenate(([True], (owner[1:] != owner[:-1]) | (inner[1:] != inner[:-1] + 1)))
                    head = np.flatnonzero(new)
                    amount = np.diff(np.append(head, len(owner)))
                    source = batch[owner[head]]
                    triples = np.column_stack([places[source, 1], places[source, 2] + inner[head], amount])
                    for a, b in zip(*runs(chunk[source]), strict=True):
                        found.append((int(chunk[source[a]]), triples[a:b].astype(np.int64).tobytes()))
                at = to
        return pa.table({"chunk": pa.array([f[0] for f in found], pa.int32()), "repeats": pa.array([f[1] for f in found], pa.binary())})

    repeats = contested.groupBy("bucket").applyInArrow(index, "chunk int, repeats binary")

    schema = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])
    ddl = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if with_text:
        schema = schema.append(pa.field("kept", pa.binary())).append(pa.field("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))))
        ddl += ", kept binary, spans array<struct<start:long,end:long>>"

    def remove(table: pa.Table, said: pa.Table) -> pa.Table:
        if not table.num_rows:
            return schema.empty_table()
        table = in_order(table)
        data, offsets = as_bytes(table.column("text"))
        found, _ = unpack(said.column("repeats"), np.int64)
        covered = _covered(offsets, found.reshape(-1, 3), span)
        out: dict[str, list] = {name: [] for name in schema.names}
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            mask = covered[a:b]
            flips = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0)) if mask.any() else ()
            kept = data[a:b][~mask].tobytes() if len(flips) else data[a:b].tobytes()
            values = [table.column("id")[i].as_py(), b - a, b - a - len(kept), len(flips) // 2, hashlib.sha256(kept).hexdigest()]
            if with_text:
                values += [kept, [{"start": int(x), "end": int(y)} for x, y in zip(flips[::2], flips[1::2], strict=True)]]
            for name, value in zip(schema.names, values, strict=True):
                out[name].append(value)
        return pa.table(out, schema=schema)

    kept = rows.groupBy("chunk").cogroup(repeats.groupBy("chunk")).applyInArrow(remove, ddl)
    kind = docs.schema[doc_id].dataType
    return kept.select(F.col("id").cast(kind).alias(doc_id), *(c for c in schema.names if c != "id"))
