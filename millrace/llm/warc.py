"""WARC archives of web pages: writing with payload deduplication, and verified reading.

Archives are written and read by Spark's own text source, with record boundaries
as line separators, so any store that Spark reaches will do. A reader's tasks cut
files at the magic ``WARC/1.0``, which may also occur inside payloads. Each piece
that parses as a record header is a candidate and emits the offset at which its
successor must begin. Per file, pointer jumping over these links from offset 0
keeps the reachable candidates only; everything else is payload.
"""

from __future__ import annotations

import base64
import hashlib
from urllib.parse import unquote_plus

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAGIC = "WARC/1.0\r\n"
_END = "\r\n\r\n"
#: Records of one file at most; with usual pages, a file then has up to some hundred MB.
RECORDS_PER_FILE = 50_000
_URN = "<urn:millrace:page:"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: each 5 hexadecimal digits become 4 base32 digits."""
    digits = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digits, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", _BASE32)


def records(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """One column ``record`` with the text of each page's record, without its final CRLF CRLF.

    Of pages with equal payloads of at least ``min_bytes`` bytes, the one with the
    smallest id becomes a response, all others revisits that refer to it. Smaller
    payloads and a page that repeats the smallest id are responses. A null payload
    counts as empty; a page without id has a response record without one.
    """
    read = pages.select(
        F.col(page_id).alias("_id"),
        F.regexp_replace(F.col(url).cast("string"), r"[\x00-\x20\x7F]", "").alias("_url"),
        F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("_body"),
    )
    body = read.withColumn("_digest", sha1_base32(F.col("_body"))).withColumn("_bytes", F.octet_length("_body"))
    groups = body.where(F.col("_bytes") >= min_bytes).groupBy("_digest").agg(F.min("_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    joined = body.join(groups, "_digest", "left")
    again = (F.col("_bytes") >= min_bytes) & (F.col("_id") != F.col("_first"))
    name = lambda c: F.concat(F.lit(_URN), F.url_encode(F.coalesce(c.cast("string"), F.lit(""))), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("_bytes"), F.lit(_END))
    revisit = F.coalesce(again, F.lit(False))
    block = F.when(revisit, http).otherwise(F.concat(http, "_body"))
    head = F.concat(
        F.lit(MAGIC + "WARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "),
        name(F.col("_id")),
        F.lit(f"\r\nWARC-Date: {date}"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), "_url"), F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"),
        F.col("_digest"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest\r\nWARC-Refers-To: "), name(F.col("_first")))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length("_block"),
        F.lit(_END),
        F.col("_block"),
    )
    return joined.withColumn("_block", block).select(head.alias("record"))


def write_archives(pages: DataFrame, path: str, *, compression: str = "gzip", records_per_file: int = RECORDS_PER_FILE, **columns) -> None:
    """Write the pages' records as WARC files under ``path`` (see ``records``)."""
    out = records(pages, **columns).write.option("lineSep", _END).option("maxRecordsPerFile", records_per_file)
    out.option("compression", compression).text(path)


def reachable(offsets: np.ndarray, successors: np.ndarray, end: int) -> np.ndarray:
    """Which of the candidates, in order of offset, a chain from offset 0 passes; the file ends at ``end``.

    The last link must end at another reached candidate or at the file's end; a
    record whose successor is neither is cut off or damaged, and isn't kept.
    """
    n = len(offsets)
    if not n or offsets[0] != 0:
        return np.zeros(n, dtype=bool)
    place = np.searchsorted(offsets, successors)
    hit = (place < n) & (offsets[np.minimum(place, n - 1)] == successors)
    # nodes n and n + 1: the file's end, and nowhere
    jump = np.concatenate((np.where(hit, place, np.where(successors == end, n, n + 1)), [n, n + 1]))
    sound = jump[:n] != n + 1
    seen = np.zeros(n + 2, dtype=bool)
    seen[0] = True
    for _ in range(max(1, n.bit_length())):
        seen[jump[seen]] = True
        jump = jump[jump]
    return seen[:n] & sound


def _fields(head: bytes) -> dict[bytes, bytes]:
    pairs = (line.partition(b":") for line in head.split(b"\r\n"))
    return {k.strip().lower(): v.strip() for k, _, v in pairs if v}


def _name(urn: bytes | None) -> str | None:
    text = (urn or b"").decode("utf-8", "replace")
    return unquote_plus(text[len(_URN) : -1]) or None if text.startswith(_URN) else None


def parse(head: bytes, block: bytes) -> tuple[str | None, str | None, str | None, int, str]:
    """Record id, type, id referred to, payload bytes and payload digest of one record."""
    fields = _fields(head)
    kind = fields.get(b"warc-type", b"").decode("utf-8", "replace")
    http, _, body = block.partition(_END.encode())
    if kind == "revisit":
        size = _fields(http).get(b"content-length", b"0")
        digest = fields.get(b"warc-payload-digest", b"").removeprefix(b"sha1:").decode("utf-8", "replace")
        return _name(fields.get(b"warc-record-id")), kind, _name(fields.get(b"warc-refers-to")), int(size), digest
    return _name(fields.get(b"warc-record-id")), kind, None, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode()


_PIECES = pa.schema([("file", pa.string()), ("start", pa.int64()), ("seq", pa.int64()), ("size", pa.int64()), ("span", pa.int64()), ("id", pa.string()), ("kind", pa.string()), ("refers", pa.string()), ("bytes", pa.int64()), ("digest", pa.string()), ("value", pa.binary())])
_FOUND = pa.schema([_PIECES.field(k) for k in ("id", "kind", "refers", "bytes", "digest")])
_DDL = {"string": "string", "int64": "long", "binary": "binary"}


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_DDL[str(f.type)]}" for f in schema)


def _declared(value: bytes) -> tuple[int, int] | None:
    """Header bytes (with the blank line) and block bytes of a piece that may be a record."""
    at = value.find(_END.encode())
    if at < 0:
        return None
    length = _fields(value[:at]).get(b"content-length")
    return (at + 4, int(length)) if length and length.isdigit() and len(length) < 16 else None


def _scan(batches):
    """Pieces between magics. A piece's bytes are kept unless it is a whole record that no earlier one of its file can contain."""
    file, start, seq, at, covered = None, -1, 0, 0, 0
    for batch in batches:
        out: dict[str, list] = {name: [] for name in _PIECES.names}
        for value, path, block in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if (path, block) != (file, start):
                # what precedes a later split of a file is unknown here, so its pieces are all kept
                file, start, seq, at, covered = path, block, 0, 0, (0 if block == 0 else 1 << 62)
            declared = _declared(value) if seq or block else None
            span, parsed, keep = -1, (None, None, None, None, None), value
            if declared:
                head, length = declared
                span = head + length + 4
                if at >= covered and span == len(value):
                    parsed, keep = parse(value[: head - 4], value[head : head + length]), None
                covered = max(covered, at + span)
            elif not seq and not block and not value:
                keep = None
            for name, item in zip(_PIECES.names, (path, block, seq, len(value), span, *parsed, keep), strict=True):
                out[name].append(item)
            at += len(value) + (len(MAGIC) if seq or block else 0)
            seq += 1
        yield pa.RecordBatch.from_pydict(out, schema=_PIECES)


def _chain(pieces: pa.Table) -> pa.Table:
    """The records of one file, from its pieces."""
    pieces = pieces.sort_by([("start", "ascending"), ("seq", "ascending")])
    size, span = (pieces.column(c).to_numpy() for c in ("size", "span"))
    # the first piece precedes the first magic
    ends = np.cumsum(size + len(MAGIC)) - len(MAGIC)
    offsets = np.concatenate(([0], ends[:-1]))
    candidates = np.flatnonzero(span >= 0)
    candidates = candidates[candidates > 0]
    kept = candidates[reachable(offsets[candidates], offsets[candidates] + len(MAGIC) + span[candidates], int(ends[-1]))]
    nexts = np.append(kept[1:], len(size)) if len(kept) else kept
    rows = pieces.select(_FOUND.names).take(pa.array(kept)).to_pylist()
    values = pieces.column("value")
    for i, (a, b) in enumerate(zip(kept.tolist(), nexts.tolist(), strict=True)):
        if values[a].is_valid:
            whole = MAGIC.encode().join(values[k].as_py() for k in range(a, b))
            head = _declared(whole)[0]
            rows[i] = dict(zip(_FOUND.names, parse(whole[: head - 4], whole[head : int(span[a]) - 4]), strict=True))
    return pa.Table.from_pylist(rows, schema=_FOUND)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per verified record: id, kind, refers (strings), bytes and digest of the full payload.

    Empty folders of archives give no rows. Files are split where the store and the
    compression allow it; each file's table of offsets is chained in one task.
    """
    pieces = spark.read.option("lineSep", MAGIC).text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    found = pieces.mapInArrow(_scan, _ddl(_PIECES))
    return found.groupBy("file").applyInArrow(_chain, _ddl(_FOUND))
