"""BPE encoding and decoding with a published byte-level vocabulary.

Merges are applied by a priority queue of (rank, position) over a doubly linked
list of symbols; a popped entry whose symbols have changed is stale and skipped.
Encoded pieces are remembered in a bounded table. Decoding concatenates the
vocabulary's byte strings.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import as_bytes, release

#: Pieces in a worker's table; when it is full, it becomes the older table and a new one begins.
MEMO = 300_000
#: Longer pieces aren't remembered.
MEMO_PIECE = 64


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class _Memo(dict):
    """Encoded pieces, as native 32-bit integers; two generations of MEMO pieces at most."""

    def __init__(self, merge) -> None:
        super().__init__()
        self.merge = merge
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece) or array("i", self.merge(piece.encode())).tobytes()
        if len(piece) <= MEMO_PIECE:
            if len(self) >= MEMO:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Tokenizer:
    """Encodes and decodes with a vocabulary file of the tokenizers library's JSON form."""

    def __init__(self, text: str) -> None:
        spec = json.loads(text)
        model, split = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"] or spec["normalizer"]:
            raise ValueError("only plain byte-level BPE files are supported")
        alphabet = byte_alphabet()
        raw = lambda token: bytes(alphabet[c] for c in token)
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ids = {raw(t): i for t, i in model["vocab"].items() if t not in added}
        pieces = {i: t for t, i in self.ids.items()} | {i: t.encode() for t, i in added.items()}
        self.pieces = [pieces.get(i, b"") for i in range(max(pieces) + 1)]
        self.names = [str(i) for i in range(len(self.pieces))]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        #: rank of a pair of ids (in one integer), and the id that each rank's merge makes
        self.merges = {self.ids[raw(a)] << 32 | self.ids[raw(b)]: rank for rank, (a, b) in enumerate(pairs)}
        self.made = [self.ids[raw(a) + raw(b)] for a, b in pairs]
        self.bytes = [self.ids[bytes([b])] for b in range(256)]
        self.added = added
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        # fixed value: the published splitting pattern of byte-level BPE
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+").findall
        self.memo = _Memo(self.merge)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece, by ascending merge rank and, at equal rank, from the left.

        A queue entry is rank << 32 | position, so entries order by rank, then position.
        """
        alphabet, rank_of, made = self.bytes, self.merges.get, self.made
        symbols = [alphabet[b] for b in piece]
        n = len(symbols)
        queue = [rank << 32 | i for i in range(n - 1) if (rank := rank_of(symbols[i] << 32 | symbols[i + 1])) is not None]
        if not queue:
            return symbols
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heapify(queue)
        while queue:
            entry = heappop(queue)
            i = entry & 0xFFFFFFFF
            whole = made[entry >> 32]
            j = right[i]
            if symbols[i] < 0 or j >= n or (rank := rank_of(symbols[i] << 32 | symbols[j])) is None or made[rank] != whole:
                continue  # stale: one of the two symbols has changed since
            symbols[i], symbols[j] = whole, -1
            right[i] = after = right[j]
            if after < n:
                left[after] = i
                if (rank := rank_of(whole << 32 | symbols[after])) is not None:
                    heappush(queue, rank << 32 | i)
            before = left[i]
            if before >= 0 and (rank := rank_of(symbols[before] << 32 | whole)) is not None:
                heappush(queue, rank << 32 | before)
        return [s for s in symbols if s >= 0]

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for part in self.cut.split(text) if self.cut else (text,):
            if part in self.added:
                out.append(self.added[part])
            elif part:
                out += memoryview(b"".join(map(self.memo.__getitem__, self.split(part)))).cast("i")
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.pieces.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _tokenizer(text: str) -> Tokenizer:
    return Tokenizer(text)


def _vocabulary(spark, path: str):
    """The file's text, read on the driver and broadcast; a vocabulary has a few MB."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, vocabulary: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ids (array<int>) of each row. Null and empty texts have no ids; repeated rows are encoded each."""
    shared = _vocabulary(docs.sparkSession, vocabulary)
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        tokenizer = _tokenizer(shared.value)
        for batch in batches:
            ids = [tokenizer.encode(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=[doc_id, "ids"])

    return docs.select(F.col(doc_id), F.col(text).cast("string")).mapInArrow(run, f"{doc_id} {kind}, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str, *, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id and text of each row of ids; a null list gives an empty text."""
    shared = _vocabulary(encoded.sparkSession, vocabulary)
    kind = encoded.schema[doc_id].dataType.simpleString()

    def run(batches):
        tokenizer = _tokenizer(shared.value)
        for batch in batches:
            texts = [tokenizer.decode(i or []) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[doc_id, "text"])

    return encoded.select(doc_id, ids).mapInArrow(run, f"{doc_id} {kind}, text string")


def round_trip(docs: DataFrame, vocabulary: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row, in one pass without a shuffle.

    ids_sha256 is the hash of the decimal ids joined by commas, decoded_sha256 that
    of the text decoded from those ids. Null counts as empty. Other columns are ignored.
    """
    shared = _vocabulary(docs.sparkSession, vocabulary)
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        tokenizer = _tokenizer(shared.value)
        names = tokenizer.names
        for batch in batches:
            counts, coded, decoded = [], [], []
            data, offsets = as_bytes(batch.column(1))
            for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                ids = tokenizer.encode(data[lo:hi].tobytes().decode("utf-8", "replace"))
                counts.append(len(ids))
                coded.append(hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(tokenizer.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())], names=[doc_id, "n_tokens", "ids_sha256", "decoded_sha256"])
        tokenizer.memo.older = {}
        release()

    return docs.select(F.col(doc_id), F.col(text).cast("string")).mapInArrow(run, f"{doc_id} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
