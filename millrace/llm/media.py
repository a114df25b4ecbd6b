"""Media columns: byte payloads as AVI motion-JPEG, and shots of the decoded frames.

A payload becomes grey frames of 24 x 24 8-bit samples. Each frame is a lossless
JPEG (process 14, SOF3, predictor 1, every frame coded by itself), and a document's
frames are one AVI file with an index. Reading walks the RIFF chunks, takes the
frames from the index and decodes them. Entropy coding works on many frames at
once: bits are packed and looked up with NumPy, a lane for each frame.

Shots: frames are compared by their histograms. A cut is a difference above the
mean plus a multiple of the deviation of the differences just before it.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import as_bytes, slices

SIDE = 24
FRAME = SIDE * SIDE
FILL = 255
FPS = 25
#: Frames that are coded or decoded at once.
LANES = 8192
BINS, WINDOW, DEVIATIONS, MIN_DIFFERENCE = 16, 8, 3.0, FRAME // 8

# fixed values: code lengths of the JPEG standard's typical luminance DC table, categories 0 to 11
_CODE_COUNTS = bytes([0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0])
_CATEGORIES = bytes(range(12))


def _codes(counts: bytes, values: bytes) -> dict[int, tuple[int, int]]:
    """Canonical Huffman codes: category -> (code, length)."""
    out, code, at = {}, 0, 0
    for length, n in enumerate(counts, 1):
        for v in values[at : at + n]:
            out[v] = (code, length)
            code += 1
        at += n
        code <<= 1
    return out


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


HEADER = (
    b"\xff\xd8"
    + _segment(0xC3, struct.pack(">BHHB", 8, SIDE, SIDE, 1) + bytes([1, 0x11, 0]))
    + _segment(0xC4, b"\0" + _CODE_COUNTS + _CATEGORIES)
    + _segment(0xDA, bytes([1, 1, 0, 1, 0, 0]))
)
_EOI = b"\xff\xd9"


@lru_cache(maxsize=16)
def _decoder(header: bytes) -> tuple[np.ndarray, int, int]:
    """For a frame's header up to its scan: table from 16 bits to difference << 8 | bits used, height and width."""
    at, height, width, table = 2, 0, 0, None
    while at < len(header):
        _, marker, size = struct.unpack_from(">BBH", header, at)
        body = header[at + 4 : at + 2 + size]
        if marker == 0xC3:
            precision, height, width, parts = struct.unpack_from(">BHHB", body)
            if precision != 8 or parts != 1:
                raise ValueError("only frames of one 8-bit component are supported")
        elif marker == 0xC4:
            table = _codes(body[1:17], body[17:])
        elif marker == 0xDA and body[3] != 1:
            raise ValueError("only predictor 1 is supported")
        at += 2 + size
    if not height or table is None:
        raise ValueError("not a lossless JPEG frame")
    lookup = np.zeros(1 << 16, dtype=np.int32)
    for category, (code, length) in table.items():
        used = length + category
        if used > 16:
            continue  # no difference of 8-bit samples has so many bits
        extra = np.arange(1 << category)
        value = np.where(extra >> max(category - 1, 0) == 0, extra - (1 << category) + 1, extra) if category else extra
        first = ((code << category) + extra) << (16 - used)
        span = np.arange(1 << (16 - used))
        lookup[(first[:, None] + span).ravel()] = np.repeat(value * 256 + used, len(span))
    return lookup, height, width


def encode_frames(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entropy-coded bytes of frames (rows of 576 samples), one after another, and their offsets."""
    n = len(samples)
    s = samples.reshape(n, SIDE, SIDE).astype(np.int32)
    d = s.copy()
    d[:, :, 1:] -= s[:, :, :-1]
    d[:, 1:, 0] -= s[:, :-1, 0]
    d[:, 0, 0] -= 128
    d = d.reshape(n, FRAME)
    size = np.abs(d)
    category = np.zeros_like(d)
    for k in range(8):
        category += size >> k > 0
    codes = _codes(_CODE_COUNTS, _CATEGORIES)
    code, length = (np.array([codes[c][i] for c in range(9)], dtype=np.int32)[category] for i in (0, 1))
    bits = length + category
    value = (code << category) | np.where(d < 0, d + (1 << category) - 1, d)
    ends = np.cumsum(bits, axis=1)
    total = (ends[:, -1] + 7) >> 3
    base = np.concatenate(([0], np.cumsum(total)))
    at = (ends - bits + (base[:-1] * 8)[:, None]).ravel()
    value = (value << (24 - (at & 7).reshape(n, FRAME) - bits)).ravel()
    out = np.zeros(int(base[-1]) + 2, dtype=np.float64)
    for k, shift in enumerate((16, 8, 0)):
        out += np.bincount((at >> 3) + k, weights=(value >> shift) & 255, minlength=len(out))[: len(out)]
    packed = out[:-2].astype(np.uint8)
    packed[base[1:] - 1] |= ((1 << (total * 8 - ends[:, -1])) - 1).astype(np.uint8)
    full = packed == 0xFF
    before = np.concatenate(([0], np.cumsum(full)))
    stuffed = np.zeros(len(packed) + int(before[-1]), dtype=np.uint8)
    stuffed[np.arange(len(packed)) + before[:-1]] = packed
    return stuffed, base + before[base]


def decode_frames(header: bytes, coded: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Samples of frames, one row each, from their entropy-coded bytes."""
    lookup, height, width = _decoder(header)
    n = len(offsets) - 1
    if not n:
        return np.zeros((0, height * width), dtype=np.uint8)
    filler = np.zeros(len(coded), dtype=bool)
    filler[1:] = (coded[1:] == 0) & (coded[:-1] == 0xFF)
    removed = np.concatenate(([0], np.cumsum(filler)))
    data = np.concatenate((coded[~filler], np.full(4, 0xFF, np.uint8))).astype(np.uint32)
    words = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
    at = ((offsets[:-1] - removed[offsets[:-1]]) * 8).astype(np.int64)
    last = (offsets[1:] - removed[offsets[1:]]) * 8
    differences = np.empty((height * width, n), dtype=np.int32)
    for i in range(height * width):
        found = lookup[(words[np.minimum(at >> 3, len(words) - 1)] << (at & 7).astype(np.uint32)) >> np.uint32(16)]
        differences[i] = found >> 8
        at += found & 255
    if (at > last).any() or (last - at > 7).any():
        raise ValueError("damaged frame")
    grid = differences.reshape(height, width, n)
    grid[0, 0] += 128
    grid[:, 0] = np.cumsum(grid[:, 0], axis=0)
    return (np.cumsum(grid, axis=1).reshape(height * width, n).T & 255).astype(np.uint8)


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) & 1)


def avi(frames: list[bytes]) -> bytes:
    """An AVI file of JPEG frames with an index. A RIFF size has 32 bits, so files end at 4 GB."""
    n, largest = len(frames), max(map(len, frames))
    main = struct.pack("<14I", 1_000_000 // FPS, largest * FPS, 0, 0x10, n, 0, 1, largest, SIDE, SIDE, 0, 0, 0, 0)
    stream = b"vidsMJPG" + struct.pack("<10I4H", 0, 0, 0, 1, FPS, 0, n, largest, 0xFFFFFFFF, 0, 0, 0, SIDE, SIDE)
    picture = struct.pack("<IiiHH4sIiiII", 40, SIDE, SIDE, 1, 8, b"MJPG", FRAME, 0, 0, 0, 0)
    head = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", main) + _chunk(b"LIST", b"strl" + _chunk(b"strh", stream) + _chunk(b"strf", picture)))
    chunks = [_chunk(b"00dc", f) for f in frames]
    sizes = np.array([len(f) for f in frames], dtype=np.int64)
    places = 4 + np.concatenate(([0], np.cumsum(sizes + (sizes & 1) + 8)[:-1]))
    index = np.empty((n, 4), dtype="<u4")
    index[:, 0], index[:, 1], index[:, 2], index[:, 3] = int.from_bytes(b"00dc", "little"), 0x10, places, sizes
    body = b"AVI " + head + _chunk(b"LIST", b"movi" + b"".join(chunks)) + _chunk(b"idx1", index.tobytes())
    return b"RIFF" + struct.pack("<I", len(body)) + body


def frame_places(file: bytes) -> np.ndarray:
    """Start and size of each frame of an AVI file, by its index."""
    if len(file) < 12 or file[:4] != b"RIFF" or file[8:12] != b"AVI ":
        raise ValueError("not an AVI file")
    at, movi, index = 12, None, None
    while at + 8 <= len(file):
        name, size = file[at : at + 4], int.from_bytes(file[at + 4 : at + 8], "little")
        if name == b"LIST" and file[at + 8 : at + 12] == b"movi":
            movi = at + 8
        elif name == b"idx1":
            index = np.frombuffer(file[at + 8 : at + 8 + size // 16 * 16], dtype="<u4")
            index = index[: len(index) // 4 * 4].reshape(-1, 4).astype(np.int64)
        at += 8 + size + (size & 1)
    if movi is None or index is None:
        raise ValueError("an AVI file without frames or index")
    rows = index[index[:, 0] == int.from_bytes(b"00dc", "little")]
    return np.column_stack([movi + rows[:, 2] + 8, rows[:, 3]])


def frame_scans(file: bytes | None) -> list[tuple[bytes, bytes]]:
    """Header and entropy-coded bytes of each frame of a file; ValueError names what is wrong with it."""
    if file is None:
        raise ValueError("no file")
    out = []
    for start, size in frame_places(file).tolist():
        frame = file[start : start + size]
        scan = frame.find(b"\xff\xda")
        if len(frame) != size or not frame.startswith(b"\xff\xd8") or frame[-2:] != _EOI or scan < 0:
            raise ValueError("a damaged frame")
        at = scan + 2 + int.from_bytes(frame[scan + 2 : scan + 4], "big")
        out.append((frame[:at], frame[at:-2]))
        if frame[:at] != HEADER:
            raise ValueError("a frame of another form than the writer's")
    if not out:
        raise ValueError("no frames")
    return out


def _decode_scans(scans: list[bytes]) -> np.ndarray:
    groups = [np.zeros((0, FRAME), dtype=np.uint8)]
    for lo in range(0, len(scans), LANES):
        part = scans[lo : lo + LANES]
        offsets = np.concatenate(([0], np.cumsum([len(s) for s in part])))
        groups.append(decode_frames(HEADER, np.frombuffer(b"".join(part), dtype=np.uint8), offsets))
    return groups[1] if len(groups) == 2 else np.concatenate(groups)


def read_frames(files: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, list[str | None]]:
    """Decoded frames of several files, the files' frame offsets, and what is wrong with each file, if anything.

    A file with an error has no frames.
    """
    scans, errors = [], []
    for file in files:
        try:
            scans.append([s for _, s in frame_scans(file)])
            errors.append(None)
        except (ValueError, IndexError, struct.error) as e:
            scans.append([])
            errors.append(str(e))
    try:
        samples = _decode_scans([s for one in scans for s in one])
    except (ValueError, IndexError):
        # some file's bits are damaged: each by itself
        groups = []
        for i, one in enumerate(scans):
            try:
                groups.append(_decode_scans(one))
            except (ValueError, IndexError) as e:
                groups.append(np.zeros((0, FRAME), dtype=np.uint8))
                scans[i], errors[i] = [], str(e)
        samples = np.concatenate(groups)
    return samples, np.concatenate(([0], np.cumsum([len(one) for one in scans]))).astype(np.int64), errors


def histograms(frames: np.ndarray) -> np.ndarray:
    key = (np.arange(len(frames))[:, None] * BINS + (frames >> 4)).ravel()
    return np.bincount(key, minlength=len(frames) * BINS).reshape(-1, BINS)


def cuts(histogram: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each frame begins a shot; frames of file i are offsets[i] to offsets[i + 1].

    Whole numbers are summed, so a file's shots don't depend on its neighbours.
    """
    n = len(histogram)
    first = np.zeros(n, dtype=bool)
    first[offsets[:-1][np.diff(offsets) > 0]] = True
    change = np.zeros(n, dtype=np.int64)
    change[1:] = np.abs(np.diff(histogram, axis=0)).sum(axis=1)
    change[first] = 0
    start = np.repeat(offsets[:-1], np.diff(offsets))
    at = np.arange(n)
    low = np.maximum(at - WINDOW, start + 1)
    number = np.maximum(at - low, 0)
    sums, squares = (np.concatenate(([0], np.cumsum(x))) for x in (change, change * change))
    low = np.minimum(low, at)
    total, square = sums[at] - sums[low], squares[at] - squares[low]
    mean = total / np.maximum(number, 1)
    deviation = np.sqrt(np.maximum(square / np.maximum(number, 1) - mean * mean, 0))
    return first | ((number >= 2) & (change > np.maximum(mean + DEVIATIONS * deviation, MIN_DIFFERENCE)))


def store(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes (of the text in UTF-8) and media (the AVI file) of each row. No shuffle.

    The payload is the text, null as empty, filled with bytes 255 to a positive
    multiple of 576. Repeated rows are stored each; other columns are ignored.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        for batch in batches:
            data, offsets = as_bytes(batch.column(1))
            for lo, hi in slices(offsets):
                lengths = np.diff(offsets[lo : hi + 1])
                counts = np.maximum((lengths + FRAME - 1) // FRAME, 1)
                starts = np.concatenate(([0], np.cumsum(counts)))
                samples = np.full(int(starts[-1]) * FRAME, FILL, dtype=np.uint8)
                source = data[offsets[lo] : offsets[hi]]
                samples[np.arange(len(source)) + np.repeat(starts[:-1] * FRAME - (offsets[lo:hi] - offsets[lo]), lengths)] = source
                samples = samples.reshape(-1, FRAME)
                frames: list[bytes] = []
                for a in range(0, len(samples), LANES):
                    coded, places = encode_frames(samples[a : a + LANES])
                    raw, places = coded.tobytes(), places.tolist()
                    frames += [HEADER + raw[x:y] + _EOI for x, y in zip(places[:-1], places[1:], strict=True)]
                starts = starts.tolist()
                files = [avi(frames[x:y]) for x, y in zip(starts[:-1], starts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], pa.array(lengths, pa.int64()), pa.array(files, pa.binary())], names=[doc_id, "n_bytes", "media"])

    return docs.select(F.col(doc_id), F.col(text).cast("string")).mapInArrow(run, f"{doc_id} {kind}, n_bytes long, media binary")


def _decoded(column: pa.Array):
    """(row range, files, decoded samples, shot starts, frame offsets, errors) of a media column, some MB at a time."""
    _, offsets = as_bytes(column)
    for lo, hi in slices(offsets):
        files = column[lo:hi].to_pylist()
        samples, places, errors = read_frames(files)
        yield lo, hi, files, samples, cuts(histograms(samples), places), places, errors


def _clips(shots: np.ndarray) -> list[dict]:
    """The clips between the shot starts of one file's frames."""
    starts = np.flatnonzero(shots).tolist()
    ends = [*starts[1:], len(shots)]
    return [{"clip": i, "first_frame": a, "last_frame": b - 1, "start_ms": a * 1000 // FPS, "end_ms": b * 1000 // FPS} for i, (a, b) in enumerate(zip(starts, ends, strict=True))]


_CLIP = "struct<clip:long,first_frame:long,last_frame:long,start_ms:long,end_ms:long>"
_CLIP_TYPE = pa.struct([(name, pa.int64()) for name in ("clip", "first_frame", "last_frame", "start_ms", "end_ms")])


def describe(stored: DataFrame, *, doc_id: str = "doc_id") -> DataFrame:
    """Digests, shots and clips of each stored row, all from the media bytes as read back.

    payload_* are of the decoded samples with the filling, media_* of the file. feature
    is the number of frames and the first frame of each shot, as ``frames/0,a,b``, and
    clips are the shots with their times. A null, damaged or foreign file has null
    payload_*, tail_crc32, feature and clips, and error says why; else error is null.
    """
    kind = stored.schema[doc_id].dataType.simpleString()
    names = [doc_id, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "clips", "error"]
    kinds = [None, None, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(_CLIP_TYPE), pa.string()]

    def run(batches):
        for batch in batches:
            for lo, hi, files, samples, shots, places, errors in _decoded(batch.column(2)):
                rows = []
                for file, a, b, error in zip(files, places[:-1].tolist(), places[1:].tolist(), errors, strict=True):
                    stored_as = (None, None) if file is None else (len(file), hashlib.sha256(file).hexdigest())
                    if error:
                        rows.append((None, None, None, *stored_as, None, None, error))
                        continue
                    payload = samples[a:b].tobytes()
                    found = _clips(shots[a:b])
                    first = ",".join(str(c["first_frame"]) for c in found)
                    rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), *stored_as, f"{b - a}/{first}", found, None))
                made = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds[2:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], batch.column(1)[lo:hi], *made], names=names)

    read = stored.select(doc_id, "n_bytes", "media")
    return read.mapInArrow(run, f"{doc_id} {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, clips array<{_CLIP}>, error string")


def clips(stored: DataFrame, *, doc_id: str = "doc_id") -> DataFrame:
    """One row per shot: doc_id, clip (from 0), first_frame, last_frame, start_ms, end_ms; files with an error have none."""
    shots = describe(stored, doc_id=doc_id).select(doc_id, F.explode("clips").alias("_clip"))
    return shots.select(doc_id, "_clip.*")
