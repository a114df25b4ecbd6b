"""Toxicity by compression distance, with two zstandard dictionaries.

One dictionary is trained on ordinary text, the other on toxic text: the parts of
words that toxic training documents hold more often, counted by occurrences, than
ordinary ones can by chance. A text is cut into windows at white space; each window
is compressed with the ordinary dictionary and with the ordinary followed by the
toxic one, and the gain is the difference of the two lengths. The gains of a text's
windows (largest two, sums beyond thresholds, number of windows) go into a logistic
calibration, fitted on the training rows and weighted to the share of either label.

The sample to fit on is bounded by ``train_rows`` documents of each label, which are
read whole. The calibration sees gains of texts that the dictionaries behind them
weren't made of: the sample is cut into folds, and each fold's gains come from the
dictionaries of the other folds. Scoring reads every window of every text.

Dictionaries trained on whole windows of toxic documents don't tell the labels apart
here (README): most of a toxic document is ordinary, and so is what the trainer keeps.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import as_bytes, release

TRAIN_ROWS = 1500
CALIBRATION_FOLDS = 3
WINDOW = 64
LEVEL = 3
ORDINARY_SIZE, TOXIC_SIZE = 16 << 10, 4 << 10
GRAMS = (5, 6, 7)
#: A byte n-gram counts as toxic from this z score of its occurrences in a document on.
MIN_Z = 6.0
FOLDS, HELD_OUT = 5, 0
_GAINS = (1.0, 2.0, 3.0)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def held_out(doc_id: Column) -> Column:
    """Whether labels of this row may not be learnt from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def windows(text: bytes, size: int = WINDOW) -> list[bytes]:
    """The whole text in pieces of at most ``size`` bytes, cut after a space where there is one."""
    out, at, n = [], 0, len(text)
    while at < n:
        to = at + size
        if to < n:
            gap = text.rfind(b" ", at + 1, to)
            to = gap + 1 if gap > at else to
        out.append(text[at:to])
        at = to
    return out


def _grams(text: bytes, n: int) -> np.ndarray:
    """The n-grams of a text, each in one integer; white space counts as a space, one leads."""
    data = np.frombuffer(b" " + text, dtype=np.uint8)
    data = np.where(_SPACE[data], 32, data).astype(np.uint64)
    out = np.zeros(max(0, len(data) - n + 1), dtype=np.uint64)
    for j in range(n):
        out |= data[j : j + len(out)] << np.uint64(8 * j)
    return out


def _moments(texts: list[bytes], n: int, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and sum of squares, over the texts, of the occurrences of each of the sorted ``grams``."""
    total, squares = np.zeros(len(grams)), np.zeros(len(grams))
    for text in texts:
        found, count = np.unique(_grams(text, n), return_counts=True)
        place = np.searchsorted(grams, found)
        place[place == len(grams)] = 0
        hit = grams[place] == found
        total[place[hit]] += count[hit]
        squares[place[hit]] += count[hit].astype(float) ** 2
    return total, squares


def toxic_grams(toxic: list[bytes], ordinary: list[bytes], n: int) -> np.ndarray:
    """n-grams inside words (or from the space before one) that toxic documents repeat beyond chance."""
    found = [np.unique(_grams(t, n)) for t in toxic]
    grams = np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)
    for j in range(1, n):
        grams = grams[((grams >> np.uint64(8 * j)) & np.uint64(255)) != 32]
    if not len(grams) or not ordinary:
        return grams[:0]
    a, a_squares = _moments(toxic, n, grams)
    b, b_squares = _moments(ordinary, n, grams)
    rows = len(toxic) + len(ordinary)
    mean = (a + b) / rows
    variance = np.maximum((a_squares + b_squares) / rows - mean**2, 1e-9)
    z = (a / len(toxic) - b / len(ordinary)) / np.sqrt(variance * (1 / len(toxic) + 1 / len(ordinary)))
    return grams[z >= MIN_Z]


def toxic_segments(toxic: list[bytes], grams: dict[int, np.ndarray]) -> list[bytes]:
    """The stretches of toxic documents that toxic n-grams cover."""
    out = []
    for text in toxic:
        body = b" " + text
        edge = np.zeros(len(body) + 1, dtype=np.int64)
        for n, wanted in grams.items():
            at = np.flatnonzero(np.isin(_grams(text, n), wanted))
            np.add.at(edge, at, 1)
            np.add.at(edge, at + n, -1)
        covered = np.cumsum(edge)[:-1] > 0
        flips = np.flatnonzero(np.diff(np.concatenate(([0], covered.astype(np.int8), [0]))))
        out += [body[x:y] for x, y in zip(flips[::2].tolist(), flips[1::2].tolist(), strict=True)]
    return out


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary's bytes; with too few samples to train on, the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _complete(dictionary: bytes, ranked: list[bytes], size: int) -> bytes:
    """The dictionary with the frequent samples that training left out; the most frequent stand last, where offsets are short."""
    missing: list[bytes] = []
    room = size - len(dictionary)
    for sample in ranked:
        if len(sample) <= room and sample not in dictionary:
            missing.append(sample)
            room -= len(sample)
    return dictionary + b"".join(reversed(missing))


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    weights: np.ndarray
    level: int = LEVEL
    window: int = WINDOW

    def compressors(self):
        raw = [zstandard.ZstdCompressionDict(d or b"\0" * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT) for d in (self.ordinary, self.ordinary + self.toxic)]
        return [zstandard.ZstdCompressor(level=self.level, dict_data=d).compress for d in raw]

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(features @ self.weights[1:] + self.weights[0], -30, 30)))


def features(text: bytes, plain, both, window: int = WINDOW) -> list[float]:
    gains = [len(plain(w)) - len(both(w)) for w in windows(text, window)]
    if not gains:
        return [0.0] * (5 + len(_GAINS))
    top = sorted(gains, reverse=True)[:2] + [0]
    n = len(gains)
    beyond = [sum(g - t for g in gains if g > t) for t in _GAINS]
    return [float(top[0]), float(top[1]), top[0] * np.log1p(n), *map(np.log1p, beyond), np.log1p(n), sum(beyond[:1]) / n]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weighted logistic regression by Newton's method; the first weight is the constant."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (weight * (p - y)) / weight.sum() + ridge * np.concatenate(([0], w[1:])) / 10
        curve = (z * (weight * p * (1 - p))[:, None]).T @ z / weight.sum() + (ridge / 10 + 1e-9) * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    slopes = w[1:] / scale
    return np.concatenate(([w[0] - (slopes * mean).sum()], slopes))


def dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> tuple[bytes, bytes]:
    """The ordinary and the toxic dictionary of texts of either label."""
    grams = {n: toxic_grams(toxic, ordinary, n) for n in GRAMS}
    segments = Counter(toxic_segments(toxic, grams))
    ranked = sorted(segments, key=lambda s: (-segments[s], s))
    spread = [s for s in ranked for _ in range(min(segments[s], 8))]
    return _dictionary([w for t in ordinary for w in windows(t, 160)], ORDINARY_SIZE), _complete(_dictionary(spread, TOXIC_SIZE // 2), ranked, TOXIC_SIZE)


def fit(toxic: list[bytes], ordinary: list[bytes], n_toxic: int, n_ordinary: int) -> Model:
    """A model of the sampled texts of either label; n_* are the labels' counts over all training rows."""
    if not toxic or not ordinary:
        return Model(b"", b"", np.concatenate(([30.0 if toxic else -30.0], np.zeros(5 + len(_GAINS)))))
    model = Model(*dictionaries(toxic, ordinary), np.zeros(1))
    folds = CALIBRATION_FOLDS if min(len(toxic), len(ordinary)) >= CALIBRATION_FOLDS else 1
    x, y = [], []
    for k in range(folds):
        others = [[t for i, t in enumerate(texts) if i % folds != k] for texts in (toxic, ordinary)]
        plain, both = (model if folds == 1 else Model(*dictionaries(*others), np.zeros(1))).compressors()
        for label, texts in ((1.0, toxic), (0.0, ordinary)):
            x += [features(t, plain, both) for t in texts[k::folds]]
            y += [label] * len(texts[k::folds])
    y = np.array(y)
    model.weights = _logistic(np.array(x), y, np.where(y == 1, n_toxic / len(toxic), n_ordinary / len(ordinary)))
    return model


def train(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", train_rows: int = TRAIN_ROWS) -> Model:
    """Fit on labelled rows that aren't held out: ``train_rows`` of either label, drawn by a hash of the id.

    Labels other than 0 and 1 and null ids are left out. Repeated label rows count once;
    an id with both labels has none.
    """
    known = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_y")).where(~held_out(F.col("_id")) & F.col("_y").isin(0, 1))
    known = known.groupBy("_id").agg(F.min("_y").alias("_y"), F.max("_y").alias("_most")).where(F.col("_y") == F.col("_most")).drop("_most")
    counts = {r["_y"]: r["count"] for r in known.groupBy("_y").count().collect()}
    drawn = [known.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(train_rows) for y in (0, 1)]
    # at most 2 * train_rows ids
    wanted = F.broadcast(drawn[0].unionAll(drawn[1]))
    rows = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text")).join(wanted, "_id").select(F.col("_y").alias("y"), F.encode("_text", "UTF-8").alias("sample"))

    n_toxic, n_ordinary = counts.get(1, 0), counts.get(0, 0)

    def learn(batches):
        sample = sorted(row for batch in batches for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        model = fit([t for y, t in sample if y], [t for y, t in sample if not y], n_toxic, n_ordinary)
        yield pa.RecordBatch.from_arrays([pa.array([model.ordinary], pa.binary()), pa.array([model.toxic], pa.binary()), pa.array([model.weights.tolist()], pa.list_(pa.float64()))], names=["ordinary", "toxic", "weights"])
        del sample, model
        release()

    # the bounded sample is learnt from in one task; the driver gets the dictionaries and weights
    model = rows.repartition(1).mapInArrow(learn, "ordinary binary, toxic binary, weights array<double>").first()
    if model is None:
        return fit([], [], 0, 0)
    return Model(bytes(model.ordinary), bytes(model.toxic), np.array(model.weights))


def _scorer(shared):
    made: list = []

    def score(column) -> np.ndarray:
        model = shared.value
        if not made:
            made.extend(model.compressors())
        data, offsets = as_bytes(column)
        x = [features(data[lo:hi].tobytes(), *made, model.window) for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        return model.score(np.array(x).reshape(len(x), len(model.weights) - 1))

    return score


def scores(docs: DataFrame, model: Model, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted (score >= 0.5) of each row, without a shuffle.

    Null and empty texts have the score of a text without windows. A null id isn't
    held out. Repeated rows are scored each; other columns are ignored. Without
    training rows of label 1 all scores are near 0, without any of label 0 near 1.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[doc_id].dataType.simpleString()
    read = docs.select(F.col(doc_id), held_out(F.col(doc_id)).alias("held_out"), F.col(text).cast("string").alias("_text"))

    def run(batches):
        score = _scorer(shared)
        for batch in batches:
            s = score(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))], names=[doc_id, "held_out", "score", "predicted"])
        release()

    return read.mapInArrow(run, f"{doc_id} {kind}, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose score is below 0.5. No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        score = _scorer(shared)
        for batch in batches:
            yield batch.filter(pa.array(score(batch.column(batch.schema.get_field_index(text))) < 0.5))
        release()

    return docs.mapInArrow(run, docs.schema)
