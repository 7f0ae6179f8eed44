"""Quality scores: ridge regression on random Fourier features, calibrated isotonically.

Each text gives ``N_STATS`` statistics of its bytes, words and lines (no label,
language, source or id). Standardised, they pass through a fixed random
Fourier map that approximates a Gaussian kernel. Every task sums its part of
the normal equations ``Z'Z`` and ``Z'y``; the parts are added in groups and
one matrix of fixed size is solved. Scores of a second fold, counted in
``BINS`` score bins, are pooled into a monotone calibration.

Folds by ``crc32(doc_id as text) mod 3``: 2 trains the ridge scores, 0
calibrates, 1 is held out and never read with its label.

Only the fixed-size matrix, the feature means and the score bins reach the
driver. All labelled rows are used; nothing is sampled.

Defined cases: a null text is empty and scored like any other; without
labelled rows (or with one class only) the score is the smoothed share of good
labels, 0.5 for none, which predicts 1. A null doc_id is not held out and has
no label. Rows that repeat are each scored. ``scored`` keeps all columns of
its input and adds ``score`` and ``predicted`` (replacing columns so named).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import LOWER, SPACE_WORDS, column_bytes, slices, small_batches, staged, text_bytes, word_hashes, words
from starloom.plans.sizing import bounded_broadcast

N_FOURIER = 256
RIDGE = 1e-3
BINS = 2000
SEED = 11

_CLASS = np.zeros(256, np.uint8)  # 0: control and rest
for _number, _bytes in enumerate([b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r",
                                  b".,;:", b"!?", b"'\"()-", b"#$%&*@^~+=<>", b"|/\\_{}[]`", bytes(range(128, 256))], 1):
    _CLASS[list(_bytes)] = _number
N_CLASSES = 12
N_STATS = N_CLASSES + 13


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(documents, N_STATS) statistics of UTF-8 texts."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    out = np.zeros((n, N_STATS))
    row = np.repeat(np.arange(n), sizes)
    classes = np.bincount(row * N_CLASSES + _CLASS[data], minlength=n * N_CLASSES).reshape(n, N_CLASSES)
    out[:, :N_CLASSES] = np.sqrt(classes / np.maximum(sizes, 1)[:, None])

    starts, ends, at = words(data, offsets, SPACE_WORDS)
    hashes = word_hashes(LOWER[data], starts, ends)
    length, count = ends - starts, np.diff(at)
    word_row = np.repeat(np.arange(n), count)
    per = np.maximum(count, 1)
    mean = np.bincount(word_row, length, n) / per
    upper = _CLASS[data[starts]] == 2 if len(starts) else np.zeros(0, bool)
    last = _CLASS[data[ends - 1]] if len(starts) else np.zeros(0, np.uint8)
    alone = length == 1
    order = np.lexsort((hashes, word_row))
    h, r = hashes[order], word_row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    runs = np.diff(np.append(np.flatnonzero(new), len(h)))
    most = np.zeros(n)
    np.maximum.at(most, r[new], runs)
    pair = (hashes[:-1] == hashes[1:]) & (word_row[:-1] == word_row[1:])

    newline = np.flatnonzero(data == 10)
    lines = np.bincount(row[newline], minlength=n) + 1 if len(newline) else np.ones(n)
    stats = [np.log1p(sizes) / 4, np.log1p(count) / 3, np.log1p(mean), np.sqrt(np.bincount(word_row, (length - mean[word_row]) ** 2, n) / per) / 4,
             np.bincount(word_row, upper, n) / per, np.bincount(word_row, last == 6, n) / per, np.bincount(word_row, last == 7, n) / per,
             np.bincount(word_row, last == 9, n) / per, np.bincount(word_row, alone, n) / per,
             np.bincount(r[new], minlength=n) / per, most / per, np.bincount(word_row[:-1][pair], minlength=n) / per if len(pair) else np.zeros(n),
             np.log1p(count / lines)]
    out[:, N_CLASSES:] = np.stack(stats, 1)
    return out


def batch_statistics(arr: pa.Array) -> np.ndarray:
    data, offsets = column_bytes(arr)
    parts = [statistics(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo]) for lo, hi in slices(offsets)]
    return np.concatenate(parts) if parts else np.zeros((0, N_STATS))


def fold(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3


def held_out() -> Column:
    return F.coalesce(fold() == 1, F.lit(False))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None
    knots: np.ndarray
    values: np.ndarray

    def fourier(self, stats: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(SEED)
        directions = rng.standard_normal((N_STATS, N_FOURIER)) / np.sqrt(N_STATS)
        phases = rng.uniform(0, 2 * np.pi, N_FOURIER)
        x = np.clip((stats - self.mean) / self.scale, -6, 6)
        return np.hstack([np.sqrt(2 / N_FOURIER) * np.cos(x @ directions + phases), np.ones((len(x), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.fourier(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(stats), self.values[0])
        raw = np.clip(self.raw(stats), 0, 1)
        return np.clip(0.999 * np.interp(raw, self.knots, self.values) + 0.001 * raw, 0, 1)  # the raw share breaks ties


def pooled(x: np.ndarray, n: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic fit by pooling adjacent violators: block centres and block means."""
    blocks: list[list[float]] = []
    for xi, ni, gi in zip(x, n, good):
        blocks.append([xi * ni, ni, gi])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    centres = np.array([a / b for a, b, _ in blocks])
    return centres, np.array([(g + 0.5) / (b + 1) for _, b, g in blocks])


def _statistics_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        stats = batch_statistics(batch.column("body")).astype(np.float32)
        flat = pa.ListArray.from_arrays(pa.array(np.arange(0, stats.size + 1, N_STATS, dtype=np.int32)), pa.array(stats.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), flat], names=["doc_id", "stats"])


def statistics_rows(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("body")).mapInArrow(
        _statistics_rows, "doc_id long, stats array<float>")


def _matrix(arr: pa.Array) -> np.ndarray:
    values = arr.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(-1, N_STATS).astype(np.float64)


def _equations(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((N_FOURIER + 1, N_FOURIER + 2))
        for batch in batches:
            z, y = model.fourier(_matrix(batch.column("stats"))), batch.column("quality").to_numpy()
            total[:, :-1] += z.T @ z
            total[:, -1] += z.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((N_FOURIER + 1) * (N_FOURIER + 2))
    for batch in batches:
        for part in batch.column("sums"):
            total += np.frombuffer(part.as_buffer(), np.float64)
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])


def train(stats: DataFrame, labels: DataFrame, ridge: float = RIDGE) -> Model:
    """Fit on ``stats(doc_id, stats)`` joined with ``labels(doc_id, quality)``, without the held-out fold."""
    own = labels.filter("quality is not null and doc_id is not null").filter(fold() != 1).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("quality"), fold().alias("fold"))
    rows = staged(stats.join(own, "doc_id"), "labelled")
    counts = rows.groupBy("fold", "quality").agg(F.count(F.lit(1)).alias("n")).collect()
    good, total = sum(r.n for r in counts if r.quality == 1), sum(r.n for r in counts)
    if len({r.quality for r in counts if r.fold == 2}) < 2:
        return Model(np.zeros(N_STATS), np.ones(N_STATS), None, np.zeros(1), np.array([(good + 0.5) / (total + 1)]))
    fit = rows.filter("fold = 2")
    columns = [F.col("stats")[i].cast("double") for i in range(N_STATS)]
    moments = fit.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)], *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    scale = np.array([moments[f"s{i}"] for i in range(N_STATS)])
    model = Model(np.array([moments[f"m{i}"] for i in range(N_STATS)]), np.where(scale > 1e-6, scale, 1.0), None, np.zeros(1), np.zeros(1))
    parts = fit.select("stats", "quality").mapInArrow(_equations(model), "sums binary")
    sums = parts.repartition(16).mapInArrow(_add, "sums binary").coalesce(1).mapInArrow(_add, "sums binary").first()["sums"]
    matrix = np.frombuffer(bytes(sums), np.float64).reshape(N_FOURIER + 1, N_FOURIER + 2)
    n = matrix[-1, -2]
    model.weights = np.linalg.solve(matrix[:, :-1] + ridge * n * np.diag([1.0 / N_FOURIER] * N_FOURIER + [0.0]) + 1e-9 * np.eye(N_FOURIER + 1), matrix[:, -1])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.clip(model.raw(_matrix(batch.column("stats"))), 0, 1)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum((raw * BINS).astype(np.int64), BINS - 1)), batch.column("quality")], names=["bin", "quality"])

    bins = rows.filter("fold = 0").select("stats", "quality").mapInArrow(binned, "bin long, quality double").groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"), F.sum("quality").alias("good")).orderBy("bin").collect()
    if not bins:
        model.knots, model.values = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    else:
        model.knots, model.values = pooled(np.array([(r.bin + 0.5) / BINS for r in bins]), np.array([r.n for r in bins], float), np.array([r.good for r in bins]))
    return model


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    stats = staged(statistics_rows(docs), "statistics")
    model = train(stats, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(_matrix(batch.column("stats"))))], names=["doc_id", "score"])

    return stats.mapInArrow(run, "doc_id long, score double").select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``; the model learns from the labelled rows of ``docs``."""
    known = docs.join(bounded_broadcast(labels.select("doc_id").distinct()), "doc_id", "left_semi")  # ids move, texts do not
    model = train(staged(statistics_rows(known), "statistics"), labels)
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    plain = docs.select(F.struct(*kept).alias("row"), text_bytes().alias("body"))
    schema = T.StructType([plain.schema["row"], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(model.score(batch_statistics(batch.column("body"))))], names=["row", "score"])

    return plain.mapInArrow(run, schema).select("row.*", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with their own columns only."""
    names = docs.columns
    clash = {c: f"own_{c}" for c in ("score", "predicted") if c in names}
    found = scored(docs.withColumnsRenamed(clash), labels).filter("predicted = 1")
    return found.drop("score", "predicted").withColumnsRenamed({v: k for k, v in clash.items()}).select(names)
