"""Vector code compression: product codes whose entries are found with LAESA pivots.

Vectors become integers and are cut into ``PARTS`` equal parts; each part
position has a codebook, fitted by ``ROUNDS`` rounds of assignment and integer
means that start from the vectors with the smallest ids.

The nearest entry is exact. A few *pivots* per part position are fixed once
(entries of the first codebook, each the farthest from those before it), and
the distances from every part to its pivots are computed once and stored with
the vectors. A round computes only the distances from pivots to entries; by
the triangle inequality |d(part, pivot) - d(pivot, entry)| is a lower bound on
the distance from part to entry. Entries are tried in ascending order of their
greatest bound, each by an exact integer distance, until the next bound proves
that no later entry can be as near. Bounds carry a margin over the rounding of
square roots, so entries at equal distance are all tried and ties go to the
lower index. ``evaluations`` counts what the pruning leaves.

At scale: the vectors are staged once as integers with their pivot distances
and read once per round in narrow tasks; a task sends one sum per codebook
component and the driver holds the codebooks (parts x entries x part length).
Errors by label: a label holding more than one row in ``HOT`` is one of fewer
than ``HOT`` such labels, whose sums are broadcast; rows of all other labels
meet their sums in a shuffle join, in which no label is large.

Defined cases: vectors that are null or hold null or non-finite components are
dropped. Shorter vectors are filled with zeros up to the longest, and the
width is filled up to a multiple of the parts. With fewer vectors than entries
the codebooks are that much shorter; an empty table gives an empty result.
Repeated vec_ids are separate rows, ordered by their components; a null vec_id
comes last. Labels may be null (one group) and of any type that can be
compared. Scaled components beyond ``LIMIT`` raise, as squares would overflow.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import small_batches, staged
from starloom.llm.vectors import matrix, usable

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
PIVOTS = 4
HOT = 1000
LIMIT = 1 << 26
_MARGIN = 1e-12


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances along the last axis."""
    return ((a - b) ** 2).sum(-1)


def choose_pivots(codebooks: np.ndarray, count: int) -> np.ndarray:
    """(parts, pivots, length): entries of each part position, each the farthest from those chosen before it."""
    chosen = []
    for book in codebooks:
        at, near = [0], squared(book, book[0])
        while len(at) < min(count, len(book)):
            at.append(int(near.argmax()))
            near = np.minimum(near, squared(book, book[at[-1]]))
        chosen.append(book[at])
    return np.stack(chosen)


def nearest(parts: np.ndarray, to_pivots: np.ndarray, book: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """``(entry, squared distance, evaluations)`` of one part position.

    ``parts`` (n, length) and ``to_pivots`` (n, pivots, squared) belong together; ties go to the lower entry.
    """
    part_pivot = np.sqrt(to_pivots.astype(np.float64))
    pivot_entry = np.sqrt(squared(pivots[:, None], book[None]).astype(np.float64))
    bound = np.zeros((len(parts), len(book)))
    for p in range(len(pivots)):
        a, b = part_pivot[:, p, None], pivot_entry[p]
        np.maximum(bound, np.abs(a - b) - _MARGIN * (a + b), out=bound)
    order = np.argsort(bound, axis=1, kind="stable")
    bound = np.take_along_axis(bound, order, axis=1)
    entry = np.full(len(parts), len(book), np.int64)
    best = np.full(len(parts), np.iinfo(np.int64).max)
    live, tried = np.arange(len(parts)), 0
    for step in range(len(book)):
        live = live[bound[live, step] <= np.sqrt(best[live].astype(np.float64)) * (1 + _MARGIN)]
        if not len(live):
            break
        tried += len(live)
        e = order[live, step]
        d = squared(parts[live], book[e])
        better = (d < best[live]) | ((d == best[live]) & (e < entry[live]))
        best[live[better]], entry[live[better]] = d[better], e[better]
    return entry, best, tried


def _cut(values: np.ndarray, parts: int, length: int) -> np.ndarray:
    out = np.zeros((len(values), parts * length), np.int64)
    out[:, : values.shape[1]] = values
    return out.reshape(len(values), parts, length)


def _with_pivots(pivots: np.ndarray, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = _cut(matrix(batch.column("values")), len(pivots), length)
            near = squared(cut[:, :, None], pivots[None])
            flat = near.reshape(len(cut), near.shape[1] * near.shape[2])
            edges = lambda x: pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32())
            wide = cut.reshape(len(cut), cut.shape[1] * cut.shape[2])
            columns = [batch.column("vec_id"), batch.column("label"),
                       pa.ListArray.from_arrays(edges(wide), pa.array(wide.ravel().astype(np.int32))),
                       pa.ListArray.from_arrays(edges(flat), pa.array(flat.ravel()))]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "values", "near"])

    return run


def _assigned(batch: pa.RecordBatch, books: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """``(parts, entries, squared distances, evaluations)`` of a batch."""
    parts, count, length = books.shape
    cut = _cut(matrix(batch.column("values")), parts, length)
    near = matrix(batch.column("near")).reshape(len(cut), parts, pivots.shape[1])
    found = [nearest(cut[:, p], near[:, p], books[p], pivots[p]) for p in range(parts)]
    return cut, np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1), sum(f[2] for f in found)


def _sums(books: np.ndarray, pivots: np.ndarray):
    """Per task: component sums by codebook slot, rows by slot (component -1) and evaluations (slot -1)."""
    parts, count, length = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows, tried = np.zeros((parts * count, length), np.int64), np.zeros(parts * count, np.int64), 0
        for batch in batches:
            if batch.num_rows:
                cut, entry, _, n = _assigned(batch, books, pivots)
                slot = (entry + np.arange(parts) * count).ravel()
                np.add.at(total, slot, cut.reshape(len(slot), length))
                rows += np.bincount(slot, minlength=parts * count)
                tried += n
        used = np.flatnonzero(rows)
        slot = np.concatenate([np.repeat(used, length), used, [-1]])
        component = np.concatenate([np.tile(np.arange(length), len(used)), np.full(len(used) + 1, -1)])
        value = np.concatenate([total[used].ravel(), rows[used], [tried]])
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(component), pa.array(value)], names=["slot", "component", "value"])

    return run


def _codes(books: np.ndarray, pivots: np.ndarray):
    digits = np.array([f"{i:02x}" for i in range(256)], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _, entry, distance, _ = _assigned(batch, books, pivots)
                code = ["".join(row) for row in digits[entry].tolist()]
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(code, pa.string()),
                                                  pa.array(distance.sum(1))], names=["vec_id", "label", "code", "error"])

    return run


class Codebooks:
    """Fitted codebooks: ``books`` (parts, entries, length) and the work of each round."""

    def __init__(self, books: np.ndarray, evaluations: list[int], rows: int):
        self.books, self.evaluations, self.rows = books, evaluations, rows

    @property
    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()


def fit(rows: DataFrame, books: np.ndarray, pivots: np.ndarray, rounds: int, n: int) -> Codebooks:
    """``rounds`` of assignment and means over all of ``rows`` (staged vectors with their pivot distances)."""
    parts, count, length = books.shape
    evaluations = []
    for _ in range(rounds):
        sums = rows.mapInArrow(_sums(books, pivots), "slot long, component long, value long").groupBy("slot", "component").agg(
            F.sum("value").alias("value"))
        total, size = np.zeros((parts * count, length), np.int64), np.zeros(parts * count, np.int64)
        for r in sums.collect():  # at most one row per codebook component
            if r.slot < 0:
                evaluations.append(r.value)
            elif r.component < 0:
                size[r.slot] = r.value
            else:
                total[r.slot, r.component] = r.value
        mean = total // np.maximum(size, 1)[:, None]
        books = np.where((size > 0)[:, None], mean, books.reshape(parts * count, length)).reshape(books.shape)
    return Codebooks(books, evaluations, n)


def label_errors(codes: DataFrame, n: int, hot: int = HOT) -> DataFrame:
    """``codes`` plus ``label_error``, the sum of errors over rows of an equal label (null is a label)."""
    sums = staged(codes.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("_rows")), "labels")
    few = F.broadcast(sums.filter(F.col("_rows") * hot > n).drop("_rows").withColumnRenamed("label", "_label"))  # fewer than `hot` rows
    rest = sums.filter(F.col("_rows") * hot <= n).drop("_rows").withColumnRenamed("label", "_label")
    same = F.col("label").eqNullSafe(F.col("_label"))
    large = codes.join(few, same)
    small = codes.join(few, same, "left_anti").join(rest, same)
    return large.unionByName(small).drop("_label")


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             n_pivots: int = PIVOTS) -> tuple[DataFrame, Codebooks]:
    """``(vec_id, label, code, error, label_error)`` of every valid vector, and the codebooks."""
    spark = vectors.sparkSession
    small_batches(spark)
    ints = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    kept = staged(vectors.filter(usable("embedding")).select(F.col("vec_id").cast("long").alias("vec_id"), "label", ints.alias("values")),
                  "vectors")
    label = kept.schema["label"].dataType
    shape = kept.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("values")).alias("width"),
                     F.max(F.array_max(F.transform("values", F.abs))).alias("largest")).first()
    length = -(-(shape.width or 0) // parts)
    if (shape.largest or 0) > LIMIT:
        raise ValueError(f"scaled components must not exceed {LIMIT}, found {shape.largest}")
    seeds = kept.orderBy(F.asc_nulls_last("vec_id"), "values").limit(entries).collect()
    if not seeds:
        out = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", label), T.StructField("code", T.StringType()),
                            T.StructField("error", T.LongType()), T.StructField("label_error", T.LongType())])
        return spark.createDataFrame([], out), Codebooks(np.zeros((parts, 0, 0), np.int64), [], 0)
    first = np.zeros((len(seeds), parts * length), np.int64)
    for i, r in enumerate(seeds):
        first[i, : len(r["values"])] = r["values"]
    books = np.ascontiguousarray(first.reshape(len(seeds), parts, length).transpose(1, 0, 2))
    pivots = choose_pivots(books, n_pivots)
    held = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", label),
                         T.StructField("values", T.ArrayType(T.IntegerType())), T.StructField("near", T.ArrayType(T.LongType()))])
    rows = staged(kept.mapInArrow(_with_pivots(pivots, length), held), "pivots")
    fitted = fit(rows, books, pivots, rounds, shape.n)
    coded = T.StructType([held["vec_id"], held["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    codes = staged(rows.mapInArrow(_codes(fitted.books, pivots), coded), "codes")
    return label_errors(codes, shape.n), fitted
