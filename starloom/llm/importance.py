"""Target-distribution importance resampling with hashed n-grams.

Every text is reduced to its words joined by one blank, so each run of 1 to
``MAX_N`` words is one byte range. An n-gram's bucket is the crc32 of its bytes
modulo the number of buckets. The method counts the buckets of all documents
and of all target texts, turns the two counts into a gain per bucket, gives
each document the floored mean of its n-grams' gains, adds Gumbel noise drawn
from the document's id, and draws the highest scores: a sample without
replacement in proportion to exp(weight / 1000).

N-grams are interned block by block in an open-addressed NumPy table
(``BucketTable``). Keys are xxhash64 values, linear probing resolves equal slots,
and the bytes are compared before an occurrence joins a slot, so two n-grams
that share a hash never share a slot. A slot stores the n-gram's bucket, whose
crc32 is taken once per distinct n-gram, and its count. Every occurrence keeps
its slot id; the second pass gathers gains by slot id.

At scale: two narrow passes over the texts. The first sends at most one count
per bucket from a task, the second one short row per document. Gains are one
array of ``buckets`` numbers. Ranks come from a histogram of scores (scores are
integers of a range that logarithms bound, so it has some ten thousand rows)
that yields the cut, and from ranges written once for the rows above it; no
window or sort sees all rows in one task. A text of any length is read in
blocks of ``BLOCK_WORDS`` words. The driver holds the bucket counts, the
number of documents and the cut.

Defined cases: words are runs of letters a-z (after lower-casing A-Z), digits
and all non-ASCII characters; a null or empty text has no word, 0 n-grams and
weight 0, and is never drawn. A null doc_id is hashed as the empty text and
comes last among ties. Rows that repeat are each scored and ranked; rows equal
in score and doc_id are ordered by their number of n-grams and weight. With an
empty target all gains follow from T = 0; with no documents the result is
empty. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.llm.common import column_bytes, slices, small_batches, staged
from starloom.llm.grams import Bytes, GramTable, joined_words
from starloom.plans.ranges import stage_ranges, with_offsets

MAX_N = 2
BUCKETS = 10_000
PERCENT = 25
MIN_WORDS = 20
SEED = 7
BLOCK_WORDS = 1 << 16

def grams(starts: np.ndarray, ends: np.ndarray, row: np.ndarray, lo: int, hi: int, max_n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, length, row)`` of all runs of 1 to ``max_n`` words of one row that begin with words lo to hi - 1."""
    found = []
    for n in range(1, max_n + 1):
        first = np.arange(lo, min(hi, len(starts) - n + 1))
        first = first[row[first] == row[first + n - 1]]
        found.append((starts[first], ends[first + n - 1] - starts[first], row[first]))
    return tuple(np.concatenate(x) for x in zip(*found))


class BucketTable(GramTable):
    """The distinct n-grams of one block; a slot also stores its n-gram's bucket."""

    def __init__(self, text: Bytes, start: np.ndarray, length: np.ndarray, buckets: int, keys: np.ndarray | None = None):
        super().__init__(text, start, length, keys)
        self.bucket = np.zeros(self.size, np.int64)
        self.bucket[self.used] = text.crc32(start[self.first], length[self.first]) % buckets

    def bucket_counts(self, buckets: int) -> np.ndarray:
        out = np.zeros(buckets, np.int64)
        np.add.at(out, self.bucket[self.used], self.count[self.used])
        return out


def _tables(batch: pa.RecordBatch, max_n: int, buckets: int) -> Iterator[tuple[int, int, np.ndarray, BucketTable | None, np.ndarray]]:
    """Of rows lo to hi: ``(lo, hi, words per row, None, _)`` once, then a table and the row of each occurrence for every block."""
    data, offsets = column_bytes(batch.column("body"))
    for lo, hi in slices(offsets):
        text, starts, ends, row = joined_words(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo])
        yield lo, hi, np.bincount(row, minlength=hi - lo), None, row
        held = Bytes(text)
        for at in range(0, len(starts), BLOCK_WORDS):
            start, length, where = grams(starts, ends, row, at, at + BLOCK_WORDS, max_n)
            yield lo, hi, np.zeros(0, np.int64), BucketTable(held, start, length, buckets), where


def _count(max_n: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, _, table, _ in _tables(batch, max_n, buckets):
                if table is not None:
                    total += table.bucket_counts(buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    return run


def _weigh(max_n: int, buckets: int, gains: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            n_words, n_grams, total = (np.zeros(n, np.int64) for _ in range(3))
            for lo, hi, per_row, table, where in _tables(batch, max_n, buckets):
                if table is None:
                    n_words[lo:hi] = per_row
                else:
                    n_grams[lo:hi] += np.bincount(where, minlength=hi - lo)
                    slot_gain = gains[table.bucket]
                    total[lo:hi] += np.rint(np.bincount(where, slot_gain[table.slot], hi - lo)).astype(np.int64)
            weight = np.where(n_grams > 0, total // np.maximum(n_grams, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words), pa.array(n_grams), pa.array(weight)],
                                             names=["doc_id", "n_words", "n_features", "weight"])

    return run


def _bodies(df: DataFrame, *columns: Column) -> DataFrame:
    return df.select(*columns, F.concat(F.coalesce("text", F.lit("")), F.lit("\n")).cast("binary").alias("body"))


def bucket_counts(texts: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS) -> np.ndarray:
    """N-grams of the whole table by bucket (an array of ``buckets`` numbers)."""
    small_batches(texts.sparkSession)
    counts = _bodies(texts).mapInArrow(_count(max_n, buckets), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in counts.collect():  # at most one row per bucket
        out[r.bucket] = r.n
    return out


def bucket_gains(docs: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) for each of the B buckets."""
    size, s_all, t_all = len(docs), int(docs.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + size) / ((s + 1) * (t_all + size))))
                     for s, t in zip(docs.tolist(), target.tolist())], np.int64)


def _noise(seed: int) -> Column:
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def weigh(docs: DataFrame, target: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every row of ``docs``."""
    gains = bucket_gains(bucket_counts(docs, max_n, buckets), bucket_counts(target, max_n, buckets))
    weights = _bodies(docs, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(
        _weigh(max_n, buckets, gains), "doc_id long, n_words long, n_features long, weight long")
    return weights.withColumn("score", F.col("weight") + _noise(seed))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, max_n: int = MAX_N,
             buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank``: ``rank`` numbers the drawn documents, null elsewhere."""
    rows = staged(weigh(docs, target, max_n, buckets, seed), "weights")
    able = F.col("n_words") >= min_words
    by_score = staged(rows.filter(able).groupBy("score").agg(F.count(F.lit(1)).alias("n")), "scores")
    draw = percent * (by_score.agg(F.sum("n")).first()[0] or 0) // 100
    upward = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)  # some ten thousand rows, see above
    cut = by_score.withColumn("upto", F.sum("n").over(upward)).filter(F.col("upto") >= draw).agg(F.max("score")).first()[0]
    none = F.lit(None).cast("long").alias("rank")
    if not draw:
        return rows.withColumn("rank", none)
    above = able & (F.col("score") >= cut)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight"), F.asc("_salt")]
    ranged = with_offsets(stage_ranges(rows.filter(above).withColumn("_salt", F.rand(seed)), order))
    place = F.col("_off") + F.col("_rn")
    drawn = ranged.select(*rows.columns, F.when(place <= draw, place).cast("long").alias("rank"))
    return drawn.unionByName(rows.filter(~above).withColumn("rank", none))
