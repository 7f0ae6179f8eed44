"""Exact top-k inner products with an impact-ordered index, score at a time.

Vectors are dealt by hash into shards of about ``SHARD_ROWS`` rows; the
queries travel to every shard in blocks. A task indexes ``INDEX_ROWS`` rows of
its shard at a time. Their components
become postings: all rows whose component in one dimension has the same
quantised value form a segment, and segments are processed for the block's
queries by descending magnitude of that value, adding to one accumulator for
each row and query.

What is still missing from an accumulator is bounded: a processed posting lies
less than one quantum above its quantised value, and the unprocessed ones of a
row add at most (norm of their values) x (norm of the query). Processing stops
once these bounds prove that few rows can still be among the best k; every row
that can is then rescored exactly. Rows that cannot are dropped by proof only,
so the result is exact for any data, ties included; an index that never lets
it stop early ends as a full scan.

Each query has a bar, a score that its k-th best row reaches at least: first
the k-th best score in one shard of ``FIRST``, which are searched before the
others, then that of the rows its task has seen. Rows below the bar are
neither kept nor rescored, so behind the first pass about k x ``FIRST`` rows
of a query leave all other shards together. A last top-k by (score, smaller
vec_id) ends it.

Defined cases: vectors that are null or hold null or non-finite components
take no part; components missing in a shorter vector count as zero; scores
must fit a 64-bit integer. Rows that share the query's vec_id are the query's
own. A repeated query row is answered once; a repeated candidate row counts
twice. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.llm.common import staged
from starloom.llm.vectors import matrix, usable

K = 10
SCALE = 1024
MIN_SHARDS = 8
SHARD_ROWS = 1 << 16
QUERY_ROWS = 1 << 15
INDEX_ROWS = 8192  # rows indexed at a time
FIRST = 32         # one shard in so many sets the bars of the others
LEVELS = 128      # magnitudes of quantised values
TOGETHER = 256    # queries accumulated at a time
CHECKS = 8        # how often the bounds are examined

LOWEST = np.iinfo(np.int64).min
_OUT = "query_key long, query_id long, vec_id long, score long"


class ImpactIndex:
    """Posting segments of integer vectors, ordered by descending quantised magnitude."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        n, width = rows.shape
        self.step = max(1, int(np.abs(rows).max(initial=0)) // LEVELS)
        level = rows // self.step
        row, dim = np.repeat(np.arange(n), width), np.tile(np.arange(width), n)
        flat = level.ravel()
        order = np.lexsort((row, flat, dim, -np.abs(flat)))
        self.row, self.dim, self.level = row[order], dim[order], flat[order]
        edge = np.ones(len(order), bool)
        edge[1:] = (self.dim[1:] != self.dim[:-1]) | (self.level[1:] != self.level[:-1])
        self.start = np.append(np.flatnonzero(edge), len(order))
        square = rows.astype(np.float64).ravel()[order] ** 2
        # what is left of each row after a given segment, at the places where bounds are examined
        count = len(self.start) - 1
        self.stops = sorted({max(1, count * (i + 1) // CHECKS) for i in range(CHECKS)}) if count else []
        left = np.bincount(self.row, square, n) if count else np.zeros(n)
        self.longest = float(np.sqrt(left.max(initial=0)))
        self.left = {}
        at = 0
        for stop in self.stops:
            part = slice(self.start[at], self.start[stop])
            left = left - np.bincount(self.row[part], square[part], n)
            self.left[stop] = np.sqrt(np.maximum(left, 0) * (1 + 1e-9) + 1e-3)
            at = stop
        if count:
            self.left[self.stops[-1]] = np.zeros(n)

    def possible(self, queries: np.ndarray, own: np.ndarray, k: int, floor: np.ndarray) -> np.ndarray:
        """(rows, queries): True where a row may be among the query's k best at ``floor`` or more; ``own`` rows never are.

        Bounds are doubles: they are loosened by more than their rounding, and prove nothing where a score could leave 63 bits.
        """
        n, m = len(self.rows), len(queries)
        norm = np.sqrt((queries.astype(np.float64) ** 2).sum(1))
        largest = self.longest * norm + self.step * np.abs(queries.astype(np.float64)).sum(1)
        if n <= k or not self.stops or largest.max(initial=0) >= 2.0**62:
            return ~own
        margin = 1 + 1e-12 * largest
        acc = np.zeros((n, m), np.int64)
        columns = np.ascontiguousarray(queries.T)
        above = self.step * np.maximum(queries, 0).sum(1).astype(np.float64)
        below = self.step * np.minimum(queries, 0).sum(1).astype(np.float64)
        at = 0
        for stop in self.stops:
            for s in range(at, stop):
                lo, hi = self.start[s], self.start[s + 1]
                impact = self.level[lo] * self.step
                if impact:
                    acc[self.row[lo:hi]] += columns[self.dim[lo]] * impact
            at = stop
            slack = self.left[stop][:, None] * norm * (1 + 1e-9)
            low = acc + (below - slack)
            low[own] = -np.inf
            bar = np.maximum(np.partition(low, n - k, axis=0)[n - k], floor)
            maybe = (acc + (above + slack) >= bar - margin) & ~own
            if maybe.sum() <= 8 * k * m:
                break
        return maybe

    def best(self, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int,
             floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(query number, vec_id, score)`` of the k best rows of every query, of those that score its ``floor`` or more."""
        floor = np.full(len(queries), LOWEST) if floor is None else floor
        out: list[list[np.ndarray]] = [[], [], []]
        for lo in range(0, len(queries), TOGETHER):
            part = queries[lo: lo + TOGETHER]
            maybe = self.possible(part, ids[:, None] == query_ids[None, lo: lo + TOGETHER], k, floor[lo: lo + TOGETHER])
            for j in range(len(part)):
                rows = np.flatnonzero(maybe[:, j])
                score = self.rows[rows] @ part[j]
                rows, score = rows[score >= floor[lo + j]], score[score >= floor[lo + j]]
                top = np.lexsort((ids[rows], -score))[:k]
                out[0].append(np.full(len(top), lo + j))
                out[1].append(ids[rows][top])
                out[2].append(score[top])
        return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)


def best_of(rows: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, floor: np.ndarray, k: int,
            index_rows: int = INDEX_ROWS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``ImpactIndex.best`` over any number of rows, ``index_rows`` at a time; each query's k-th score so far is its next floor."""
    floor = floor.copy()
    number, vec_id, score = (np.zeros(0, np.int64) for _ in range(3))
    for lo in range(0, len(rows), index_rows):
        more = ImpactIndex(rows[lo: lo + index_rows]).best(ids[lo: lo + index_rows], queries, query_ids, k, floor)
        number, vec_id, score = (np.concatenate(x) for x in zip((number, vec_id, score), more))
        order = np.lexsort((vec_id, -score, number))
        first = np.searchsorted(number[order], np.arange(len(queries)))
        rank = np.arange(len(order)) - first[number[order]]
        order = order[rank < k]
        number, vec_id, score = number[order], vec_id[order], score[order]
        full = rank[rank < k] == k - 1
        floor[number[full]] = np.maximum(floor[number[full]], score[full])
    return number, vec_id, score


def _search(k: int, index_rows: int):
    names = ["query_key", "query_id", "vec_id", "score"]

    def run(shard: pa.Table, queries: pa.Table) -> pa.Table:
        if not shard.num_rows or not queries.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        rows, asked = matrix(shard["values"]), matrix(queries["values"])
        width = max(rows.shape[1], asked.shape[1])
        rows = np.pad(rows, ((0, 0), (0, width - rows.shape[1])))
        asked = np.pad(asked, ((0, 0), (0, width - asked.shape[1])))
        keys, query_ids, floor = (queries[c].to_numpy() for c in ("query_key", "query_id", "floor"))
        number, vec_id, score = best_of(rows, shard["vec_id"].to_numpy(), asked, query_ids, floor, k, index_rows)
        return pa.table(dict(zip(names, (keys[number], query_ids[number], vec_id, score))))

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding",
          shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS, min_shards: int = MIN_SHARDS, index_rows: int = INDEX_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best rows of ``vectors`` for each row that ``is_query`` selects."""
    ints = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = staged(vectors.filter(usable(vector_col)).select(
        F.col(id_col).cast("long").alias("vec_id"), ints.alias("values"), is_query.alias("asked")).filter("vec_id is not null"), "vectors")
    asked = staged(rows.filter("asked").dropDuplicates(["vec_id", "values"]).select(
        F.xxhash64("vec_id", "values").alias("query_key"), F.col("vec_id").alias("query_id"), "values"), "queries")
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asked").alias("q")).first()
    shards, blocks = max(min_shards, -(-sizes.n // shard_rows)), max(1, -(-sizes.q // query_rows))
    first = -(-shards // FIRST)
    dealt = rows.select("vec_id", "values", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard"))
    blocked = asked.withColumn("block", F.pmod(F.xxhash64("query_key"), F.lit(blocks)).cast("int"))

    def searched(part: DataFrame, queries: DataFrame, lowest: int, highest: int) -> DataFrame:
        """The best rows of shards ``lowest`` to ``highest``; every query travels to each of them."""
        if highest < lowest:
            return spark.createDataFrame([], _OUT)
        left = part.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        right = queries.withColumn("shard", F.explode(F.sequence(F.lit(lowest).cast("long"), F.lit(highest).cast("long"))))
        return left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(_search(k, index_rows), _OUT)

    spark = vectors.sparkSession
    best = Window.partitionBy("query_key").orderBy(F.col("score").desc(), "vec_id")
    ranked = lambda found: found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    seen = staged(ranked(searched(dealt.filter(F.col("shard") < first), blocked.withColumn("floor", F.lit(int(LOWEST)).cast("long")), 0, first - 1)), "first")
    bars = seen.filter(F.col("rank") == k).select("query_key", F.col("score").alias("bar"))
    barred = blocked.join(bars, "query_key", "left").withColumn("floor", F.coalesce("bar", F.lit(int(LOWEST)).cast("long"))).drop("bar")
    rest = searched(dealt.filter(F.col("shard") >= first), barred, first, shards - 1)
    return ranked(seen.select(rest.columns).unionByName(rest)).select("query_id", "rank", "vec_id", "score")
