import math
import random

import numpy as np
from pyspark.sql import functions as F

from starloom.llm import topk


def brute(rows, asks, k=10):
    ints = {}
    data = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in data:
        if q % asks:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in data if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def result(df, asks, **kw):
    return sorted(map(tuple, topk.top_k(df, F.col("vec_id") % asks == 0, **kw).collect()))


def test_matches_brute_force_on_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = brute(rows, 100)
    assert result(df, 100) == want
    assert result(df, 100, shard_rows=60, query_rows=2) == want
    assert result(df, 100, min_shards=2, index_rows=16) == want


def test_bounds_stop_early_and_stay_exact():
    rng = np.random.default_rng(0)
    rows = (rng.standard_normal((3000, 48)) * np.geomspace(1, 0.01, 48) * 1024).astype(np.int64)
    queries = rows[:20] * 2
    index = topk.ImpactIndex(rows)
    number, ids, score = index.best(np.arange(3000), queries, np.arange(20), 10)
    for j in range(20):
        exact = rows @ queries[j]
        exact[j] = -(1 << 62)
        want = np.lexsort((np.arange(3000), -exact))[:10]
        assert ids[number == j].tolist() == want.tolist() and score[number == j].tolist() == exact[want].tolist()


def test_ties_nulls_lengths_repeats(spark):
    rng = random.Random(1)
    rows = [(i, [float(rng.randrange(3)) for _ in range(4)]) for i in range(60)]
    rows += [(60, None), (62, [1.0, None, 1.0, 1.0]), (64, [float("nan"), 1.0, 1.0, 1.0]), (66, [float("inf")] * 4), (68, [2.0, 2.0]), (70, []), (None, [1.0] * 4)]
    rows += [(80, [1.0] * 4), (80, [1.0] * 4), (81, [-2.0] * 4), (81, [-2.0] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("block", F.lit(3)).withColumn("values", F.lit("x"))
    unique = [r for i, r in enumerate(rows) if r not in rows[:i] or r[0] == 81]
    want = brute(unique, 20)
    got = result(df, 20, shard_rows=16)
    assert [r[:2] + r[3:] for r in got if r[0] != 80] and {r for r in got if r[0] == 80} == {r for r in want if r[0] == 80}
    full = [(i, v) for i, v in rows if i != 80] + [(80, [1.0] * 4)] * 2
    assert [r for r in got if r[0] != 80] == [r for r in brute(full, 20) if r[0] != 80]
    few = spark.createDataFrame(rows[:4], "vec_id long, embedding array<float>")
    assert result(few, 2) == brute(rows[:4], 2)
    assert result(df.limit(0), 2) == []


def test_floors_cut_rows_but_not_answers():
    rng = np.random.default_rng(2)
    rows = rng.integers(-1000, 1000, (2000, 16))
    rows[500:520] = rows[3]  # ties at the bar
    queries, ids = rows[:30], np.arange(2000)
    number, vec_id, score = topk.best_of(rows, ids, queries, np.arange(30), np.full(30, topk.LOWEST), 10, index_rows=128)
    bar = np.array([np.sort(score[number == j])[-10] for j in range(30)])
    for j in range(30):
        exact = rows @ queries[j]
        exact[j] = -(1 << 62)
        assert vec_id[number == j].tolist() == np.lexsort((ids, -exact))[:10].tolist()
    number2, vec_id2, _ = topk.best_of(rows, ids, queries, np.arange(30), bar, 10, index_rows=128)
    assert number2.tolist() == number.tolist() and vec_id2.tolist() == vec_id.tolist()
    assert not len(topk.best_of(rows, ids, queries, np.arange(30), bar + (1 << 40), 10)[0])


def test_bounds_hold_for_scores_beyond_double_precision():
    rng = np.random.default_rng(3)
    rows = rng.integers(1 << 29, (1 << 29) + 50, (400, 4))  # scores near 2**60, apart by less than their rounding
    for j, top in enumerate(topk.best_of(rows, np.arange(400), rows[:5], np.arange(5), np.full(5, topk.LOWEST), 10)[1].reshape(5, 10)):
        exact = rows @ rows[j]
        exact[j] = 0
        assert top.tolist() == np.lexsort((np.arange(400), -exact))[:10].tolist()
    wide = rng.integers(1 << 31, 1 << 32, (60, 2))  # no bound is provable, nothing is cut
    index = topk.ImpactIndex(wide)
    assert index.possible(wide[:2], np.zeros((60, 2), bool), 10, np.full(2, topk.LOWEST)).all()
