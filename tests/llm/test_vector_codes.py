import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import vector_codes


def brute(rows, parts=16, entries=64, rounds=2, scale=256):
    kept = [(i, lab, [math.floor(scale * x) for x in v]) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    length = -(-max((len(v) for _, _, v in kept), default=0) // parts)
    cut = lambda v: [tuple((v + [0] * (parts * length))[p * length: (p + 1) * length]) for p in range(parts)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    data = [(i, lab, cut(v)) for i, lab, v in kept]
    books = [[d[2][p] for d in data[:entries]] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p, book in enumerate(books):
            groups = defaultdict(list)
            for _, _, v in data:
                groups[near(v[p], book)[1]].append(v[p])
            books[p] = [tuple(sum(c) // len(groups[k]) for c in zip(*groups[k])) if k in groups else e for k, e in enumerate(book)]
    out, by_label = [], defaultdict(int)
    for i, lab, v in data:
        found = [near(v[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), lab))
        by_label[lab] += out[-1][2]
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return sorted(((i, c, e, by_label[lab]) for i, c, e, lab in out), key=repr), digest


def coded(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    for name in ("values", "near", "code", "error", "_rows", "_label"):
        df = df.withColumn(name, F.lit("x"))
    codes, books = vector_codes.compress(df, **kw)
    return sorted(map(tuple, codes.select("vec_id", "code", "error", "label_error").collect()), key=repr), books


def vectors(n, width, seed, grid=None):
    rng = random.Random(seed)
    draw = (lambda: rng.randrange(grid) / 4) if grid else (lambda: rng.gauss(0, 1))
    return [(i, np.float32([draw() for _ in range(width)]).tolist(), rng.choice([None, 0, 1, 2])) for i in range(n)]


@pytest.mark.parametrize("n, width, grid", [(300, 32, None), (300, 32, 3), (40, 16, None), (1, 16, None), (200, 64, 2)])
def test_matches_brute_force(spark, n, width, grid):
    rows = vectors(n, width, n, grid)
    got, books = coded(spark, rows)
    assert (got, books.digest) == brute(rows)


def test_matches_brute_force_on_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    codes, books = vector_codes.compress(df)
    got = sorted(map(tuple, codes.select("vec_id", "code", "error", "label_error").collect()), key=repr)
    assert (got, books.digest) == brute(rows)


def test_nulls_repeats_lengths_and_empty(spark):
    rows = vectors(90, 33, 7)  # a width the parts do not divide
    rows += [(200, None, 1), (201, [1.0, None], 1), (202, [float("nan")] * 33, 0), (203, [float("inf")] * 33, 0), (204, [], 3), (205, [1.5] * 7, None)]
    rows += [(None, rows[0][1], 1), (None, rows[1][1], None), (3, rows[3][1], rows[3][2]), (3, rows[4][1], 9)] + [rows[5]] * 40
    got, books = coded(spark, rows)
    assert (got, books.digest) == brute(rows)
    assert coded(spark, [])[0] == []
    assert coded(spark, [(1, [], 0), (2, [], None)])[0] == brute([(1, [], 0), (2, [], None)])[0]
    with pytest.raises(ValueError, match="must not exceed"):
        coded(spark, [(1, [1e30], 0)])


def test_hot_and_small_labels(spark):
    rows = vectors(400, 16, 3)
    rows = [(i, v, 7 if i % 3 else i) for i, v, _ in rows]
    df = spark.createDataFrame([(i, lab, "c", i * 10) for i, _, lab in rows], "vec_id long, label int, code string, error long")
    for hot in (2, 1000):
        got = {r.vec_id: r.label_error for r in vector_codes.label_errors(df, 400, hot).collect()}
        assert got == {i: sum(j * 10 for j, _, other in rows if other == lab) for i, _, lab in rows}


def test_bounds_prune_and_stay_exact():
    rng = np.random.default_rng(1)
    parts = rng.integers(-200, 200, (4000, 4))
    book = parts[:64]
    pivots = vector_codes.choose_pivots(book[None], 4)[0]
    near = vector_codes.squared(parts[:, None], pivots[None])
    entry, best, tried = vector_codes.nearest(parts, near, book, pivots)
    exact = vector_codes.squared(parts[:, None], book[None])
    assert entry.tolist() == exact.argmin(1).tolist() and best.tolist() == exact.min(1).tolist()
    assert tried < 0.25 * 64 * 4000
