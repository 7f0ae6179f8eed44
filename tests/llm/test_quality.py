import zlib

import numpy as np
from conftest import docs_frame

from starloom.llm import quality


def auc(score, y):
    order = np.argsort(score, kind="stable")
    _, inverse, count = np.unique(np.array(score)[order], return_inverse=True, return_counts=True)
    ranks = (np.cumsum(count) - (count - 1) / 2)[inverse]
    y = np.array(y)[order]
    return (ranks[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = {r.doc_id: r for r in quality.scores(docs, labels).collect()}
    assert len(rows) == docs.count()
    for r in rows.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    test = [(rows[x.doc_id], x.quality) for x in labels.collect() if x.doc_id in rows and rows[x.doc_id].held_out]
    right = np.mean([r.predicted == y for r, y in test])
    area = auc([r.score for r, _ in test], [y for _, y in test])
    print("held-out", len(test), "accuracy", right, "auc", area)
    assert right >= 0.95 and area >= 0.95


def test_labels_of_the_held_out_fold_are_never_read(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    from pyspark.sql import functions as F

    other = labels.withColumn("quality", F.when(quality.fold() == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert sorted(quality.scores(documents, labels).collect()) == sorted(quality.scores(documents, other).collect())


def test_edges(spark):
    df = docs_frame(spark, [None, "", "a", "b " * 40_000, "a"]).withColumnRenamed("lang", "score").withColumnRenamed("source", "body")
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    assert quality.scores(df, labels).count() == 5
    assert {r.predicted for r in quality.scores(df, labels.limit(0)).collect()} == {1}
    assert quality.scores(df.limit(0), labels).collect() == []
    kept = quality.keep_good(df, labels)
    assert kept.columns == df.columns and kept.count() == 5
    none = spark.createDataFrame([(None, "x")], "doc_id long, text string")
    assert [r.held_out for r in quality.scores(none, labels).collect()] == [False]


def test_pooling_is_isotonic():
    x, v = quality.pooled(np.arange(6.0), np.ones(6), np.array([0, 1, 0, 1, 1, 0.0]))
    assert (np.diff(v) >= 0).all() and len(x) == len(v)


def test_pooling_equals_the_plain_isotonic_fit():
    """The fit at i is the largest, over starts up to i, of the least mean over ends from i."""
    from fractions import Fraction

    rng = np.random.default_rng(11)
    for _ in range(40):
        m = int(rng.integers(1, 13))
        n = rng.integers(1, 6, m)
        good = np.array([rng.integers(0, k + 1) for k in n])
        mean = lambda a, b: Fraction(int(good[a:b].sum()), int(n[a:b].sum()))  # noqa: E731, B023
        fit = [max(min(mean(a, b) for b in range(i + 1, m + 1)) for a in range(i + 1)) for i in range(m)]
        edges = [0, *[i for i in range(1, m) if fit[i] != fit[i - 1]], m]
        blocks = [slice(a, b) for a, b in zip(edges, edges[1:])]
        x, v = quality.pooled(np.arange(m, dtype=float), n.astype(float), good.astype(float))
        assert np.allclose(x, [(np.arange(m)[s] * n[s]).sum() / n[s].sum() for s in blocks])
        assert np.allclose(v, [(good[s].sum() + 0.5) / (n[s].sum() + 1) for s in blocks])


def test_summed_equations_equal_a_dense_solve(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    stats = quality.staged(quality.statistics_rows(documents.repartition(7)), "test-statistics")
    model = quality.train(stats, labels)
    given = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None}
    rows = [(np.array(r.stats, float), given[r.doc_id]) for r in stats.collect()
            if r.doc_id in given and zlib.crc32(str(r.doc_id).encode()) % 3 == 2]
    raw, y = np.array([s for s, _ in rows]), np.array([q for _, q in rows], float)
    scale = raw.std(axis=0)
    assert np.allclose(model.mean, raw.mean(axis=0)) and np.allclose(model.scale, np.where(scale > 1e-6, scale, 1.0))
    z, k = model.fourier(raw), quality.N_FOURIER
    penalty = quality.RIDGE * len(z) / k
    # ridge as least squares: the penalty as further rows of a dense system, none for the constant
    dense = np.vstack([z, np.sqrt(penalty) * np.eye(k, k + 1)])
    weights = np.linalg.lstsq(dense, np.append(y, np.zeros(k)), rcond=None)[0]
    assert np.allclose(z @ model.weights, z @ weights, atol=1e-5)
