import numpy as np

from starloom.llm import embed_dedup


def brute(rows, cosine=0.9):
    good = [(i, np.array(v, float)) for i, v in rows
            if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    root = {i: i for i, _ in rows}
    links = {i: 0 for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(good):
        for j, b in good[n + 1:]:
            if len(a) == len(b) and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= cosine:
                links[i] += 1
                links[j] += 1
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return sorted((i, links[i], find(i), find(i) == i) for i, _ in rows)


def result(df, **kw):
    return sorted(map(tuple, embed_dedup.near_duplicates(df, **kw).collect()))


def test_matches_brute_force_on_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert result(df) == brute([(r.vec_id, r.embedding) for r in df.collect()])


def test_graph_recall_without_scans():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((3000, 32))
    x = np.repeat(centres, rng.integers(1, 4, 3000), axis=0)
    x = np.concatenate([x, np.tile(centres[:1], (300, 1))])  # one large group
    x += 0.1 * rng.standard_normal(x.shape)
    x /= np.linalg.norm(x, axis=1)[:, None]
    x = x[rng.permutation(len(x))].astype(np.float32)
    graph, q = embed_dedup.Graph(x), x[::3]
    exact = set(zip(*(a.tolist() for a in np.nonzero(q @ x.T >= 0.9))))
    width = graph.audited_width(q, 0.9)
    found = set()
    for r, c in graph.within(q, 0.9, width):
        found.update(zip(r.tolist(), c.tolist()))
    assert found <= exact and len(found) >= 0.98 * len(exact)
    again = embed_dedup.Graph.from_bytes(graph.to_bytes(), x)
    assert (again.search(q[:50], 20)[0] == graph.search(q[:50], 20)[0]).all()


def test_edges(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((12, 6))
    rows = [(i, (base[i % 12] + 0.05 * rng.standard_normal(6)).tolist()) for i in range(60)]
    rows += [(100 + i, base[0].tolist()) for i in range(30)]  # copies
    rows += [(200, None), (201, []), (202, [0.0] * 6), (203, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (204, [float("nan")] * 6),
             (205, [float("inf")] * 6), (206, [1.0, 1.0]), (207, [2.0, 2.0]), (208, [-1.0, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as shard", "'x' as node", "2 as values")
    assert result(df, min_shards=3, query_rows=20) == brute(rows)
    assert result(df, min_shards=3, query_rows=4, blocks_together=2) == brute(rows)
    assert result(df.limit(0)) == []
    null = spark.createDataFrame([(None, [1.0]), (1, [1.0]), (2, [3.0])], "vec_id long, embedding array<double>")
    assert sorted(map(str, embed_dedup.near_duplicates(null).collect())) == sorted(map(str, [
        ("Row(vec_id=None, n_links=0, component_id=None, kept=True)"), "Row(vec_id=1, n_links=1, component_id=1, kept=True)",
        "Row(vec_id=2, n_links=1, component_id=1, kept=False)"]))


def test_star_forest_joins_chains():
    a, b = np.array([5, 3, 9, 1, 20]), np.array([3, 9, 7, 20, 21])
    node, root = embed_dedup.star_forest(a, b)
    assert dict(zip(node.tolist(), root.tolist())) == {1: 1, 20: 1, 21: 1, 3: 3, 5: 3, 7: 3, 9: 3}


def test_small_groups_are_audited_beside_a_third_of_the_rows():
    rng = np.random.default_rng(8)
    pairs = np.repeat(rng.standard_normal((2000, 32)), 2, axis=0)
    x = np.concatenate([pairs, np.tile(rng.standard_normal((1, 32)), (2000, 1))])
    x += 0.1 * rng.standard_normal(x.shape)
    x = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)

    class Missing(embed_dedup.Graph):
        """Narrow beams miss the links of pairs."""

        def within(self, q, threshold, width):
            for r, c in super().within(q, threshold, width):
                keep = (c >= 4000) | (width >= 128)
                yield r[keep], c[keep]

    graph = Missing(x)
    assert graph.audited_width(x[::3], 0.9, own=np.arange(0, len(x), 3)) >= 128
    assert graph.audited_width(x[4000:], 0.9, own=np.arange(4000, len(x))) >= 128  # only the probes have few links
    away = rng.standard_normal((200, 32)).astype(np.float32)
    assert graph.audited_width(away / np.linalg.norm(away, axis=1)[:, None], 0.9) >= 128  # no link in the sample

    whole = embed_dedup.Graph(x)
    width = whole.audited_width(x, 0.9, own=np.arange(len(x)))
    want = np.einsum("ij,ij->i", x[:4000:2], x[1:4000:2]) >= 0.9
    hit = np.zeros(2000, bool)
    for r, c in whole.within(x[:4000:2], 0.9, width):
        hit[r[c == 2 * r + 1]] = True
    assert hit[want].mean() >= 0.98
