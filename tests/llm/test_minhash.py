import random
import re

from conftest import docs_frame
from pyspark.sql import functions as F

from starloom.llm import minhash


def shingle_set(text, k=5):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return frozenset()
    if len(words) < k:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def brute(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, x) in enumerate(sets):
        for j, y in sets[n + 1:]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(s), find(i), find(i) == i) for i, s in sets}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect()}


def test_matches_brute_force_on_documents(documents):
    assert result(documents) == brute([(r.doc_id, r.text) for r in documents.collect()])


def test_chains_copies_and_short_texts(spark):
    rng = random.Random(1)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    texts = [" ".join(base)]
    step = list(base)
    for i in range(12):  # each near its predecessor, the ends are far apart
        step[5 + 9 * i] = f"x{i}"
        texts.append(" ".join(step))
    texts += [" ".join(base)] * 40 + ["", None, "   \n", "a b c", "A  B\tc", "a b", "ü Ä ü", "ü ä ü"]
    texts += [" ".join(base[:60]), " ".join(base[60:])]
    df = docs_frame(spark, texts)
    assert result(df) == brute(list(enumerate(texts)))


def test_very_long_text_empty_table_and_other_columns(spark):
    long = " ".join(str(i) for i in range(200_000))
    df = docs_frame(spark, [long, long + " end", "x"]).withColumnRenamed("source", "bucket").withColumnRenamed("lang", "component")
    assert result(df) == {0: (199_996, 0, True), 1: (199_997, 0, False), 2: (1, 2, True)}
    assert result(df.limit(0)) == {}


def test_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (1, "p q r s t"), (2, "p q r s t"), (None, "p q r s t")],
                               "doc_id long, text string")
    rows = sorted(tuple(r) for r in minhash.near_duplicates(df).fillna(-1).collect())
    assert rows == [(-1, 1, -1, True), (1, 1, 1, True), (1, 2, 1, True), (1, 2, 1, True), (2, 1, 1, False)]


def test_repeated_ids_in_a_large_bucket(spark):
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(10**7)}"
    base = [word() for _ in range(80)]
    rows = []
    for i in range(40):
        near = list(base)
        for _ in range(rng.randrange(0, 4)):
            near[rng.randrange(len(near))] = word()
        rows.append((i, " ".join(near)))
    rows += [(i, " ".join(word() for _ in range(90))) for i in range(0, 40, 3)]  # a second text under the same doc_id
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = [(i, shingle_set(t)) for i, t in rows]
    root = {i: i for i, _ in rows}
    for _ in rows:  # smallest label over links and equal ids
        for i, x in sets:
            for j, y in sets:
                if 100 * len(x & y) >= 75 * len(x | y):
                    root[i] = root[j] = min(root[i], root[j])
    assert found == root


def test_counts_by_hash_range_bound_what_sets_share(spark):
    rng = random.Random(6)
    base = [f"b{rng.randrange(10**7)}" for _ in range(150)]
    texts = []
    for _ in range(30):
        near = list(base)
        for _ in range(rng.randrange(0, 9)):
            near[rng.randrange(len(near))] = f"m{rng.randrange(10**7)}"
        texts.append(" ".join(near))
    rows = spark.createDataFrame(list(enumerate(t.encode() for t in texts)), "node long, body binary")
    counts = {r.node: r[1:] for r in minhash._shared(rows.select("node"), rows, 5).collect()}
    sets = [shingle_set(t) for t in texts]
    for i, x in enumerate(sets):
        others = frozenset().union(*(y for j, y in enumerate(sets) if j != i))
        assert sum(counts[i]) == len(x & others)
        for j, y in enumerate(sets[:i]):
            assert sum(map(min, counts[i], counts[j])) >= len(x & y)


def test_keep_one_keeps_columns(documents):
    kept = minhash.keep_one(documents)
    assert kept.columns == documents.columns
    expected = {i for i, (_, _, k) in brute([(r.doc_id, r.text) for r in documents.collect()]).items() if k}
    assert {r.doc_id for r in kept.collect()} == expected


def test_band_keys_catch_pairs_at_the_threshold():
    import numpy as np

    rng, found = np.random.default_rng(5), 0
    for _ in range(200):  # similarity exactly 0.75: 600 shared of 800
        v = rng.integers(0, 2**63, 800).astype(np.uint64)
        keys = minhash._bands(minhash._signatures_of([np.sort(v[:700]), np.sort(v[100:])]))
        found += bool((keys[0] == keys[1]).any())
    assert found >= 199


def test_large_buckets_of_a_common_passage(spark, monkeypatch):
    monkeypatch.setattr(minhash, "LARGE", 8)
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(10**7)}"
    passage = [word() for _ in range(60)]
    texts = [" ".join([word() for _ in range(rng.randrange(10, 60))] + passage) for _ in range(120)]
    for i in range(60):  # near copies of one document, some too far from it
        near = list(passage)
        for _ in range(rng.randrange(0, 9)):
            near[rng.randrange(len(near))] = word()
        texts.append(" ".join(near))
    df = docs_frame(spark, texts)
    assert result(df) == brute(list(enumerate(texts)))


def test_packed_counts_bound_like_the_counts(spark):
    rng = random.Random(8)
    rows = [(i, *[rng.choice([0, 1, 7, 300, 65_534, 65_535, 10**6]) for _ in range(minhash.PARTS)]) for i in range(20)]
    counts = spark.createDataFrame(rows, "node long, " + ", ".join(f"p{i} int" for i in range(minhash.PARTS)))
    packed = counts.select("node", *minhash._packed())
    got = packed.alias("x").join(packed.alias("y"), F.expr("x.node < y.node")).select("x.node", "y.node", minhash._common()).collect()
    for a, b, common in got:
        exact = sum(map(min, rows[a][1:], rows[b][1:]))
        assert common >= exact and (common == exact or max(map(min, rows[a][1:], rows[b][1:])) >= minhash.MANY)
