import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from starloom.llm import importance
from starloom.llm.grams import Bytes, GramTable

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def features(text):
    w = words(text)
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10000


def brute(docs, target, percent=25, least=20):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(bucket, features(text)))
    for text in target:
        t.update(map(bucket, features(text)))
    s_all, t_all = sum(s.values()), sum(t.values())
    rows = []
    for doc_id, text in docs:
        f = features(text)
        gains = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in map(bucket, f)]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text))])
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    rank = {id(r): i + 1 for i, r in enumerate(able[: percent * len(able) // 100])}
    return sorted((tuple(r[:4]) + (rank.get(id(r)),) for r in rows), key=repr)


def drawn(spark, docs, target, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("rank", F.lit("x")).withColumn("score", F.lit(1)).withColumn(
        "_salt", F.lit(2))
    t = spark.createDataFrame([(x,) for x in target], "text string").withColumn("bucket", F.lit(0))
    out = importance.resample(d, t, **kw).select("doc_id", "n_features", "weight", "score", "rank")
    return sorted(map(tuple, out.collect()), key=repr)


def test_hashes_equal_the_libraries():
    rng = random.Random(3)
    parts = [rng.randbytes(rng.choice([0, 1, 2, 3, 4, 7, 8, 9, 15, 31, 32, 33, 63, 64, 65, 100, 300, 5000])) for _ in range(2000)]
    size = np.array([len(p) for p in parts])
    held = Bytes(np.frombuffer(b"".join(parts), np.uint8))
    at = np.cumsum(size) - size
    assert held.xxhash64(at, size).tolist() == [xxhash.xxh64_intdigest(p) for p in parts]
    assert held.crc32(at, size).tolist() == [zlib.crc32(p) for p in parts]


@pytest.mark.parametrize("keys", [None, 0, 15])
def test_table_keeps_colliding_grams_apart(keys):
    """Equal keys for all n-grams (or keys that wrap round the table) leave only the bytes to tell them apart."""
    rng = random.Random(4)
    parts = [rng.choice("ab") * rng.randrange(1, 20) + rng.choice("ab") for _ in range(300)]
    size = np.array([len(p) for p in parts])
    held = Bytes(np.frombuffer("".join(parts).encode(), np.uint8))
    at = np.cumsum(size) - size
    table = GramTable(held, at, size, None if keys is None else np.full(300, keys, np.uint64))
    by_slot = {}
    for p, s in zip(parts, table.slot.tolist()):
        assert by_slot.setdefault(s, p) == p
    assert len(by_slot) == len(set(parts)) == len(table.used)
    assert {by_slot[s]: table.count[s] for s in by_slot} == dict(Counter(parts))


def test_matches_brute_force_on_documents(spark, documents):
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = importance.resample(documents, bench).select("doc_id", "n_features", "weight", "score", "rank")
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, [r.text for r in bench.collect()])


def test_nulls_ties_repeats_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(importance, "BLOCK_WORDS", 64)
    rng = random.Random(5)
    vocabulary = ["Alpha", "beta", "gam-ma", "été", "x1", "Ω", "a" * 90, "the"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    docs = [(i, text(rng.choice([5, 19, 20, 21, 60, 300]))) for i in range(60)]
    docs += [(None, text(30)), (None, text(30)), (None, None), (100, None), (101, ""), (102, "!!! ..."), (103, "word"), (104, text(5000))]
    docs += [(105, docs[0][1] + " " + text(30))] * 9 + [(106, text(25)), (106, text(40))]
    target = [text(40), None, "", "beta the", text(300)]
    for percent in (25, 100, 0):
        assert drawn(spark, docs, target, percent=percent) == brute(docs, target, percent)
    assert drawn(spark, docs, []) == brute(docs, [])
    assert drawn(spark, [], target) == []
    assert drawn(spark, [(1, "few words")], target) == brute([(1, "few words")], target)


def test_equal_rows_of_a_third_are_ranked_each(spark):
    docs = [(i, f"w{i % 7} " * 25) for i in range(2000)] + [(None, "same text " * 12)] * 1000
    got = drawn(spark, docs, ["same text " * 50], percent=60)
    assert got == brute(docs, ["same text " * 50], 60)
    assert sorted(r[4] for r in got if r[4]) == list(range(1, 60 * 3000 // 100 + 1))


def test_texts_like_the_target_are_drawn(spark):
    rng = random.Random(6)
    ours, theirs = [f"o{i}" for i in range(200)], [f"t{i}" for i in range(200)]
    docs = [(i, " ".join(rng.choice(theirs if i % 4 == 0 else ours) for _ in range(120))) for i in range(400)]
    got = drawn(spark, docs, [" ".join(rng.choice(theirs) for _ in range(3000))])
    share = [r[0] % 4 == 0 for r in got if r[4]]
    assert len(share) == 100 and sum(share) >= 50  # twice their part of the documents, and noise decides the rest
