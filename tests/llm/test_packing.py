import random
import re
from collections import defaultdict

import pytest
from conftest import docs_frame

from starloom.llm import packing


def plain_best_fit(pieces, capacity):
    bins, out = [], []
    for n, s, c in pieces:
        fits = [(capacity - b["used"], i) for i, b in enumerate(bins)
                if capacity - b["used"] >= n and s not in b["s"] and (c is None or c not in b["c"])]
        i = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append({"used": 0, "s": set(), "c": set()})
        out.append((i, bins[i]["used"]))
        bins[i]["used"] += n
        bins[i]["s"].add(s)
        bins[i]["c"].add(c)
    return out


def test_tightest_compatible_bin():
    rng = random.Random(7)
    for _ in range(30):
        pieces = sorted(((rng.randrange(1, 60), rng.randrange(6), rng.choice([None, 1, 2, 3])) for _ in range(80)), key=lambda p: -p[0])
        assert packing.best_fit(pieces, 60) == plain_best_fit(pieces, 60)


def valid(rows, docs, capacity):
    bins, words = defaultdict(list), defaultdict(int)
    for r in rows:
        words[r.doc_id] += r.n_words
        if r.bin_id is not None:
            bins[r.bin_id].append(r)
    for held in bins.values():
        spans = sorted((r.bin_offset, r.bin_offset + r.n_words) for r in held)
        assert spans[0][0] == 0 and spans[-1][1] <= capacity and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
        assert len({r.source for r in held}) == len(held)
    return words


def test_documents_are_packed_whole(documents):
    data = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in documents.collect()}
    rows = packing.pack(documents, capacity=512, shard_rows=64).collect()
    assert valid(rows, documents, 512) == data
    assert sorted(map(str, rows)) == sorted(map(str, packing.pack(documents, capacity=512, shard_rows=64).collect()))


def test_copies_conflict_and_edges(spark):
    texts = ["same text here"] * 9 + ["SAME text here ", None, "", "w " * 1000]
    df = docs_frame(spark, texts).withColumn("shard", __import__("pyspark").sql.functions.lit(1))
    rows = packing.pack(df, capacity=64).collect()
    copies = [r.bin_id for r in rows if r.doc_id < 10]
    assert len(copies) == len(set(copies)) == 10
    assert valid(rows, df, 64)[12] == 1000
    assert [(r.piece, r.bin_id) for r in rows if r.doc_id in (10, 11)] == [(None, None)] * 2
    assert packing.pack(df.limit(0)).collect() == []
    nulls = spark.createDataFrame([(None, "a b", None), (None, "a b", None)], "doc_id long, text string, source string")
    assert len({r.bin_id for r in packing.pack(nulls).collect()}) == 2
    with pytest.raises(ValueError):
        packing.pack(df, capacity=0)


def test_many_equal_rows_are_dealt_over_all_shards(spark):
    rows = spark.range(20000).selectExpr("cast(null as long) doc_id", "'a b c' text", "'s' source").unionByName(
        spark.range(2000).selectExpr("id doc_id", "concat('w ', id) text", "concat('s', id % 7) source"))
    out = packing.pack(rows, shard_rows=4096).collect()
    assert len(out) == 22000
    held = {}
    for r in out:
        held[r.bin_id >> 32] = held.get(r.bin_id >> 32, 0) + 1
    assert len(held) == 6 and max(held.values()) < 2 * 22000 / 6
    copies = [r.bin_id for r in out if r.doc_id is None]
    assert len(set(copies)) == 20000
    again = packing.pack(rows.repartition(5), shard_rows=4096).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
