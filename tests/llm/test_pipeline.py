import os
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline
from conftest import SMALL
from test_minhash import brute as groups
from test_packing import valid
from test_pii import base as personal

from starloom.llm import mixing, quality
from starloom.llm.common import staged


def test_stages_take_effect(spark, documents):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_dedup", "pii", "mixing", "packing"]
    out, docs = {}, documents
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SMALL), name)
        out[name] = docs.collect()
        if name != "packing":
            assert docs.columns == documents.columns
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    good = {r.doc_id for r in quality.scored(documents, labels).filter("predicted = 1").collect()}
    assert {r.doc_id for r in out["quality"]} == good
    kept = {i for i, (_, _, k) in groups([(r.doc_id, r.text) for r in out["quality"]]).items() if k}
    assert {r.doc_id for r in out["near_dedup"]} == kept and len(out["near_dedup"]) == len(kept)
    before = {r.doc_id: r.text for r in out["near_dedup"]}
    for r in out["pii"]:
        if sum(personal(before[r.doc_id])[0]):
            assert r.text != before[r.doc_id] and sum(personal(r.text)[0]) == 0 and r.n_chars == len(r.text)
        else:
            assert r.text == before[r.doc_id]
    redacted = spark.createDataFrame(out["pii"], documents.schema)
    copies = {r.doc_id: r.copies for r in mixing.mix(redacted).collect() if r.copies and r.size}
    assert Counter(r.doc_id for r in out["mixing"]) == copies
    words = valid(out["packing"], None, 2048)
    assert words == Counter({i: c * mixing_size(redacted, i) for i, c in copies.items()})


def mixing_size(df, doc_id, cache={}):  # noqa: B006
    if not cache:
        cache.update({r.doc_id: r.size for r in mixing.mix(df).collect()})
    return cache[doc_id]


def test_run_equals_the_stages(spark):
    assert corpus_pipeline.run(spark, SMALL).count() > 0


def through(spark, docs, sf_dir):
    """What every stage returns, staged."""
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = staged(stage(spark, docs, sf_dir), name)
    return out


def test_empty_table_through_all_stages(spark, documents):
    out = through(spark, documents.limit(0), SMALL)
    assert all(df.count() == 0 for df in out.values())
    assert all(out[n].columns == documents.columns for n in list(out)[:-1])


def test_nulls_repeats_and_further_columns(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")  # one class: nothing is rejected
    long = "many different words " + " ".join(f"w{i}" for i in range(5000))
    rows = [(1, "write to me@site.org about the first of these texts", "en", "a"), (2, None, None, None), (3, "", "en", "a"),
            (4, "short", None, "b"), (4, "short", None, "b"), (5, long, "en", None), (6, long + " end", "en", "a"), (None, "a row without an id here", "en", "a")]
    docs = spark.createDataFrame([(*r, len(r[1] or ""), 1.0, "x") for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars int, score double, bucket string")
    out = through(spark, docs, str(tmp_path))
    assert all(out[n].columns == docs.columns for n in list(out)[:-1])
    assert out["quality"].count() == len(rows)
    kept = Counter(r.doc_id for r in out["near_dedup"].collect())
    assert kept == Counter([1, 2, 3, 4, 5, None])  # 6 is a near copy of 5, and one of the rows 4 stays
    texts = {r.doc_id: r.text for r in out["pii"].collect()}
    assert texts[1] == "write to [EMAIL] about the first of these texts" and texts[2] is None and texts[5] == long
    mixed = {r.doc_id for r in out["mixing"].collect()}
    assert mixed <= set(texts) - {2, 3}
    packed = out["packing"].collect()
    assert {r.doc_id for r in packed} == mixed and all(r.bin_id is not None for r in packed)


def test_run_returns_what_the_stages_return(spark, documents):
    stages = through(spark, documents, SMALL)["packing"].collect()
    assert sorted(map(str, corpus_pipeline.run(spark, SMALL).collect())) == sorted(map(str, stages))
