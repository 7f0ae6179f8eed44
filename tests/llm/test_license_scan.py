import re

import numpy as np
import pyarrow as pa
from conftest import docs_frame

from starloom.llm import license_scan


def base_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def base(text):
    words = base_words(text)
    places = sorted((i, label) for p, label in license_scan.PHRASES.items() for i in range(len(words))
                    if words[i:i + len(p.split())] == p.split())
    return (len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None,
            ",".join(sorted({lab for _, lab in places})))


def rows_of(df):
    return sorted(license_scan.scan(df).collect(), key=lambda r: r.doc_id)


def test_base_matches_brute_force_on_documents(documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in rows_of(documents):
        assert tuple(r)[1:6] == base(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1


def test_only_grams_of_templates_leave_the_task():
    texts = [b"", b"The MIT License and the MIT License", b"license mit of the", b"plain words " * 5_000, b"gnu", b"general public license"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.binary())], names=["doc", "body"])
    known = np.unique([r[0] for r in license_scan.template_grams({"mit license": "mit", "gnu general public license": "gpl"}, {})])
    rows = [r for part in license_scan._rolled(known)(iter([batch])) for r in part.to_pylist()]
    assert {r["doc"]: r["gram"] for r in rows if r["pos"] < 0} == {i: len(base_words(t.decode())) for i, t in enumerate(texts)}
    found = sorted((r["doc"], r["pos"]) for r in rows if r["pos"] >= 0)
    assert found == [(1, 1), (1, 5), (5, 0), (5, 1)]  # none across texts, none of the ten thousand other places
    assert all(r["pos"] < 0 for part in license_scan._rolled(known[:0])(iter([batch])) for r in part.to_pylist())


def test_edges(spark):
    texts = [None, "", "MIT License", "mit-license; MIT\nLicense. permit license", "CC BY-NC cc by cc by", "apache", "é mit license é",
             "x " * 30_000 + "gnu general public license mit license", "gnu general public"]
    df = docs_frame(spark, texts).withColumnRenamed("lang", "doc").withColumnRenamed("source", "template")
    assert [tuple(r)[1:6] for r in rows_of(df)] == [base(t) for t in texts]
    assert license_scan.scan(df.limit(0)).count() == 0
    assert license_scan.scan(df.unionByName(df)).count() == 2 * len(texts)


def test_passages_with_insertions_and_gaps(spark):
    mit = license_scan.PASSAGES["mit"].split()
    broken = mit[:15] + ["really", "truly"] + mit[15:28] + mit[30:]
    texts = ["Intro. " + " ".join(mit).title() + ". end", " ".join(broken), " ".join(mit[:12]), "of the of the software"]
    out = rows_of(docs_frame(spark, texts))
    assert [r.labels for r in out] == ["mit", "mit", "", ""]
    assert [r.base_labels for r in out] == ["", "", "", ""]
    assert out[0].score == 1.0 and 0.6 <= out[1].score < 1 and 0 < out[2].score < 0.6 and out[3].score == 0
