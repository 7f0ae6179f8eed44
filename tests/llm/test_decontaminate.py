import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import decontaminate
from starloom.llm.grams import Bytes

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def brute(docs, items, window=10):
    tests = []
    for item, text in items:
        w = words(text)
        k = min(len(w), window)
        tests += [("" if item is None else str(item), w[i: i + k]) for i in range(len(w) - k + 1) if k]
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item, test in tests:
            for i in range(len(w) - len(test) + 1):
                if w[i: i + len(test)] == test:
                    hit.update(range(i, i + len(test)))
                    found.add(item)
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


def scanned(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("items", F.lit("x")).withColumn("body", F.lit(1))
    t = spark.createDataFrame(items, "item_id long, text string").withColumn("item", F.lit("x")).withColumn("w", F.lit(1))
    out = decontaminate.scan(d, t, **kw)
    return out.select("doc_id", "n_words", "n_hit", "n_items", decontaminate.items_digest().alias("d"), "contaminated"), out


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def random_case(seed, n_docs=40, n_items=25, vocabulary=6):
    rng = random.Random(seed)
    vocabulary = [rng.choice("abé9") * rng.randrange(1, 9) for _ in range(vocabulary)]
    text = lambda n: rng.choice([" ", ", ", "\n-"]).join(rng.choice(vocabulary).title() for _ in range(n))
    docs = [(i, text(rng.choice([0, 1, 5, 9, 10, 11, 60, 200]))) for i in range(n_docs)]
    items = [(i, text(rng.choice([0, 1, 2, 5, 9, 10, 11, 14]))) for i in range(n_items)]
    for doc in range(0, n_docs, 3):  # planted passages
        _, test = rng.choice(items)
        docs[doc] = (doc, docs[doc][1] + " ... " + test + ". " + text(3))
    return docs, items


@pytest.mark.parametrize("seed", range(4))
def test_matches_brute_force(spark, seed):
    docs, items = random_case(seed, vocabulary=4 if seed % 2 else 30)
    assert rows(scanned(spark, docs, items)[0]) == brute(docs, items)


def test_parts_and_sections_change_nothing(spark, monkeypatch):
    docs, items = random_case(9, vocabulary=5)
    items.append((99, " ".join(docs[0][1].split()[:5] + [w for _, t in docs[:20] for w in t.split()])))
    want = brute(docs, items)
    monkeypatch.setattr(decontaminate, "SECTION", 7)
    assert rows(scanned(spark, docs, items)[0]) == want
    assert rows(scanned(spark, docs, items, part_bytes=900)[0]) == want


def test_matches_brute_force_on_documents(spark, documents):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs, items = [(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in bench.collect()]
    got = decontaminate.scan(documents, bench).select(
        "doc_id", "n_words", "n_hit", "n_items", decontaminate.items_digest().alias("d"), "contaminated")
    assert rows(got) == brute(docs, items)


def test_nulls_empties_repeats_and_long_texts(spark):
    ten = "one two three four five six seven eight nine ten"
    docs = [(1, None), (2, ""), (None, ten.upper()), (3, ten), (3, ten), (4, ten.replace(" two", "two")), (5, "x " * 200_000 + ten + " y" * 50_000),
            (6, "one two three four five"), (7, "six seven eight nine ten"), (8, ten + "!" + ten), (9, "b"), (10, "ab b-b abb"), (11, "," * 3000)]
    items = [(7, ten + " eleven"), (None, ten), (7, ten), (8, "B"), (8, "b"), (9, None), (10, ""), (11, "?!"), (12, "z" * 2000 + " y"), (13, "three FOUR")]
    docs.append((12, "q " + "z" * 2000 + " y"))
    assert rows(scanned(spark, docs, items)[0]) == brute(docs, items)
    assert rows(scanned(spark, docs, [])[0]) == brute(docs, [])
    assert rows(scanned(spark, [], items)[0]) == []


def test_real_outputs(spark):
    ten = "one two three four five six seven eight nine ten"
    _, out = scanned(spark, [(1, f"a {ten} b c {ten} {ten}")], [(5, ten), (40, "b c")])
    r = out.first()
    assert r["items"] == ["40", "5"] and [tuple(h) for h in r["hits"]] == [(1, 33)]


def test_shift_table_skips():
    """On text that shares no block with the test strings, cursors move by nearly the shortest string's length."""
    test = (" " + " ".join(f"qz{i}" for i in range(10)) + " ").encode()
    held = Bytes(np.frombuffer(test, np.uint8))
    strings = decontaminate.PatternSet(held, np.array([0]), np.array([len(test)]), 10)
    assert strings.shift.max() == len(test) - strings.block + 1
    assert (strings.shift < strings.shift.max()).mean() < 0.1
    text = Bytes(np.frombuffer(b" lorem ipsum dolor" * 1000 + test + b"lorem " * 10, np.uint8))
    assert 18000 in strings.stops(text) and len(strings.stops(text)) < 10


def test_many_items_share_a_window(spark):
    ten = "choose the correct answer from the options that are given"
    items = [(i, ten + f" end{i}") for i in range(3000)]
    docs = [(i, "intro " + ten + f" end{i}") for i in range(50)] + [(99, "nothing here")]
    got = {r[0]: r for r in scanned(spark, docs, items)[0].collect()}
    assert all(got[i][3] == 3000 and got[i][2] == 11 for i in range(50)) and got[99][2] == 0
