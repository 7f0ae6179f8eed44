import hashlib
import random

from conftest import docs_frame

from starloom.llm import suffix_dedup
from starloom.llm.queries import QUERIES


def brute(texts, window):
    places = {}
    blobs = [(t or "").encode() for t in texts]
    for b in blobs:
        for s in range(len(b) - window + 1):
            places[b[s:s + window]] = places.get(b[s:s + window], 0) + 1
    out = []
    for b in blobs:
        gone = bytearray(len(b))
        for s in range(len(b) - window + 1):
            if places[b[s:s + window]] > 1:
                gone[s:s + window] = b"\x01" * window
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def result(df, **kw):
    rows = suffix_dedup.remove_repeats(df, **kw).drop("kept").collect()
    return [tuple(r)[1:] for r in sorted(rows, key=lambda r: r.doc_id)]


def test_matches_brute_force_on_documents(documents):
    rows = sorted((r.doc_id, r.text) for r in documents.collect())
    assert result(documents) == brute([t for _, t in rows], 400)


def test_small_windows_overlaps_periods_and_multibyte(spark):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abé ") for _ in range(n))
    shared = [word(60), word(45), word(39)]
    texts = ["", None, "x" * 100, "ab" * 70, "short", word(300)]
    for _ in range(60):
        texts.append(word(rng.randrange(50)) + rng.choice(shared)[rng.randrange(8):] + word(rng.randrange(30)) + rng.choice(shared) + word(9))
    texts += [texts[-1], texts[-1] + "!", texts[5] + texts[5]]
    df = docs_frame(spark, texts).withColumnRenamed("lang", "doc").withColumnRenamed("source", "start")
    assert result(df, window=40, gram=6, cuts=(8, 3, 1)) == brute(texts, 40)


def test_long_text_in_segments(spark):
    rng = random.Random(4)
    long = "".join(rng.choice("abcdefgh") for _ in range(suffix_dedup.SEGMENT * 2 + 777))
    part = long[suffix_dedup.SEGMENT - 500: suffix_dedup.SEGMENT + 900]
    (n, gone, spans, sha), second = result(docs_frame(spark, [long, "-" * 10 + part + "+" * 10]))
    assert (n, gone, spans) == (len(long), 1400, 1)
    assert sha == hashlib.sha256(long.replace(part, "").encode()).hexdigest()
    assert second[:3] == (1420, 1400, 1)


def test_empty_table_and_repeated_rows(spark):
    df = docs_frame(spark, ["y" * 399, "q" * 10 + "z" * 400])
    assert result(df.limit(0)) == []
    twice = df.unionByName(df)
    assert [r[1] for r in result(twice)] == [0, 0, 410, 410]
    none = spark.createDataFrame([(None, "k" * 100 + "m" * 350), (5, None)], "doc_id long, text string")
    assert {(r.doc_id, r.n_removed) for r in suffix_dedup.remove_repeats(none).collect()} == {(None, 0), (5, 0)}


def test_many_equal_rows_and_a_passage_in_half_of_the_rows(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_ROWS", 100)
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    copy, passage = word(700), word(450)
    texts = [word(30) + passage + word(50) if i % 2 else word(500) for i in range(600)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, copy)] * 20000
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    spans = suffix_dedup.repeated_spans(df).selectExpr("max(size(spans)) as most").first()
    assert spans.most < 1000  # equal rows share a list
    out = suffix_dedup.remove_repeats(df).drop("kept").collect()
    assert [tuple(r)[1:] for r in sorted((r for r in out if r.doc_id is not None), key=lambda r: r.doc_id)] == brute(texts, 400)
    assert {tuple(r)[1:4] for r in out if r.doc_id is None} == {(700, 700, 1)}
    assert len(out) == len(rows)


def test_hot_groups_are_found_whole(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_ROWS", 10)
    rows = suffix_dedup.staged(spark.range(5000).selectExpr(
        "id as doc", "id * 7 as start", "if(id % 3 = 0, 1, id) as bucket", "id as other"), "test-rows")
    groups = rows.groupBy("bucket").count().withColumnRenamed("count", "n").filter("n > 1")
    found = suffix_dedup._in_groups(rows, groups, ["bucket"])
    assert found.columns == rows.columns
    assert sorted(r.doc for r in found.collect()) == [i for i in range(5000) if i % 3 == 0 or i == 1]


def test_planted_passages_of_over_fifty_words(spark, tmp_path):
    rng = random.Random(6)
    words = lambda n: " ".join("".join(rng.choice("abcdefghé") for _ in range(5)) for _ in range(n))
    passages = {}
    for size in (399, 400, 401, 900):  # bytes; all have over 50 words
        text = words(51)
        while len(text.encode()) < size - 12:
            text += " " + words(1)
        passages[size] = text + " " + "z" * (size - len(text.encode()) - 1)
        assert len(passages[size].encode()) == size and len(passages[size].split()) > 50
    texts = [words(rng.randrange(1, 200)) for _ in range(20)]
    kept, removed = list(texts), [0] * len(texts)
    for size, passage in passages.items():  # at the start, inside, at the end; other neighbours in each
        for before, after in (("", "A" + words(60)), (words(70) + "B", "C" + words(60)), (words(70) + "D", "")):
            texts.append(before + passage + after)
            kept.append(before + after if size >= 400 else texts[-1])
            removed.append(size if size >= 400 else 0)
    docs_frame(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    rows = sorted(QUERIES["op1_suffix_dedup"](spark, str(tmp_path)).collect(), key=lambda r: r.doc_id)
    assert [r.n_bytes for r in rows] == [len(t.encode()) for t in texts]  # before cutting
    assert [r.n_removed for r in rows] == removed
    assert [bytes(r.kept).decode() for r in rows] == kept
    assert [tuple(r)[1:5] for r in rows] == brute(texts, 400)
