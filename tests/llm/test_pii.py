import hashlib
import random
import re

import numpy as np
from conftest import docs_frame

from starloom.llm import pii


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base(text):
    text, out = text or "", {k: [] for k in pii.KINDS}
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out["email"].append(m.span())
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out["ip"].append(m.span())
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out["card"].append(m.span())
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out["phone"].append(m.span())
    listed = ",".join(f"{k}:{a}:{b}" for k in pii.KINDS for a, b in out[k])
    return tuple(len(out[k]) for k in pii.KINDS), hashlib.sha256(listed.encode()).hexdigest(), listed


def check(rows, texts):
    for r in rows:
        counts, digest, listed = base(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == counts, (r, listed)
        assert r.base_sha256 == digest
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))
        kinds = [(pii.KINDS.index(s.split(":")[0]), int(s.split(":")[1])) for s in r.spans.split(",") if s]
        assert kinds == sorted(kinds) and len(kinds) == sum(counts) + r.n_added


def test_base_matches_brute_force_on_documents(documents):
    check(pii.scan(documents).collect(), {r.doc_id: r.text for r in documents.collect()})


def test_hostile_texts(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("a@.-+()0123 4é\n_%9") for _ in range(rng.randrange(200))) for _ in range(300)]
    texts += ["a@b.c_d@e.f", "a@b.c.d@e.f.", "x@y..z", "1.2.3.4.5.6.7.8", "999.1.1.1", "01.002.0003.4", "4111 1111-1111 1111", "4111  111111111111",
              "+1 (535) 555-5412.", "+12", "\u0001 4111\u00011111\u00011111\u00011111 a@b\u0002c.d", None, "", "😀 a@b.co 😀 +123456789"]
    texts += ["1 " * 20_000, "a." * 20_000 + "@b" + ".c" * 20_000, "9" * 50_000, "1." * 20_000, "a@" * 5_000, "+1" + " " * 30_000]
    df = docs_frame(spark, texts).withColumnRenamed("lang", "row").withColumnRenamed("source", "spans")
    check(pii.scan(df, pii.Model()).collect(), dict(enumerate(texts)))
    clean = {r.doc_id: r for r in pii.redacted(df, pii.Model()).collect()}
    assert pii.redacted(df, pii.Model()).columns == df.columns
    for i, t in enumerate(texts):
        assert (clean[i].text is None) == (t is None)
        if t is not None:
            assert clean[i].n_chars == len(clean[i].text)
    assert clean[300].text == "[EMAIL][EMAIL]" and clean[308].text == "[PHONE]."
    assert pii.scan(df.limit(0)).collect() == []


def test_trees_add_formats_that_miss_the_plus(spark):
    rng = random.Random(5)
    number = lambda: f"({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}"
    texts = [f"call +1 {number()} now" for _ in range(300)]
    texts += [f"order {rng.randrange(10**7, 10**15)} of {rng.randrange(1900, 2030)}-{rng.randrange(10, 13)}-{rng.randrange(10, 29)} v{rng.randrange(9)}.{rng.randrange(99)}.{rng.randrange(9)}" for _ in range(300)]
    extra = [f"call 1 {number()} now" for _ in range(20)]
    df = docs_frame(spark, texts + extra)
    model = pii.train(docs_frame(spark, texts))
    rows = sorted(pii.scan(df, model).collect(), key=lambda r: r.doc_id)
    assert all(r.n_added == 1 and r.spans.startswith("phone:5:") for r in rows[600:])
    assert sum(r.n_added for r in rows[300:600]) == 0
    assert "[PHONE]" in pii.redacted(df, model).filter("doc_id = 605").first().text


def test_boosting_and_threshold():
    x = np.array([[0] * 10, [1] + [0] * 9, [1, 1] + [0] * 8, [0, 1] + [0] * 8])
    model = pii.boost(x, np.full(4, 50.0), np.array([0, 50.0, 0, 50.0]))  # exclusive or
    assert ((model.raw(x) > 0) == [False, True, False, True]).all()
    assert pii.threshold(np.array([3.0, 2.0, 1.0]), np.array([30.0, 30, 30]), np.array([30.0, 30, 3])) == 2.0
    assert pii.threshold(np.array([3.0]), np.array([5.0]), np.array([5.0])) == float("inf")


def test_scan_adds_common_formats_that_miss_the_plus(spark):
    rng = random.Random(7)
    tail = lambda: f"({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}"
    texts = [f"call +1 {tail()} now" for _ in range(200)] + [f"we are at +1 {tail()} today" for _ in range(200)]
    texts += [f"order {rng.randrange(10**8, 10**15)} of {rng.randrange(1900, 2030)}-{rng.randrange(10, 13)}-{rng.randrange(10, 29)}" for _ in range(200)]
    texts += [f"seen 20{rng.randrange(10, 30)}-{rng.randrange(10, 13)}-{rng.randrange(10, 29)} {rng.randrange(10, 24)} and {rng.randrange(10**8, 10**12)}" for _ in range(200)]
    missed = [f"call 1 {tail()} now" for _ in range(100)] + [f"we are at 1 {tail()} today" for _ in range(100)]  # a third of the phones
    missed += [f"call {tail()} now" for _ in range(50)]  # a layout that no signed number has
    rows = sorted(pii.scan(docs_frame(spark, texts + missed)).collect(), key=lambda r: r.doc_id)
    assert [r.n_added for r in rows[:800]] == [0] * 800
    assert [r.n_added for r in rows[800:]] == [1] * 250
    assert "[PHONE]" in pii.redacted(docs_frame(spark, texts + missed)).filter("doc_id = 805").first().text
