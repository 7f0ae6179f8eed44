import re
from collections import defaultdict

import numpy as np
from conftest import docs_frame

from starloom.llm import mixing


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(totals):
    names = sorted((n for n in totals if n is not None)) + [None] * (None in totals)
    weight = {n: (3, 1, 2)[i % 3] for i, n in enumerate(names)}
    left, open_names, out = 1.5 * sum(totals.values()), set(names), {}
    while open_names:
        w = sum(weight[n] for n in open_names)
        over = {n for n in open_names if left * weight[n] / w > 2 * totals[n] + 1e-9}
        if not over:
            out.update({n: left * weight[n] / w for n in open_names})
            break
        for n in over:
            out[n] = 2.0 * totals[n]
        left -= sum(out[n] for n in over)
        open_names -= over
    return out


def check(df, texts_and_sources, near=1.0):
    rows = mixing.mix(df).collect()
    totals = defaultdict(int)
    for t, s in texts_and_sources:
        totals[s] += size(t)
    want = targets(totals)
    taken = defaultdict(int)
    for r in rows:
        assert r.source_size == totals[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, r.target)
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
    for s, t in taken.items():
        assert abs(t - want[s]) <= near, (s, t, want[s])
    return rows


def test_targets_and_fit_on_documents(documents):
    data = [(r.text, r.source) for r in documents.collect()]
    rows = check(documents, data, near=150)  # few long documents in a source: the nearest reachable sum
    again = mixing.mix(documents).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_many_short_documents_meet_the_budget(spark):
    texts = ["w " * (1 + i % 17) for i in range(12_000)]
    df = docs_frame(spark, texts)
    check(df, [(t, f"src{i % 3}") for i, t in enumerate(texts)])


def test_edges(spark):
    rows = [(1, "a b c", None), (2, None, "s"), (3, "", "s"), (4, "x", "t"), (4, "x", "t"), (None, "p q", "é"), (6, "w " * 50_000, "t")]
    df = spark.createDataFrame([(*r, 7, "z") for r in rows], "doc_id long, text string, source string, size int, target string")
    out = check(df, [r[1:3] for r in rows], near=50_000)
    assert len(out) == len(rows)
    assert mixing.mix(df.limit(0)).collect() == []
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns
    copies = defaultdict(int)
    for r in out:
        copies[r.doc_id] += r.copies * (r.size > 0)
    got = defaultdict(int)
    for r in mixed.collect():
        got[r.doc_id] += 1
    assert got == {k: v for k, v in copies.items() if v}


def test_fit_budget_is_largest_within_by_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(60):
        lengths = np.sort(rng.choice(np.arange(1, 40), rng.integers(1, 6), replace=False))
        counts = rng.integers(1, 4, len(lengths))
        budget = float(rng.uniform(0, (lengths * counts).sum()))
        take = mixing.fit_budget(lengths, counts, budget)
        assert (take <= counts).all() and (take >= 0).all()
        start = np.floor(counts * budget / (lengths * counts).sum()).astype(int)
        sums = {int((start * lengths).sum())}
        for n, left in zip(lengths, counts - start):
            sums = {s + int(n) * k for s in sums for k in range(left + 1)}
        got = int((take * lengths).sum())
        goal = int(start @ lengths) + round(budget - float(start @ lengths))
        assert got == max(s for s in sums if s <= goal)


def test_budgets_above_the_limit_with_one_dominating_document():
    def words(lengths, counts, budget, **kw):
        lengths, counts = np.array(lengths), np.array(counts)
        take = mixing.fit_budget(lengths, counts, float(budget), **kw)
        assert (take >= 0).all() and (take <= counts).all()
        return int(take @ lengths)

    assert words([10, 2_000_000], [1_000_000, 1], 6_000_000) == 6_000_000  # short documents in bulk
    assert words([10, 900_000], [10, 1], 900_050) == 900_050               # shares handed back for the long one
    assert words([10, 900_000], [10, 1], 890_000) == 100                   # nothing else is within the budget
    assert words([7, 400_000, 900_000], [3, 2, 1], 1_300_000) == 1_300_000
    assert words([200_000, 300_000], [2, 1], 450_000) == 400_000           # not 300,000, the longest first
    assert words([10, 30_000], [10, 1], 30_050, limit=16, widest=64) == 30_050  # longer than the widest window
    rng = np.random.default_rng(6)
    for _ in range(40):  # the same as brute force when all is above the limit
        lengths = np.sort(rng.choice(np.arange(300, 4000), rng.integers(1, 5), replace=False))
        counts = rng.integers(1, 4, len(lengths))
        budget = int(rng.integers(1, (lengths * counts).sum()))
        sums = {0}
        for n, c in zip(lengths, counts):
            sums = {s + int(n) * k for s in sums for k in range(c + 1)}
        best = max(s for s in sums if s <= budget)
        assert best - words(lengths, counts, budget, limit=16) <= max(0, mixing.KEEP_WORDS - (budget - best))


def test_tied_rows_share_what_is_taken(spark):
    """A third of the rows is one document, of a length that is taken in part; its rows differ in lang only."""
    rows = [(i, f"t{i} x y", f"l{i % 2}", "a") for i in range(400)] + [(999, "same same same", f"l{i % 3}", "a") for i in range(200)]
    rows += [(1000 + i, "w " * 50, "l", "b") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    copies = defaultdict(int)
    for r in mixing.mix(df).collect():
        copies[r.doc_id] += r.copies * (r.size > 0)
    got = defaultdict(int)
    per_row = defaultdict(int)
    for r in mixing.mixed_documents(df).collect():
        got[r.doc_id] += 1
        per_row[r] += 1
    assert got == {k: v for k, v in copies.items() if v}
    held = defaultdict(int)
    for r in df.collect():
        held[r] += 1
    assert all(n <= 2 * held[r] for r, n in per_row.items())


def test_no_text_is_shuffled(spark, documents):
    plan = mixing.mixed_documents(documents)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "row#" in line]
    assert len(moved) <= 2  # partial counts of tied rows, and their window
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
