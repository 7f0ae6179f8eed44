"""Mixing sources to target weights by subset-sum budget fitting.

Targets: sources in code-point order (null last) weigh 3, 1, 2, repeating, and
share ``share`` (1.5) of all words; a target stops at ``most`` (2) times its
source's size and the excess is shared again by weight until none is above.
That fixed point is ``min(cap, level * weight)`` with one common level, found
by a running sum over the sources ordered by cap / weight.

Selection, for each source: whole passes over the source first, then documents
for the rest of the budget. Documents are counted by exact length; every
length gives its proportional share (rounded down), the largest remainders,
then documents in bulk, longest first, fill up until at most ``DP_WORDS`` are
open, and a bounded-knapsack dynamic programme over the lengths still on hand
closes the rest with the largest sum within the budget. Where that leaves words
open, it runs again over the whole rest, up to ``WIDEST_WORDS``; where shares
leave more than ``KEEP_WORDS`` open because the documents on hand are too long,
short documents are handed back and chosen anew with them. Only (source, length,
count) rows reach these steps; they are bounded by the number of distinct lengths.

Which documents of a length are taken is settled by a seeded hash of doc_id
and text: large length groups are cut into hash ranges of about ``RANGE_ROWS``
rows, whose quotas follow from running counts, so no window holds more than
one range.

Defined cases: a null or blank text has size 0 and takes 0; no document is
taken more than twice; an empty table gives no rows; rows that repeat are
separate documents; a null source is a source of its own, last in order.
Columns other than doc_id, text and source are ignored by ``mix`` and kept by
``mixed_documents``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.llm.common import staged
from starloom.plans.sizing import bounded_broadcast

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
DP_WORDS = 1 << 15
WIDEST_WORDS = 1 << 24
KEEP_WORDS = 256
RANGE_ROWS = 4096
SEED = 20240601


def n_words(col: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(col), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``source, source_size, target`` from rows with ``source`` and ``size``."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
    rows = totals.withColumn("weight", cycle).withColumn("cap", F.col("source_size").cast("double") * most)
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier, whole = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    rows = rows.select("source", "source_size", "weight", "cap",
                       F.coalesce(F.sum("cap").over(earlier), F.lit(0.0)).alias("full"),
                       F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)).alias("used"),
                       F.sum("weight").over(whole).alias("all_weight"),
                       (F.sum("source_size").over(whole) * share).alias("budget"))
    level = (F.col("budget") - F.col("full")) / (F.col("all_weight") - F.col("used"))
    rows = rows.withColumn("level", F.when(level * F.col("weight") <= F.col("cap"), level))
    # the first source in ratio order that stays under its cap sets the level; later ones give no smaller one
    rows = rows.withColumn("level", F.first("level", ignorenulls=True).over(
        by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return rows.select("source", "source_size", F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"))


def largest_sum(lengths: np.ndarray, left: np.ndarray, goal: int) -> np.ndarray:
    """How many documents of each length give the largest sum up to ``goal``, exactly."""
    take = np.zeros(len(lengths), np.int64)
    reach = np.zeros(goal + 1, bool)
    by = np.full(goal + 1, -1, np.int32)  # the step that reached a sum first
    reach[0], top, steps = True, 0, []
    for i in np.argsort(lengths, kind="stable"):
        size, rest = int(lengths[i]), int(left[i])
        part = 1
        while 0 < size <= goal and rest > 0 and part * size <= goal and not reach[goal]:
            part = min(part, rest)
            words = part * size
            end = min(top, goal - words) + 1
            new = np.flatnonzero(reach[:end] & ~reach[words: words + end]) + words
            reach[new], by[new] = True, len(steps)
            top = max(top, int(new[-1]) if len(new) else 0)
            steps.append((i, part, words))
            rest -= part
            part *= 2
    at = top
    while at:
        i, part, words = steps[by[at]]
        take[i] += part
        at -= words
    return take


def _fill(lengths: np.ndarray, left: np.ndarray, order: np.ndarray, goal: int, window: int) -> np.ndarray:
    """Documents for ``goal`` words: one of each length in ``order``, then in bulk, the last ``window`` words exactly."""
    take, rest = np.zeros(len(lengths), np.int64), goal
    for i in order:
        if rest <= window:
            break
        if left[i] > 0 and 0 < lengths[i] <= rest:
            take[i] += 1
            rest -= int(lengths[i])
    for i in np.argsort(-lengths, kind="stable"):
        if rest <= window:
            break
        if lengths[i] > 0:
            size = int(lengths[i])
            n = min(int(left[i] - take[i]), rest // size, -((window - rest) // size))
            take[i] += n
            rest -= n * size
    # above the window, no document on hand is as short as the rest
    return take + largest_sum(lengths, left - take, rest) if rest <= window else take


def _handed_back(lengths: np.ndarray, take: np.ndarray, space: int, enough: bool = False) -> np.ndarray:
    """Documents of ``take``, shortest first, of at most ``space`` words, or of at least so many if ``enough``."""
    back = np.zeros(len(lengths), np.int64)
    for i in np.argsort(lengths, kind="stable"):
        if lengths[i] > 0 and space > 0:
            size = int(lengths[i])
            back[i] = min(int(take[i]), -(-space // size) if enough else space // size)
            space -= int(back[i]) * size
    return back


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: float, limit: int = DP_WORDS, widest: int = WIDEST_WORDS) -> np.ndarray:
    """How many documents of each length to take: the largest sum within ``budget``, rounded."""
    total = int((lengths * counts).sum())
    if total == 0 or budget <= 0:
        return np.zeros(len(lengths), np.int64)
    share = np.minimum(counts * min(1.0, budget / total), counts)
    take = np.floor(share).astype(np.int64)
    goal = int(round(budget - float((take * lengths).sum())))
    order = np.lexsort((lengths, -(share - take)))  # largest remainder first
    words = lambda n: int((n * lengths).sum())
    more = _fill(lengths, counts - take, order, goal, limit)
    on_hand = np.unique(lengths[(counts > take) & (lengths > 0)])
    step = int(np.gcd.reduce(on_hand)) if len(on_hand) else 1
    most = min(goal - goal % step, words(counts - take))  # no choice gives more
    if words(more) < most and goal > limit:
        more = max(more, _fill(lengths, counts - take, order, goal, widest), key=words)
    take, gap = take + more, goal - words(more)
    # shares that leave more than KEEP_WORDS open give way: short documents are handed back for longer ones
    while gap > widest:
        above = [i for i in np.flatnonzero((counts > take) & (lengths > gap)) if lengths[i] <= gap + words(take)]
        if not above:
            break
        i = min(above, key=lambda i: lengths[i])
        back = _handed_back(lengths, take, int(lengths[i]) - gap, enough=True)
        left = gap + words(back) - int(lengths[i])
        if left >= gap:
            break
        take = take - back
        take[i] += 1
        more = _fill(lengths, counts - take, order, left, widest)
        take, gap = take + more, left - words(more)
    above = lengths[(counts > take) & (lengths > gap)]
    for window in (min(widest, int(above.min()) + limit), widest) if len(above) else ():
        if KEEP_WORDS < gap <= window:
            back = _handed_back(lengths, take, window - gap)
            again = largest_sum(lengths, counts - take + back, gap + words(back))
            take, gap = take - back + again, gap + words(back) - words(again)
    return take


def _fit(limit: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        target, size = float(rows["target"].iloc[0]), int(rows["source_size"].iloc[0])
        passes = min(MOST, int(target // size)) if size else 0
        lengths, counts = rows["size"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
        extra = fit_budget(lengths, counts, target - passes * size, limit) if passes < MOST else np.zeros(len(rows), np.int64)
        return pd.DataFrame({"source_id": rows["source_id"], "size": lengths, "n": counts, "passes": passes, "extra": extra})

    return run


def _source_id() -> Column:
    return F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull())


def _draw(seed: int) -> Column:
    return F.xxhash64("doc_id", "text", F.lit(seed))


def _range() -> Column:
    """The hash range of a row of a length group of ``n`` documents."""
    span = 1 << 20
    ranges = F.greatest(F.lit(1), F.ceil(F.col("n") / RANGE_ROWS))
    return F.floor(F.pmod(F.col("draw"), F.lit(span)) * ranges / span)


def _decided(docs: DataFrame, seed: int, limit: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(rows, targets, lengths)``: what is taken of every document, of its source, and of every length of a source."""
    sizes = staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", n_words().alias("size"), _draw(seed).alias("draw")), "sizes")
    targets = staged(source_targets(sizes).withColumn("source_id", _source_id()), "targets")
    sized = sizes.withColumn("source_id", _source_id())
    histogram = sized.groupBy("source_id", "size").agg(F.count(F.lit(1)).alias("n"))
    fitted = staged(histogram.join(targets.select("source_id", "source_size", "target"), "source_id").groupBy("source_id").applyInPandas(
        _fit(limit), "source_id long, size long, n long, passes long, extra long"), "fitted")

    # hash ranges of a length group and the quota of each
    dealt = sized.join(fitted, ["source_id", "size"]).withColumn("range", _range())
    partial = dealt.filter((F.col("extra") > 0) & (F.col("extra") < F.col("n")))
    counted = partial.groupBy("source_id", "size", "range").agg(F.count(F.lit(1)).alias("rows"), F.first("extra").alias("quota_all"))
    before = F.coalesce(F.sum("rows").over(Window.partitionBy("source_id", "size").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    quotas = counted.select("source_id", "size", "range", F.greatest(F.lit(0), F.least(F.col("rows"), F.col("quota_all") - before)).alias("quota"))
    rank = F.row_number().over(Window.partitionBy("source_id", "size", "range").orderBy("draw", "doc_id"))
    some = partial.join(quotas, ["source_id", "size", "range"]).withColumn("more", (rank <= F.col("quota")).cast("long"))
    rest = dealt.filter((F.col("extra") == 0) | (F.col("extra") == F.col("n"))).withColumn("more", (F.col("extra") > 0).cast("long"))
    columns = ["doc_id", "source", "source_id", "size", "draw", "range", "extra", "n", "more", (F.col("passes") + F.col("more")).alias("copies")]
    return some.select(*columns).unionByName(rest.select(*columns)), targets, fitted


def mix(docs: DataFrame, seed: int = SEED, limit: int = DP_WORDS) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` for every row."""
    rows, targets, _ = _decided(docs, seed, limit)
    return rows.join(targets.select("source_id", "source_size", "target"), "source_id").select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "draw")


def _cuts(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """``source_id, size, n, passes, extra, cut, tied, tied_taken``: one row per length of a source.

    Of a length taken in part, ``cut`` is the last place (range, draw) that is
    taken, ``tied`` the rows at that place and ``tied_taken`` how many of them are.
    """
    partial = rows.filter((F.col("extra") > 0) & (F.col("extra") < F.col("n"))).select(
        "source_id", "size", "more", F.struct("range", "draw").alias("place"))
    cuts = partial.filter("more = 1").groupBy("source_id", "size").agg(F.max("place").alias("cut"))
    ties = partial.join(cuts, ["source_id", "size"]).filter("place = cut").groupBy("source_id", "size").agg(
        F.max("cut").alias("cut"), F.count(F.lit(1)).alias("tied"), F.sum("more").alias("tied_taken"))
    return lengths.join(ties, ["source_id", "size"], "left")


def mixed_documents(docs: DataFrame, seed: int = SEED, limit: int = DP_WORDS) -> DataFrame:
    """``docs`` with every row as many times (0, 1 or 2) as the mix takes its document.

    What is taken of a length ends at one place in the order of draws, so a
    small table of cut-offs decides every row where it is read and no text
    moves. Only rows at a cut-off that takes some of them are told apart:
    they are equal in doc_id and text, so equal rows are counted, and the
    counts share what is taken in the order of the other columns.
    """
    rows, _, lengths = _decided(docs, seed, limit)
    columns = ["source_id", "size", "range", "draw", "extra", "n", "more"]
    cuts = staged(_cuts(staged(rows.select(*columns), "taken"), lengths), "cuts")
    read = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), _source_id().alias("source_id"), n_words().alias("size"),
                       _draw(seed).alias("draw")).filter("size > 0")
    placed = read.join(bounded_broadcast(cuts), ["source_id", "size"]).withColumn("place", F.struct(_range().alias("range"), "draw"))
    more = (F.when(F.col("extra") == F.col("n"), 1).when(F.col("extra") == 0, 0).when(F.col("place") < F.col("cut"), 1)
            .when(F.col("place") > F.col("cut"), 0).when(F.col("tied") == F.col("tied_taken"), 1))  # else NULL: some of the tied rows
    known = placed.withColumn("copies", F.col("passes") + more)
    sure = known.filter("copies > 0").select("row", "copies")
    equal = known.filter("copies is null").groupBy("source_id", "size", "row").agg(
        F.count(F.lit(1)).alias("rows"), F.max("passes").alias("passes"), F.max("tied_taken").alias("open"))
    earlier = Window.partitionBy("source_id", "size").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("open") - F.coalesce(F.sum("rows").over(earlier), F.lit(0))
    shared = equal.select("row", (F.col("rows") * F.col("passes") + F.greatest(F.lit(0), F.least(F.col("rows"), left))).alias("copies"))
    return (sure.unionByName(shared.filter("copies > 0"))
            .select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("row.*"))
