"""Near-duplicate documents by min-max hashing over word shingles.

Every permutation is evaluated once per shingle and both its minimum and its
maximum are kept, so ``N_PERMS`` evaluations give ``2 * N_PERMS`` signature
values, each of which agrees for two sets with the probability of their
Jaccard similarity. Bands of four values (minimum and maximum of two
permutations) make the buckets. At a similarity of 0.75 a pair misses all 32
buckets with probability 5e-6.

Plan, all as joins and grouped aggregates:

1. one pass over the texts gives each document its set size, a 128-bit digest
   of its full shingle set and the band values; documents with one digest
   collapse to a class (copies are never compared);
2. each bucket's members are compared with the bucket's smallest member only
   (a star), on full shingle sets; components of the confirmed links follow;
3. only buckets that still hold several components are opened again: members
   outside the bucket's largest component are compared with every member of
   another component and of a possible size. Pairs inside a component need no
   test, so no link that could change a component is skipped, and a bucket of
   near copies costs a linear number of comparisons. In large buckets each
   document first gets ``PARTS`` counts, by hash range, of its shingles that
   another member of such a bucket also has. Two sets have at most the sum of
   the smaller counts in common, which bounds every similarity from above:
   documents that provably link with no member leave, and only pairs that pass
   the bound are compared in full;
4. components of all confirmed links.

Defined cases: words are split at ASCII white space after lower-casing A-Z; a
text of 1 to k-1 words is one shingle; an empty or null text has no shingles,
links with nothing and is kept. A null doc_id gets its set size, links with
nothing and is kept with a null component. Rows that repeat a doc_id are one
node; each row is returned. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import (LOWER, SPACE_WORDS, column_bytes, discard, mix, roll, slices, small_batches, staged,
                                 text_bytes, word_hashes, words)
from starloom.llm.graph import connected_components
from starloom.plans.sizing import bounded_broadcast

SHINGLE = 5
PERCENT = 75
N_PERMS = 64
PARTS = 32  # hash ranges of the shared-shingle counts
MANY = (1 << 16) - 1  # the largest packed count, which bounds nothing
LARGE = 8  # members from which a bucket's documents are first tested for being linkable at all
BLOCK = 1 << 15  # shingles hashed at a time, sized for the CPU cache

_SEEDS = mix(np.arange(1, 2 * N_PERMS + 1, dtype=np.uint64))
_FACTORS, _ADDENDS = _SEEDS[:N_PERMS] | np.uint64(1), _SEEDS[N_PERMS:]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document."""
    data = LOWER[data]
    starts, ends, at = words(data, offsets, SPACE_WORDS)
    hashes = word_hashes(data, starts, ends)
    rolled = roll(hashes, k)
    out = []
    for i in range(len(offsets) - 1):
        lo, hi = at[i], at[i + 1]
        if hi - lo >= k:
            out.append(np.unique(rolled[lo: hi - k + 1]))
        elif hi > lo:
            out.append(roll(hashes[lo:hi], int(hi - lo)) ^ np.uint64(hi - lo))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Min and max under each permutation for consecutive non-empty sets: (sets, 2 * N_PERMS)."""
    sig = np.empty((len(bounds), 2 * N_PERMS), np.uint64)
    for p in range(N_PERMS):
        v = values * _FACTORS[p]
        v += _ADDENDS[p]
        sig[:, 2 * p] = np.minimum.reduceat(v, bounds)
        sig[:, 2 * p + 1] = np.maximum.reduceat(v, bounds)
    return sig


def _signatures_of(sets: list[np.ndarray]) -> np.ndarray:
    """Signatures of non-empty sets; blocks stay in cache, a large set is folded block by block."""
    sig = np.empty((len(sets), 2 * N_PERMS), np.uint64)
    i = 0
    while i < len(sets):
        j, total = i + 1, len(sets[i])
        if total > BLOCK:
            parts = np.concatenate([signature(sets[i][lo: lo + BLOCK], np.array([0])) for lo in range(0, total, BLOCK)])
            sig[i, 0::2], sig[i, 1::2] = parts[:, 0::2].min(0), parts[:, 1::2].max(0)
        else:
            while j < len(sets) and total + len(sets[j]) <= BLOCK:
                total += len(sets[j])
                j += 1
            sizes = np.array([len(s) for s in sets[i:j]])
            sig[i:j] = signature(np.concatenate(sets[i:j]), np.cumsum(sizes) - sizes)
        i = j
    return sig


def _bands(sig: np.ndarray) -> np.ndarray:
    """One 64-bit bucket key for each run of four signature values; the band number is part of it."""
    n = sig.shape[1] // 4
    key = np.broadcast_to(np.arange(1, n + 1, dtype=np.uint64), (len(sig), n)).copy()
    for r in range(4):
        key = mix(key * np.uint64(0x9FB21C651E98DF25) + sig[:, r::4])
    return key


def _sketch(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column("body"))
            for lo, hi in slices(offsets):
                sets = shingle_sets(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo], k)
                full = [i for i, s in enumerate(sets) if len(s)]
                bands: list = [None] * len(sets)
                if full:
                    keys = _bands(_signatures_of([sets[i] for i in full])).view(np.int64)
                    for row, i in enumerate(full):
                        bands[i] = keys[row]
                digest = np.array([[s.sum(dtype=np.uint64), mix(s + np.uint64(len(s))).sum(dtype=np.uint64)] for s in sets],
                                  np.uint64).reshape(-1, 2).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(digest[:, 0]), pa.array(digest[:, 1]), pa.array(bands, pa.list_(pa.int64()))],
                    names=["doc_id", "n_shingles", "h1", "h2", "bands"])

    return run


def sketches(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, h1, h2, bands`` for every row of ``docs``."""
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("body")).mapInArrow(
        _sketch(k), "doc_id long, n_shingles long, h1 long, h2 long, bands array<long>")


def _verify(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (da, oa), (db, ob) = column_bytes(batch.column("ta")), column_bytes(batch.column("tb"))
            keep = np.zeros(batch.num_rows, bool)
            for lo, hi in slices(np.maximum(oa, 0) + ob):
                left = shingle_sets(da[oa[lo]: oa[hi]], oa[lo: hi + 1] - oa[lo], k)
                right = shingle_sets(db[ob[lo]: ob[hi]], ob[lo: hi + 1] - ob[lo], k)
                for i, (x, y) in enumerate(zip(left, right)):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep[lo + i] = both > 0 and 100 * both >= percent * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(pa.array(keep)), batch.column("b").filter(pa.array(keep))], names=["a", "b"])

    return run


def confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The ``(a, b)`` pairs whose full shingle sets reach the similarity."""
    joined = (pairs.join(texts.select(F.col("node").alias("b"), F.col("body").alias("tb")), "b")
              .join(texts.select(F.col("node").alias("a"), F.col("body").alias("ta")), "a"))
    return joined.select("a", "b", "ta", "tb").mapInArrow(_verify(k, percent), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs(doc_id, text, ...)``."""
    sketch = staged(sketches(docs, k), "sketch")
    usable = sketch.filter("n_shingles > 0 and doc_id is not null")
    node_of = usable.groupBy("h1", "h2").agg(F.min("doc_id").alias("node"))
    # a doc_id that repeats with other texts ties its classes together
    same_id = usable.select("doc_id", "h1", "h2").join(node_of, ["h1", "h2"]).filter("doc_id <> node").select(
        F.col("doc_id").alias("u"), F.col("node").alias("v")).distinct()
    nodes = usable.join(node_of, ["h1", "h2"]).filter("doc_id = node").dropDuplicates(["h1", "h2"])
    buckets = staged(nodes.select("node", F.col("n_shingles").alias("size"), F.explode("bands").alias("bucket")), "buckets")

    least = buckets.groupBy("bucket").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a <> z").select("bucket", "a")
    several = staged(buckets.join(least, "bucket"), "several")  # most buckets have one member and leave here
    discard(buckets)
    star = staged(several.filter("node <> a").select("a", F.col("node").alias("b")).distinct(), "star")
    shared = staged(star.select(F.col("a").alias("node")).unionByName(star.select(F.col("b").alias("node"))).distinct(), "nodes")
    texts = staged(_texts(docs, shared), "texts")
    links = staged(confirmed(star, texts, k, percent), "links")

    label = connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    open_rows = staged(_open_rows(several.drop("a"), label), "open")
    large = open_rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > LARGE).select("bucket")
    in_large = open_rows.join(large, "bucket", "left_semi").select("bucket", "node", "size")
    counts = _shared(in_large.select("node").distinct(), texts, k)
    shared = staged(counts.select("node", sum(F.col(f"p{i}") for i in range(PARTS)).alias("total"), *_packed()), "shared")
    # what a node shares decides first; its counts join only the rows that are left
    able = staged(in_large.join(bounded_broadcast(shared.select("node", "total")), "node").filter(
        (100 + percent) * F.col("total") >= percent * (F.col("size") + F.ceil(F.col("size") * percent / 100))), "able")
    candidates = staged(_open_rows(_linkable(able, percent), label), "linkable").join(shared.drop("total"), "node")
    again = (_pairs(open_rows.join(large, "bucket", "left_anti"), percent, F.least("x.size", "y.size"))
             .unionByName(_pairs(candidates, percent, _common())).distinct().join(star, ["a", "b"], "left_anti"))
    more = confirmed(staged(again, "again"), texts, k, percent)

    edges = links.unionByName(more).select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(same_id)
    final = connected_components(edges)
    discard(several, star, texts, links, open_rows, shared, able)  # the components are written: nothing reads these again
    return (sketch.select("doc_id", "n_shingles", "h1")
            .join(final.withColumnRenamed("id", "doc_id"), "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def _open_rows(rows: DataFrame, label: DataFrame) -> DataFrame:
    """``rows(bucket, node, ...)`` of the buckets that hold several components, with ``component`` and ``main``, the largest."""
    labelled = rows.join(bounded_broadcast(label.select(F.col("id").alias("node"), "component")), "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    mixed = (labelled.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("top"), F.count(F.lit(1)).alias("parts"))
             .filter("parts > 1").select("bucket", F.col("top.component").alias("main")))
    return labelled.join(mixed, "bucket")


def _pairs(rows: DataFrame, percent: int, common: Column) -> DataFrame:
    """``a, b``: members outside their bucket's main component with members of another component.

    ``common`` bounds from above what ``x`` and ``y`` share; pairs that it keeps
    under the similarity are left out.
    """
    linkable = (100 + percent) * common >= percent * (F.col("x.size") + F.col("y.size"))
    return (rows.filter("component <> main").alias("x").join(rows.alias("y"), F.expr("x.bucket = y.bucket and x.component <> y.component") & linkable)
            .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")))


def _shingles(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column("body"))
            ids = batch.column("node").to_numpy()
            for lo, hi in slices(offsets):
                sets = shingle_sets(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo], k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids[lo:hi], [len(s) for s in sets])), pa.array(np.concatenate(sets).view(np.int64))], names=["node", "shingle"])

    return run


def _counts(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column("body"))
            for lo, hi in slices(offsets):
                sets = shingle_sets(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo], k)
                counts = np.array([np.bincount((s >> np.uint64(40)).view(np.int64) % PARTS, minlength=PARTS) for s in sets])
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(lo, hi - lo), *(pa.array(c) for c in counts.T)],
                                                 names=["node", *(f"p{i}" for i in range(PARTS))])

    return run


def _shared(nodes: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """``node, p0, p1, ...``: by hash range, how many shingles of each of ``nodes(node)`` may occur in another of them.

    The texts of a doc_id that repeats count together, so each of them has at most these counts.
    """
    bodies = texts.join(nodes, "node", "left_semi")
    ranges = range(PARTS)
    part = F.shiftrightunsigned("shingle", 40) % PARTS
    own = (bodies.mapInArrow(_shingles(k), "node long, shingle long")
           .groupBy("shingle").agg(F.min("node").alias("node"), F.max("node").alias("other")).filter("node = other")
           .groupBy("node").agg(*(F.count_if(part == i).alias(f"o{i}") for i in ranges)))
    total = bodies.mapInArrow(_counts(k), "node long, " + ", ".join(f"p{i} long" for i in ranges)).groupBy("node").agg(
        *(F.sum(f"p{i}").alias(f"p{i}") for i in ranges))
    return total.join(own, "node", "left").select("node", *(
        F.coalesce(F.col(f"p{i}") - F.col(f"o{i}"), F.col(f"p{i}"), F.lit(0)).cast("int").alias(f"p{i}") for i in ranges))


def _packed() -> list[Column]:
    """The counts ``p0, p1, ...`` in four 16-bit fields a number; the largest field means any count from there on."""
    field = lambda i: F.shiftleft(F.least(F.col(f"p{i}"), F.lit(MANY)).cast("long"), 16 * (i % 4))
    fields = [[field(i) for i in range(q, q + 4)] for q in range(0, PARTS, 4)]
    return [a.bitwiseOR(b).bitwiseOR(c).bitwiseOR(d).alias(f"q{n}") for n, (a, b, c, d) in enumerate(fields)]


def _common() -> Column:
    """An upper bound on what ``x`` and ``y`` share, from their packed counts."""
    def count(side: str, i: int) -> Column:
        field = F.shiftrightunsigned(f"{side}.q{i // 4}", 16 * (i % 4)).bitwiseAND(F.lit(MANY))
        return F.when(field == MANY, F.lit(1 << 40)).otherwise(field)

    return sum(F.least(count("x", i), count("y", i)) for i in range(PARTS))


def _linkable(rows: DataFrame, percent: int) -> DataFrame:
    """Rows of ``bucket, node, size, total`` whose node can reach the similarity with another member at all.

    A set has at most the sum of its counts in common with any other, so a link
    needs ``(100 + percent) * sum >= percent * (size + size)``. The partner is
    not smaller than the bucket's smallest set, nor than ``percent`` of this one.
    This keeps documents apart that only share a very common passage, and near
    copies that each went their own way too far.
    """
    smallest = rows.groupBy("bucket").agg(F.min("size").alias("smallest"))
    partner = F.greatest(F.col("smallest"), F.ceil(F.col("size") * percent / 100))
    return rows.join(smallest, "bucket").filter(
        (100 + percent) * F.col("total") >= percent * (F.col("size") + partner)).drop("smallest")


def _texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, body`` of the documents in ``nodes(node)``; a doc_id that repeats has each of its texts once."""
    bodies = docs.select(F.col("doc_id").cast("long").alias("node"), text_bytes().alias("body"))
    return bodies.join(bounded_broadcast(nodes), "node", "left_semi").withColumn("digest", F.xxhash64("body")).dropDuplicates(
        ["node", "digest"]).select("node", "body")


def keep_one(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group: the row of its smallest doc_id.

    Of rows equal in doc_id and text one stays. Rows that share a kept doc_id
    but not its text all stay, as do rows with a null doc_id.
    """
    found = near_duplicates(docs, k, percent).filter("kept and doc_id is not null").select("doc_id").distinct()
    known = docs.filter("doc_id is not null").join(found, "doc_id", "left_semi")
    return known.dropDuplicates(["doc_id", "text"]).unionByName(docs.filter("doc_id is null")).select(docs.columns)
