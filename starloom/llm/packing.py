"""Best-fit packing of documents into sequences, with conflicts.

A document is cut into pieces of at most ``capacity`` words; full pieces fill
a bin each. The last pieces are packed longest first: open bins are kept in
order of their residual capacity, each with a bitmap of the sources and one of
the duplicate clusters it holds, and the search goes from the first bin that
is large enough to its successors until it meets one without a common bit: the
tightest compatible bin. Otherwise a new bin opens. So no bin holds two pieces
of one source or of one duplicate cluster.

Documents are dealt by hash into shards of about ``SHARD_ROWS`` rows; the
number of shards grows with the input and each is packed on its own, on narrow
rows without texts. A hot source spreads evenly over the shards. Ties in length
go by a hash of the document, so reruns agree.

Defined cases: an empty or null text has no piece: one row with piece null and
bin null. Null sources count as one source, a null cluster conflicts with
nothing. Rows that repeat are separate pieces of one cluster. A capacity below
1 raises. Columns other than doc_id, text and source are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import staged
from starloom.llm.mixing import n_words

CAPACITY = 2048
SHARD_ROWS = 4096

_SCHEMA = ("doc_id long, source string, piece long, first_word long, n_words long, bin_id long, bin_offset long")


def duplicate_cluster(col: str = "text") -> Column:
    """Cluster of copies: texts that agree but for case and outer blanks."""
    return F.xxhash64(F.lower(F.trim(F.col(col))))


def best_fit(pieces: list[tuple[int, object, object]], capacity: int) -> list[tuple[int, int]]:
    """``(bin, offset)`` of each ``(length, source, cluster)``, in the given order."""
    sources: dict = {}
    clusters: dict = {}
    open_bins: list[tuple[int, int]] = []  # (residual, bin), ascending
    held: list[list[int]] = []  # per bin: source bitmap, cluster bitmap
    out = []
    for length, source, cluster in pieces:
        s = 1 << sources.setdefault(source, len(sources))
        c = 0 if cluster is None else 1 << clusters.setdefault(cluster, len(clusters))
        at = bisect_left(open_bins, (length, -1))
        while at < len(open_bins):
            b = held[open_bins[at][1]]
            if not (b[0] & s or b[1] & c):
                break
            at += 1
        if at < len(open_bins):
            residual, number = open_bins.pop(at)
            held[number][0] |= s
            held[number][1] |= c
        else:
            residual, number = capacity, len(held)
            held.append([s, c])
        out.append((number, capacity - residual))
        if residual > length:
            insort(open_bins, (residual - length, number))
    return out


def _pack_shard(capacity: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        shard = int(rows["shard"].iloc[0])
        rows = rows.assign(tail=rows["size"] % capacity).sort_values(["tail", "draw", "doc_id"], ascending=[False, True, True], kind="stable")
        tails = rows[rows["tail"] > 0]
        clusters = [None if pd.isna(c) else int(c) for c in tails["cluster"]]
        seen = pd.Series(clusters, dtype=object).value_counts()  # a cluster met once needs no bit
        keyed = [(int(n), s if isinstance(s, str) else None, c if c is not None and seen[c] > 1 else None)
                 for n, s, c in zip(tails["tail"], tails["source"], clusters)]
        places = dict(zip(tails.index, best_fit(keyed, capacity)))
        n_bins = 1 + max((b for b, _ in places.values()), default=-1)
        out = []
        for index, doc_id, source, size, tail in zip(rows.index, rows["doc_id"], rows["source"], rows["size"], rows["tail"]):
            full = int(size) // capacity
            for piece in range(full):
                out.append((doc_id, source, piece, piece * capacity, capacity, n_bins, 0))
                n_bins += 1
            if tail:
                out.append((doc_id, source, full, full * capacity, int(tail), *places[index]))
        frame = pd.DataFrame(out, columns=["doc_id", "source", "piece", "first_word", "n_words", "bin_id", "bin_offset"])
        frame["bin_id"] += shard << 32
        return frame

    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS, cluster: Column | None = None) -> DataFrame:
    """``doc_id, source, piece, first_word, n_words, bin_id, bin_offset``: one row for each piece."""
    if capacity < 1:
        raise ValueError("the capacity must be at least one word")
    cluster = duplicate_cluster() if cluster is None else cluster
    rows = staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                              n_words().alias("size"), F.when(F.col("text").isNotNull(), cluster).alias("cluster"),
                              F.xxhash64("doc_id", "text").alias("draw")), "packing")
    shards = max(1, -(-rows.filter("size > 0").count() // shard_rows))
    # rows equal in all columns share a draw: they are counted (map-side), and each copy is dealt on its own
    copies = rows.filter("size > 0").groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))
    dealt = copies.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    place = F.when(F.col("copy") == 1, F.col("draw")).otherwise(F.xxhash64("draw", "copy"))
    packed = (dealt.withColumn("shard", F.pmod(place, F.lit(shards))).drop("n", "copy")
              .groupBy("shard").applyInPandas(_pack_shard(capacity), _SCHEMA))
    empty = rows.filter("size = 0").select(
        "doc_id", "source", F.lit(None).cast("long").alias("piece"), F.lit(None).cast("long").alias("first_word"),
        F.lit(0).cast("long").alias("n_words"), F.lit(None).cast("long").alias("bin_id"), F.lit(None).cast("long").alias("bin_offset"))
    return packed.unionByName(empty)
