"""Removal of passages that repeat anywhere in the corpus, by a depth-limited radix sort of suffixes.

A suffix is taken through its first ``window`` bytes only. Equal groups of
that order are exactly the repeated windows, and every byte of a repeated
window goes. The order is made most significant digit first; a bucket with one
suffix is finished and leaves before the next digit:

* **Digit 1** is the smallest hashed 32-byte gram of the window (its content
  alone decides which). Suffixes at neighbouring starts mostly share that
  gram's place, so they travel as one *run* (start, number of suffixes): about
  one row for 185 bytes. Runs alone in their bucket cannot repeat and leave.
* **Digit 2** is the run's whole content. Runs that agree in it repeat with
  all their suffixes and are finished: exact copies and the inside of shared
  passages end here, without a row for each suffix.
* **Digits 3, 4, ...**: what is left are the runs at the edges of a shared
  passage. One run of each distinct content is cut into shorter runs (``CUTS``
  suffixes, at last single ones) at fixed distances from the gram. Their digit
  is the core that all their windows have in common; a run alone with its core
  leaves, runs of equal content are finished, the rest is cut again. After the
  last pass the core is the whole window, so its groups are exact.

All passes are grouped counts with map-side sums and joins on hashed digits;
no bucket is gathered in one task: a digit that holds more than one row in
``HOT_SHARE`` (fewer than that many digits can) is dealt over ``SALTS`` keys.
Only the bytes of edge runs are carried from pass to pass. Equal digits are equal 64-bit hashes under an equal 64-bit hash
of the digits before.

Defined cases: a null text counts as empty; texts shorter than the window
lose nothing; rows with equal text (also with equal or null doc_id) repeat
each other and lose everything if they reach the window; equal rows share one
list of spans, however many they are. Each input row gives
one output row. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import PrefixHash, column_bytes, discard, mix, small_batches, staged, text_bytes

WINDOW = 400
GRAM = 32
CUTS = (64, 8, 1)
SEGMENT = 1 << 19  # suffix starts taken at a time in a long text
HOT_SHARE = 1000
HOT_ROWS = 4096
SALTS = 64

_LOW = np.uint64((1 << 20) - 1)


def _sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by block prefix and suffix minima."""
    n = len(keys)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1: n])


def runs_of(data: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """``(start, suffixes, gram's place after start, gram hash, content hash)`` of the runs of all suffixes of one text."""
    out = []
    for lo in range(0, len(data) - window + 1, SEGMENT):
        part = data[lo: lo + SEGMENT + window - 1]
        hashes = PrefixHash(part)
        grams = hashes.grams(gram)
        place = (_sliding_min((grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64), window - gram + 1) & _LOW).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1])
        count = np.diff(np.append(first, len(place)))
        ahead = place[first] - first
        content = mix(hashes.spans(first, first + count - 1 + window) + ahead.astype(np.uint64))
        out.append((first + lo, count, ahead, grams[place[first]].view(np.int64), content.view(np.int64)))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 5


def _texts(batch: pa.RecordBatch, column: str = "body") -> Iterator[tuple[int, np.ndarray]]:
    data, offsets = column_bytes(batch.column(column))
    for i in range(batch.num_rows):
        yield i, data[offsets[i]: offsets[i + 1]]


def _joined(names: list[str], parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    if parts:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], names=names)


def _find_runs(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, parts = batch.column("doc").to_numpy(), []
            for i, text in _texts(batch):
                start, count, ahead, grams, content = runs_of(text, window, gram)
                parts.append((np.full(len(start), ids[i]), grams, content, start, count.astype(np.int32), ahead.astype(np.int32)))
            yield from _joined(["doc", "bucket", "content", "start", "suffixes", "ahead"], parts)

    return run


_FOUND = "doc long, bucket long, content long, start long, suffixes int, ahead int"
_EDGE = "doc long, run long, ahead int, bucket long, bytes binary"


def _take_bytes(window: int):
    """The bytes of a document's open runs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, runs, rows = batch.column("doc").to_numpy(), batch.column("runs"), []
            for i, text in _texts(batch):
                rows += [(int(ids[i]), r["start"], r["ahead"], r["bucket"], text[r["start"]: r["start"] + r["suffixes"] - 1 + window].tobytes())
                         for r in runs[i].as_py()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
                    pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()))], names=["doc", "run", "ahead", "bucket", "bytes"])

    return run


def _cut_runs(window: int, size: int):
    """Runs of at most ``size`` suffixes; the bucket is the core their windows have in common."""
    names = ["doc", "run", "bucket", "content", "start", "suffixes", "lone"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = {c: batch.column(c).to_numpy() for c in ("doc", "run", "ahead", "bucket")}
            open_, parts = batch.column("open"), []
            for i, text in _texts(batch, "bytes"):
                hashes, doc, first, ahead = PrefixHash(text), cols["doc"][i], cols["run"][i], int(cols["ahead"][i])
                for o in open_[i].as_py():
                    lo = o["start"] - first
                    before = ahead - np.arange(lo, lo + o["suffixes"])  # distance from each start to the gram
                    block = before // size
                    a = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1])
                    n = np.diff(np.append(a, len(block)))
                    block, a = block[a], a + lo
                    core = hashes.spans(ahead - block * size, ahead - block * size - size + 1 + window)
                    bucket = mix(core ^ mix(block.astype(np.uint64) + cols["bucket"].view(np.uint64)[i]))
                    content = mix(hashes.spans(a, a + n - 1 + window) + (ahead - a).astype(np.uint64))
                    parts.append((np.full(len(a), doc), np.full(len(a), first), bucket.view(np.int64), content.view(np.int64),
                                  a + first, n.astype(np.int32), np.full(len(a), o["lone"])))
            yield from _joined(names, parts)

    return run


def _doc_key() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")), F.col("doc_id"))


def _spans(runs: DataFrame, window: int) -> DataFrame:
    return runs.select("doc", "start", (F.col("start") + F.col("suffixes") - 1 + window).alias("end"))


def _in_groups(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """The ``rows`` (staged) whose ``keys`` are among ``groups``; ``n`` of a group is its number of rows.

    A group of over one row in ``HOT_SHARE`` would make one task long: its rows
    are dealt over ``SALTS`` keys and the group stands under each of them. There
    are fewer than ``HOT_SHARE`` such groups, so their list is broadcast.
    """
    bar = max(HOT_ROWS, rows.count() // HOT_SHARE)
    hot = groups.filter(F.col("n") > bar).select(*keys, F.lit(True).alias("hot"))
    salts = F.when(F.col("n") > bar, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    dealt = rows.join(F.broadcast(hot), keys, "left").withColumn(
        "salt", F.when(F.col("hot"), F.pmod(F.xxhash64("doc", "start"), F.lit(SALTS)).cast("int")).otherwise(0))
    found = dealt.join(groups.select(*keys, F.explode(salts).alias("salt")), [*keys, "salt"], "left_semi")
    return found.select(*rows.columns)


def _sorted_out(runs: DataFrame, carried: list[str], name: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One digit: ``(contents of two or more runs, one open run of each content in a bucket with others, what to discard)``."""
    contents = runs.groupBy("bucket", "content").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "start", *carried)).alias("first"))
    contents = staged(contents.select("bucket", "content", F.col("n").alias("runs"), "first.*"), name)
    mixed = contents.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    lone = (F.col("runs") == 1) & (F.col("lone") if "lone" in carried else F.lit(True))
    open_ = _in_groups(contents, mixed, ["bucket"]).withColumn("lone", lone)
    return contents.filter("runs > 1").select("bucket", "content", F.col("runs").alias("n")), open_, contents


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, cuts: tuple[int, ...] = CUTS) -> DataFrame:
    """``doc, spans`` (spans: array of start, end) of bytes that a repeated window covers.

    ``doc`` identifies a text under its doc_id; documents without a repeat are absent.
    The spans of a document may overlap and are in no order.
    """
    if not 0 < gram <= window or cuts[-1] != 1 or max(cuts) > window:
        raise ValueError("the gram and the cuts must fit in the window, and the last cut is 1")
    small_batches(docs.sparkSession)
    bodies = docs.select(_doc_key().alias("doc"), text_bytes().alias("body")).filter(F.octet_length("body") >= window)
    every = staged(bodies.mapInArrow(_find_runs(window, gram), _FOUND), "runs")
    shared = every.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    runs = staged(_in_groups(every, shared, ["bucket"]), "shared-runs")
    discard(every)
    agreed, open_, contents = _sorted_out(runs, ["suffixes", "ahead"], "contents")
    spans = _spans(_in_groups(runs, agreed, ["bucket", "content"]), window)

    open_ = staged(open_, "open")
    done = [runs, contents, open_]
    wanted = open_.groupBy("doc").agg(F.collect_list(F.struct("start", "suffixes", "ahead", "bucket")).alias("runs"))
    edges = staged(bodies.join(wanted, "doc").dropDuplicates(["doc"]).select("doc", "body", "runs").mapInArrow(_take_bytes(window), _EDGE), "edges")
    done.append(edges)
    open_ = open_.withColumn("run", F.col("start"))
    for size in cuts:
        parts = open_.groupBy("doc", "run").agg(F.collect_list(F.struct("start", "suffixes", "lone")).alias("open"))
        cut = staged(edges.join(parts, ["doc", "run"]).select("doc", "run", "ahead", "bucket", "bytes", "open").mapInArrow(
            _cut_runs(window, size), "doc long, run long, bucket long, content long, start long, suffixes int, lone boolean"), f"cut-{size}")
        agreed, open_, contents = _sorted_out(cut, ["run", "suffixes", "lone"], f"contents-{size}")
        spans = spans.unionByName(_spans(_in_groups(cut, agreed, ["bucket", "content"]).filter("lone"), window))
        done += [cut, contents]
    out = staged(spans.groupBy("doc").agg(F.collect_set(F.struct("start", "end")).alias("spans")), "spans")
    discard(*done)
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of bytes in any span."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans, rows = batch.column("spans"), []
        for i, text in _texts(batch):
            found = spans[i].values
            cuts = merged(list(zip(found.field("start").to_pylist(), found.field("end").to_pylist())))
            kept, at = [], 0
            for a, b in cuts:
                kept.append(text[at:a].tobytes())
                at = b
            kept.append(text[at:].tobytes())
            body = b"".join(kept)
            rows.append((len(text), len(text) - len(body), len(cuts), body, hashlib.sha256(body).hexdigest()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())))],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"]) if rows else pa.RecordBatch.from_pylist([], schema=_CUT)


_CUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary()), ("kept_sha256", pa.string())])


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, cuts: tuple[int, ...] = CUTS) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256`` for every row; ``kept`` holds the bytes that stay."""
    spans = repeated_spans(docs, window, gram, cuts)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _doc_key().alias("doc"), text_bytes().alias("body")).join(
        spans, "doc", "left")
    untouched = rows.filter("spans is null").select(
        "doc_id", F.octet_length("body").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.col("body").alias("kept"), F.sha2("body", 256).alias("kept_sha256"))
    cut = rows.filter("spans is not null").select("doc_id", "body", "spans").mapInArrow(
        _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
    return untouched.unionByName(cut)
