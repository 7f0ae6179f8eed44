"""Benchmark decontamination by Wu-Manber multi-pattern search.

Every benchmark item gives its windows of ``WINDOW`` consecutive words (a
shorter item is one window). Texts are reduced to lower-cased words with one
blank before, between and after them, so a window is a byte string that begins
and ends with a blank, and it stands in a text exactly where its bytes do.

Test strings of one word count form a ``PatternSet``. Its *shift table* tells by
the block of bytes at the end of the search window how far the window can move
without missing a string; a block no string holds moves it by nearly the
shortest string's length. Where the shift is zero, the *suffix-hash bucket* of
that block selects the test strings, a search in the bucket by the whole
string's hash leaves one, and its bytes are compared directly. All cursors of
a batch, one per ``SEGMENT`` bytes, advance together in NumPy.

At scale: one narrow pass over the documents, no shuffle. The test strings are
sent to the tasks as ranges of the benchmark's own bytes, at most about
``PART_BYTES`` of text at a time; a larger benchmark is dealt into parts (long
items in overlapping sections) and the documents pass once for each part, with
what was found so far written in between. Nothing is dropped at any size.

Defined cases: words are runs of letters a-z (after lower-casing A-Z), digits
and all non-ASCII characters; null or empty texts have no words and no hits,
and items without words have no window. A window stands in one text only. An
item whose id repeats is counted once; a null item_id is written as the empty
text. Rows that repeat each get their row. An empty benchmark hits nothing.
Columns other than doc_id, item_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import column_bytes, slices, small_batches, staged
from starloom.llm.grams import Bytes, GramTable, joined_words

WINDOW = 10
PART_BYTES = 32 << 20
SECTION = 1024       # windows of an item in one section
SEGMENT = 512        # bytes each cursor searches
PREFIX = 256         # bytes of a test string that the shift table looks at, at most
BLOCK = 8

_UPPER, _LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class PatternSet:
    """Distinct test strings of ``count`` words, given as ranges of ``text``, and their search tables."""

    def __init__(self, text: Bytes, start: np.ndarray, length: np.ndarray, count: int):
        self.count = count
        self.m = int(min(length.min(), PREFIX))
        self.block = min(BLOCK, (self.m + 1) // 2)
        self._mask = np.uint64((1 << (8 * self.block)) - 1)
        blocks = len(start) * (self.m - self.block + 1)
        self._bits = min(max((4 * blocks).bit_length(), 10), 22)
        self.shift = np.full(1 << self._bits, self.m - self.block + 1, np.int32)
        for end in range(self.block, self.m + 1):  # later blocks allow smaller shifts and overwrite
            self.shift[self._slots(text, start + (end - self.block))] = self.m - end
        slot = self._slots(text, start + (self.m - self.block))
        key = text.xxhash64(start, length)
        order = np.lexsort((key, slot))
        self.order, self._text = order, text
        self._start, self._length, self._key = start[order], length[order], key[order]
        self._first = np.searchsorted(slot[order], np.arange((1 << self._bits) + 1)).astype(np.int32)

    def _slots(self, text: Bytes, at: np.ndarray) -> np.ndarray:
        return (((text.u64[at] & self._mask) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self._bits)).astype(np.int64)

    def stops(self, text: Bytes) -> np.ndarray:
        """Positions of ``text`` at which the shift is zero."""
        last = len(text) - self.m
        at = np.arange(0, last + 1, SEGMENT)
        end = np.minimum(at + SEGMENT, last + 1)
        found = []
        while len(at):
            shift = self.shift[self._slots(text, at + (self.m - self.block))]
            found.append(at[shift == 0])
            at = at + np.maximum(shift, 1)
            live = at < end
            if not live.all():
                at, end = at[live], end[live]
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def occurrences(self, text: Bytes, blanks: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(first word, test string)`` of all occurrences; word i lies between blanks i and i + 1 and belongs to ``row[i]``."""
        at = self.stops(text)
        word = np.searchsorted(blanks, at)
        ok = (blanks[np.minimum(word, len(blanks) - 1)] == at) & (word + self.count <= len(row))
        at, word = at[ok], word[ok]
        ok = row[word] == row[word + self.count - 1]
        at, word = at[ok], word[ok]
        length = blanks[word + self.count] + 1 - at
        slot = self._slots(text, at + (self.m - self.block))
        key = text.xxhash64(at, length)
        lo, end = self._first[slot].astype(np.int64), self._first[slot + 1].astype(np.int64)
        hi = end.copy()
        while (open_ := lo < hi).any():
            mid = (lo + hi) // 2
            less = open_ & (self._key[np.minimum(mid, len(self._key) - 1)] < key)
            lo, hi = np.where(less, mid + 1, lo), np.where(open_ & ~less, mid, hi)
        words, strings = [], []
        todo = np.flatnonzero(lo < end)
        while len(todo):
            todo = todo[self._key[lo[todo]] == key[todo]]
            same = self._length[lo[todo]] == length[todo]
            some = todo[same]
            same[same] = text.equal(at[some], self._start[lo[some]], length[some], self._text)
            words.append(word[todo[same]])
            strings.append(self.order[lo[todo[same]]])
            todo = todo[~same]
            lo[todo] += 1
            todo = todo[lo[todo] < end[todo]]
        none = np.zeros(0, np.int64)
        return np.concatenate(words or [none]), np.concatenate(strings or [none])


class Patterns:
    """The windows of some benchmark sections: a ``PatternSet`` for each word count, and the items of each window."""

    def __init__(self, sections: list[tuple[str, str]], window: int):
        names = np.array([item for item, _ in sections], object)
        self.items, number = np.unique(names, return_inverse=True) if len(names) else (names, np.zeros(0, np.int64))
        raw = [text.encode() + b" " for _, text in sections]
        text = Bytes(np.frombuffer(b" " + b"".join(raw), np.uint8))
        blanks = np.flatnonzero(text.data[: len(text)] == 0x20)
        end = np.cumsum([len(r) for r in raw])
        section = np.searchsorted(end, blanks[1:], side="left")  # of every word
        size = np.bincount(section, minlength=len(raw))
        found = {}
        for count in np.unique(np.minimum(size, window)).tolist():
            first = np.flatnonzero((section >= 0) & (np.minimum(size[section], window) == count))
            first = first[first + count <= len(section)]
            first = first[section[first] == section[first + count - 1]]
            found[count] = blanks[first], blanks[first + count] + 1 - blanks[first], number[section[first]]
        self.sets: list[tuple[PatternSet, np.ndarray, np.ndarray]] = []
        for count, (start, length, item) in found.items():
            table = GramTable(text, start, length)
            which = np.searchsorted(table.used, table.slot)
            pairs = np.unique(np.stack([which, item]), axis=1)
            offsets = np.searchsorted(pairs[0], np.arange(len(table.used) + 1))
            self.sets.append((PatternSet(text, start[table.first], length[table.first], count), offsets, pairs[1]))

    def search(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict[int, np.ndarray]]:
        """``(row of every word, change of cover at every word, items by row)`` of some rows."""
        joined, _, ends, row = joined_words(data, offsets)
        text = Bytes(np.concatenate([[np.uint8(0x20)], joined]))
        blanks = np.concatenate([[0], ends + 1])
        change = np.zeros(len(row) + 1, np.int64)
        items: dict[int, list[np.ndarray]] = {}
        for strings, first_item, item in self.sets:
            word, string = strings.occurrences(text, blanks, row)
            np.add.at(change, word, 1)
            np.add.at(change, word + strings.count, -1)
            for r, s in np.unique(np.stack([row[word], string]), axis=1).T:
                items.setdefault(int(r), []).append(item[first_item[s]: first_item[s + 1]])
        return row, change, {r: np.unique(np.concatenate(x)) for r, x in items.items()}


def _runs(cover: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last + 1 words of the maximal runs of covered words within a row."""
    edge = np.ones(len(row) + 1, bool)
    edge[1:-1] = row[1:] != row[:-1]
    before = np.concatenate([[False], cover]) & ~edge
    after = np.concatenate([cover, [False]]) & ~edge
    return np.flatnonzero(cover & ~before[:-1]), np.flatnonzero(cover & ~after[1:]) + 1


def _scan(patterns: Patterns, keep_text: bool):
    names = pa.array(patterns.items.tolist(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column("body"))
            for lo, hi in slices(offsets):
                part = batch.slice(lo, hi - lo)
                row, change, items = patterns.search(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo])
                n_words = np.bincount(row, minlength=hi - lo)
                base = np.concatenate([[0], np.cumsum(n_words)])
                for name, step in (("hit_from", 1), ("hit_to", -1)):  # what earlier parts have found
                    column = part.column(name)
                    at = np.repeat(np.arange(hi - lo), np.diff(column.offsets.to_numpy()))
                    np.add.at(change, column.flatten().to_numpy() + base[at], step)
                first, last = _runs(np.cumsum(change[:-1]) > 0, row)
                spans = np.searchsorted(first, base)
                earlier = part.column("items")
                found = [earlier[r].as_py() + names.take(pa.array(items[r])).to_pylist() if r in items else earlier[r].as_py()
                         for r in range(hi - lo)]
                at = np.repeat(base[:-1], np.diff(spans))
                out = {"doc_id": part.column("doc_id"), "n_words": pa.array(n_words),
                       "hit_from": pa.ListArray.from_arrays(pa.array(spans, pa.int32()), pa.array(first - at)),
                       "hit_to": pa.ListArray.from_arrays(pa.array(spans, pa.int32()), pa.array(last - at)),
                       "items": pa.array(found, pa.list_(pa.string()))}
                if keep_text:
                    out["body"] = part.column("body")
                yield pa.RecordBatch.from_pydict(out)

    return run


def sections(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item, text``: every item's words joined by blanks, long items in sections that overlap by ``window`` - 1 words."""
    words = F.regexp_extract_all(F.translate("text", _UPPER, _LOWERED), F.lit(_WORD), F.lit(0))
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words.alias("w")).filter(F.size("w") > 0)
    last = F.expr(f"cast((greatest(size(w) - {window} + 1, 1) - 1) div {SECTION} as int)")
    cut = items.select("item", "w", F.explode(F.sequence(F.lit(0), last)).alias("at"))
    text = F.array_join(F.slice("w", F.col("at") * SECTION + 1, SECTION + window - 1), " ")
    return cut.select("item", text.alias("text")).distinct()


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, part_bytes: int = PART_BYTES) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items, hits, contaminated`` for every row of ``docs``.

    ``items`` are the ids (as sorted strings) of the items with an occurring
    window, ``hits`` the runs ``(first, last)`` of hit words, last excluded.
    """
    small_batches(docs.sparkSession)
    tests = staged(sections(benchmark, window), "sections")
    total = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // part_bytes))
    dealt = F.pmod(F.xxhash64("item", "text"), F.lit(parts))
    longs, texts = F.array().cast("array<bigint>"), F.array().cast("array<string>")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(0).cast("long").alias("n_words"),
                       longs.alias("hit_from"), longs.alias("hit_to"), texts.alias("items"), _body().alias("body"))
    shape = "doc_id long, n_words long, hit_from array<bigint>, hit_to array<bigint>, items array<string>"
    for part in range(parts):
        held = Patterns([(r.item, r.text) for r in tests.filter(dealt == part).collect()], window)  # about part_bytes at most
        final = part == parts - 1
        rows = rows.mapInArrow(_scan(held, not final), shape if final else shape + ", body binary")
        rows = rows if final else staged(rows, "searched")
    n_hit = F.aggregate(F.zip_with("hit_to", "hit_from", lambda a, b: a - b), F.lit(0).cast("long"), lambda a, b: a + b)
    hits = F.zip_with("hit_from", "hit_to", lambda a, b: F.struct(a.alias("first"), b.alias("last")))
    return (rows.withColumn("items", F.array_sort(F.array_distinct("items")))
            .select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), "items",
                    hits.alias("hits"), (F.size("hit_from") > 0).alias("contaminated")))


def _body() -> Column:
    return F.concat(F.coalesce("text", F.lit("")), F.lit("\n")).cast("binary")


def items_digest() -> Column:
    """SHA-256 of the sorted item ids, joined by commas."""
    return F.sha2(F.concat_ws(",", "items"), 256)
