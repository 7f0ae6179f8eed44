"""Licence scans by diagonal voting.

Each text's words are rolled into k-gram hashes (k = 2 for short phrases, 4 for
licence passages) and every position whose k-gram some template holds is joined
with the template positions of that k-gram. Other positions have no partner and
never leave the task that rolls them. A hit at text position p and template position t
lies on diagonal p - t; text that follows a template keeps to one diagonal.

* A short phrase stands where all its k-grams hit one diagonal. These *base*
  places are complete: no vote is dropped.
* A licence passage may have words inserted or left out. Votes are counted by
  (text, template, diagonal, stretch of the text), neighbouring diagonals are
  merged when they lie within ``SLACK`` words, and a merged span is verified:
  its distinct template positions must cover ``COVER`` of the template.

The template table is fixed (a few hundred positions), so the join broadcasts
it; votes are summed per task before the shuffle and keyed by text, so one
text with very many places is the largest group. ``scan`` returns one row per
input row with the base counts and labels, the passage labels and a score.

Defined cases: words are runs of letters a-z (after lower-casing A-Z), digits
and all non-ASCII characters; a null text is empty and has no word, no label
and score 0. Rows that repeat (same doc_id and text) each get their own row.
The score is 1 with a base label, else the best cover of a passage.
Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.llm.common import ALNUM_WORDS, LOWER, column_bytes, roll, slices, small_batches, staged, text_bytes, word_hashes, words

SHORT, LONG = 2, 4
SLACK = 6
COVER = 0.6

# The phrases of the base scan, and openings of public licence texts.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
PASSAGES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
           "documentation files to deal in the software without restriction including without limitation the rights to use "
           "copy modify merge publish distribute sublicense and or sell copies of the software",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the "
           "following conditions are met redistributions of source code must retain the above copyright notice this list of "
           "conditions and the following disclaimer",
    "apache": "you may not use this file except in compliance with the license you may obtain a copy of the license at",
    "gpl": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
           "license as published by the free software foundation",
    "lgpl": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general "
            "public license as published by the free software foundation",
    "mpl": "this source code form is subject to the terms of the mozilla public license",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
           "provided that the above copyright notice and this permission notice appear in all copies",
    "cc-by": "this work is licensed under a creative commons attribution",
    "unlicense": "this is free and unencumbered software released into the public domain",
}


def _text_words(text: str) -> tuple[np.ndarray, int]:
    data = LOWER[np.frombuffer(text.encode(), np.uint8)]
    starts, ends, _ = words(data, np.array([0, len(data)]), ALNUM_WORDS)
    return word_hashes(data, starts, ends), len(starts)


def template_grams(phrases: dict[str, str], passages: dict[str, str]) -> list[tuple[int, int, int, str, int, bool]]:
    """``(k-gram hash, template, position, label, words, is phrase)`` of every template position."""
    rows = []
    for number, (text, label, k, phrase) in enumerate(
            [(t, lab, SHORT, True) for t, lab in phrases.items()] + [(t, lab, LONG, False) for lab, t in passages.items()]):
        hashes, n = _text_words(text)
        if n < k:
            raise ValueError(f"template needs at least {k} words: {text!r}")
        for at, h in enumerate(roll(hashes, k).view(np.int64).tolist()):
            rows.append((h, number, at, label, n, phrase))
    return rows


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each value is in ``known`` (sorted)."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _rolled(known: np.ndarray):
    """Rolling k-gram hashes that are among ``known``; a row at position -1 carries the text's number of words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column("body"))
            ids = batch.column("doc").to_numpy()
            for lo, hi in slices(offsets):
                part = LOWER[data[offsets[lo]: offsets[hi]]]
                starts, ends, at = words(part, offsets[lo: hi + 1] - offsets[lo], ALNUM_WORDS)
                hashes = word_hashes(part, starts, ends)
                yield _grams(ids[lo:hi], np.full(hi - lo, -1), np.diff(at))
                for k in (SHORT, LONG):
                    rolled = roll(hashes, k).view(np.int64)
                    found = np.flatnonzero(_among(rolled, known))
                    row = np.searchsorted(at, found, side="right") - 1
                    inside = found + k <= at[row + 1]  # k-grams never cross documents
                    found, row = found[inside], row[inside]
                    yield _grams(ids[lo:hi][row], found - at[row], rolled[found])

    return run


def _grams(doc: np.ndarray, pos: np.ndarray, gram: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(pos.astype(np.int32)), pa.array(gram)], names=["doc", "pos", "gram"])


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, passages: dict[str, str] = PASSAGES) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_passages`` for every row."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64(F.coalesce("text", F.lit("")), "doc_id").alias("doc"), text_bytes().alias("body"))
    positions = template_grams(phrases, passages)
    templates = spark.createDataFrame(positions, "gram long, template int, at int, label string, size int, phrase boolean")
    known = np.unique(np.array([p[0] for p in positions], np.int64))
    joined = rows.select("doc", "body").mapInArrow(_rolled(known), "doc long, pos int, gram long").join(
        F.broadcast(templates), "gram", "left")
    hits = staged(joined.filter("pos < 0 or template is not null"), "hits")

    diagonals = (hits.filter("pos >= 0").withColumn("diagonal", F.col("pos") - F.col("at"))
                 .groupBy("doc", "template", "label", "size", "phrase", "diagonal")
                 .agg(F.collect_set("at").alias("votes")))
    base = diagonals.filter(F.col("phrase") & (F.size("votes") == F.col("size") - (SHORT - 1))).groupBy("doc").agg(
        F.count(F.lit(1)).alias("n_base"), F.min("diagonal").cast("long").alias("first_word"),
        F.max("diagonal").cast("long").alias("last_word"), F.collect_set("label").alias("base"))

    in_text = Window.partitionBy("doc", "template").orderBy("diagonal")
    spans = (diagonals.filter("not phrase")
             .withColumn("apart", (F.col("diagonal") - F.lag("diagonal").over(in_text) > SLACK).cast("int"))
             .withColumn("span", F.sum(F.coalesce("apart", F.lit(0))).over(in_text))
             .groupBy("doc", "template", "label", "size", "span")
             .agg(F.size(F.array_distinct(F.flatten(F.collect_list("votes")))).alias("covered"))
             .withColumn("cover", F.col("covered") / (F.col("size") - (LONG - 1))))
    passage = spans.groupBy("doc").agg(
        F.max("cover").alias("cover"), F.count_if(F.col("cover") >= COVER).alias("n_passages"),
        F.collect_set(F.when(F.col("cover") >= COVER, F.col("label"))).alias("found"))
    counts = hits.filter("pos < 0").groupBy("doc").agg(F.max("gram").alias("n_words"))

    joined_labels = lambda c: F.concat_ws(",", F.array_sort(c))
    none = F.array().cast("array<string>")
    return (rows.select("doc_id", "doc").join(counts, "doc", "left").join(base, "doc", "left").join(passage, "doc", "left")
            .select("doc_id", F.coalesce("n_words", F.lit(0)).cast("long").alias("n_words"),
                    F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
                    joined_labels(F.coalesce("base", none)).alias("base_labels"),
                    joined_labels(F.array_union(F.coalesce("base", none), F.coalesce("found", none))).alias("labels"),
                    F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("cover", F.lit(0.0))).alias("score"),
                    F.coalesce("n_passages", F.lit(0)).cast("long").alias("n_passages")))
