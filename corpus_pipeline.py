"""A training-corpus pipeline over ``documents``: filter, dedup, redact, mix, pack.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written and read again as the next stage's documents. All but the last return
the columns of ``documents``.

Defined cases, by stage: ``quality`` scores a null text as an empty one, and
keeps every row while the labels know one class only. ``near_dedup`` keeps
texts without words; of rows with one doc_id one stays. ``pii`` leaves null
texts null. ``mixing`` takes no document without words. ``packing`` makes no
row for what is not there: an empty table stays empty through all stages.
Rows with a null doc_id, source or lang pass like others; further columns of
``documents`` travel to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm import minhash, mixing, packing, pii, quality
from starloom.llm.common import staged, table
from starloom.session import apply_core_conf


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier rejects go."""
    apply_core_conf(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    apply_core_conf(spark)
    return minhash.keep_one(docs)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced in the texts."""
    apply_core_conf(spark)
    return pii.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    apply_core_conf(spark)
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in fixed-size sequences."""
    apply_core_conf(spark)
    return packing.pack(docs)


STAGES = [
    ("quality", quality_filter),
    ("near_dedup", near_dedup),
    ("pii", redact_pii),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # a classifier, boosted trees and sequential packing have no SQL form; tests/llm holds brute-force checks


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
