"""Incremental ingest as a Structured Streaming query (``availableNow``).

New files landing in a source folder are read as micro-batches; each batch
is deduplicated (latest row per id), merged with the hash buckets of the
published table that it touches, gated, and published; all other buckets are
neither read nor written (``plans.buckets``). The streaming checkpoint
makes the file source exactly-once; the pointer records the query id of the
checkpoint and the batch id, so a batch that the same stream already
published is skipped after a crash. A fresh checkpoint is another stream: its
batches count from 0 again and are all applied.
A second run over the same folder reads nothing.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starloom.operators import quality
from starloom.operators.upsert import assert_delta_keys, latest_per_key
from starloom.plans.buckets import apply_delta, publish_version
from starloom.plans.control import TableStore

# Buckets of a table whose first batch says nothing about its later size; a full load deals it anew.
BUCKETS = 64


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The query id that the checkpoint keeps for its whole life."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def stream_upsert(spark: SparkSession, source_dir: str, schema: T.StructType, store: TableStore, layer: str,
                  table: str, key: str = "id", order_col: str | None = None, critical: list[str] = (),
                  checkpoint: str | None = None, max_files_per_trigger: int | None = None,
                  min_unique_ratio: float = quality.MIN_UNIQUE_ID_RATIO, n_buckets: int = BUCKETS) -> list[dict]:
    """Drain ``source_dir`` into ``layer.table``; returns one entry per applied batch.

    Gates per batch: unique ids of the merged version and NULL % of the
    critical columns (the row-count gate needs a source count and is run
    by the batch pipeline).
    """
    checkpoint = checkpoint or os.path.join(store.root, "_streams", layer, table)
    applied: list[dict] = []

    def apply(batch: DataFrame, batch_id: int) -> None:
        stream = _stream_id(spark, checkpoint)
        if batch_id <= store.last_batch(layer, table, stream):
            return  # replay of an already published batch
        run_id = f"{stream}-b{batch_id:08d}-{uuid.uuid4().hex[:8]}"
        gate = dict(critical=list(critical), run_id=run_id, date_col=order_col, sort_within=[order_col] if order_col else [],
                    min_ratio=min_unique_ratio, batch_id=batch_id, stream=stream)
        if order_col is None:  # nothing says which of two rows is the latest
            assert_delta_keys(batch, key)
        if not store.exists(layer, table):
            change, _ = publish_version(store, latest_per_key(batch, key, order_col), layer, table, key, n_buckets, **gate)
        else:
            change = apply_delta(store, batch, layer, table, key, order_col, **gate)
        applied.append({"batch_id": batch_id, "path": store.pointer(layer, table)["path"], "touched_buckets": change.touched})

    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    q = (reader.parquet(source_dir).writeStream.foreachBatch(apply)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return applied
