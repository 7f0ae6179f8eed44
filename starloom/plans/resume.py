"""Extraction in batches that survives a killed run.

The delta is landed first: one read of the source, which may be a costly
join. From the landed rows the run stores a manifest: keyset bounds (first
and last (date, id)) of every batch of the delta. Rows of the pending batches
are then dealt by the job that will extract them. Batches are extracted from
there a few per job into the run's staging folder, and one progress row per
finished batch is appended. A later run that finds an open manifest deals the
batches without a progress row (an anti join) from one read of the source and
goes on with the first run's extraction instant. The watermark moves only
when the whole delta is published. Landed and dealt rows lie under the run's
staging folder, hidden from its readers, and are swept with it.

A run is open until a progress row with batch number -1 says ``published`` or
``abandoned``. A job that dies half-way leaves a folder its batches will
overwrite. A row that changes at the source after the manifest was made has a
later date and belongs to the next run.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.clean import SEEN
from starloom.functions.keys import ts_lit
from starloom.plans import control
from starloom.plans.control import META, TableStore
from starloom.sources import ingest

MANIFEST, PROGRESS = "batch_manifest", "chunk_progress"
WHOLE_RUN = -1
BATCHES_PER_JOB = 5
MAX_BATCHES = 1000
BATCH, JOB = "_batch", "_job"


def read_manifest(store: TableStore, table: str) -> DataFrame:
    return store.read_appended(META, MANIFEST, control.MANIFEST_SCHEMA, table)


def read_progress(store: TableStore, table: str | None = None) -> DataFrame:
    return store.read_appended(META, PROGRESS, control.PROGRESS_SCHEMA, table)


def record(store: TableStore, table: str, run_id: str, batches: list[int], status: str, at: dt.datetime) -> None:
    """One progress row per batch, in a file of their own."""
    rows = [(table, run_id, b, status, at) for b in batches]
    frame = store.spark.createDataFrame(rows, control.PROGRESS_SCHEMA).coalesce(1)
    store.append(frame, META, PROGRESS, table, f"{run_id}-{status}-{batches[0]}-{uuid.uuid4().hex[:8]}")


def open_run(store: TableStore, table: str) -> tuple[str, dt.datetime] | None:
    """``(run_id, extraction instant)`` of the latest run with a manifest and no end, if any."""
    ends = read_progress(store, table).where(F.col("batch_no") == WHOLE_RUN)
    closed = ends.where(F.col("status") != "started").select("run_id")
    begun = ends.where(F.col("status") == "started").join(closed, "run_id", "left_anti")
    row = begun.orderBy(F.desc("updated_at"), "run_id").limit(1).collect()
    return (row[0]["run_id"], row[0]["updated_at"]) if row else None


def close_run(store: TableStore, table: str, run_id: str, status: str, at: dt.datetime) -> None:
    record(store, table, run_id, [WHOLE_RUN], status, at)


def begin(store: TableStore, delta: DataFrame, table: str, run_id: str, date_col: str, key: str, rows: int, at: dt.datetime,
          batch_rows: int = ingest.CHUNK_ROWS, max_batches: int = MAX_BATCHES) -> None:
    """Store the manifest of ``delta``; ``batch_rows`` grows so that there are at most ``max_batches``."""
    size = max(batch_rows, -(-rows // max_batches))
    bounds = ingest.keyset_manifest(delta.select(date_col, key), date_col, key, size)
    text = lambda c: F.col(c).cast("string").alias(c)
    when = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    manifest = bounds.select(F.lit(table).alias("table_name"), F.lit(run_id).alias("run_id"), "batch_no", when("lo_date"), text("lo_id"),
                             when("hi_date"), text("hi_id"), "rows")
    store.append(manifest.coalesce(1), META, MANIFEST, table, run_id)
    record(store, table, run_id, [WHOLE_RUN], "started", at)


def staging(store: TableStore, layer: str, table: str, run_id: str) -> str:
    return f"{store.root}/staging/{layer}/{table}/v={run_id}"


def _storable(rows: DataFrame) -> DataFrame:
    """Columns without a type as text: files hold no void."""
    return rows.withColumns({f.name: F.col(f.name).cast("string") for f in rows.schema.fields if isinstance(f.dataType, T.NullType)})


def land(store: TableStore, delta: DataFrame, layer: str, table: str, run_id: str) -> DataFrame:
    """One read of ``delta``: its rows as they were written under the run's staging folder."""
    path, rows = f"{staging(store, layer, table, run_id)}/_landed/{uuid.uuid4().hex}", _storable(delta)
    rows.write.parquet(path)
    return store.spark.read.schema(rows.schema).parquet(path)


def _job_of(source: DataFrame, waves: list[list[dict]], date_col: str, key: str) -> Column:
    """The wave a row can belong to, from 0: the last one whose lower bound is not above the row's (date, id)."""
    kind = source.schema[key].dataType
    lows = F.array(*[F.struct(ts_lit(w[0]["lo_date"]).alias("date"), F.lit(w[0]["lo_id"]).cast(kind).alias("id")) for w in waves])
    row = F.struct(F.col(date_col).cast("timestamp_ntz").alias("date"), F.col(key).alias("id"))
    return F.greatest(F.size(F.filter(lows, lambda low: low <= row)), F.lit(1)) - 1


def deal(source: DataFrame, waves: list[list[dict]], date_col: str, key: str, path: str) -> DataFrame:
    """One read of ``source``: its rows in the dates of ``waves``, written to ``path`` by wave and read back with ``JOB``.

    A wave's rows are spread over as many tasks as it has batches. Rows
    between the bounds of batches come along; each wave leaves them out.
    """
    span = F.col(date_col).between(ts_lit(min(b["lo_date"] for w in waves for b in w)), ts_lit(max(b["hi_date"] for w in waves for b in w)))
    rows = _storable(source.where(span))  # the span reaches the scan
    spread = F.pmod(F.xxhash64(key), F.lit(max(len(w) for w in waves)))
    rows.withColumn(JOB, _job_of(rows, waves, date_col, key)).repartition(JOB, spread).write.partitionBy(JOB).parquet(path)
    schema = T.StructType([*rows.schema.fields, T.StructField(JOB, T.IntegerType())])
    return source.sparkSession.read.schema(schema).parquet(path)


def extract_pending(store: TableStore, source: DataFrame, clean: Callable[[DataFrame], DataFrame], layer: str, table: str, run_id: str,
                    date_col: str, key: str, per_job: int = BATCHES_PER_JOB,
                    on_batches: Callable[[list[int]], None] | None = None,
                    on_seen: Callable[[int, dict], None] | None = None) -> list[int]:
    """Extract the run's batches that have no progress row yet; returns their numbers.

    ``source`` (landed rows, or the source itself when a run is taken up) is
    read once, however many batches there are (see ``deal``).
    ``clean`` maps source rows to what is staged; boolean columns it names
    ``_seen_...`` are counted during the write (given to ``on_seen``), not
    staged. ``on_batches`` is told the batches a job is about to read.
    """
    manifest = read_manifest(store, table).where(F.col("run_id") == run_id)
    todo = control.pending_batches(manifest, read_progress(store, table)).orderBy("batch_no").collect()  # at most MAX_BATCHES rows
    waves = [[r.asDict() for r in todo[at: at + per_job]] for at in range(0, len(todo), per_job)]
    folder = staging(store, layer, table, run_id)
    dealt = deal(source, waves, date_col, key, f"{folder}/_dealt/{uuid.uuid4().hex}") if waves else source
    for job, wave in enumerate(waves):
        if on_batches:
            on_batches([b["batch_no"] for b in wave])
        number = F.lit(None).cast("int")
        for b in wave:
            number = F.when(ingest.in_batch(dealt, b, date_col, key), F.lit(b["batch_no"])).otherwise(number)
        mine = dealt.where(F.col(JOB) == job).drop(JOB)
        out = clean(mine.withColumn(BATCH, number).where(F.col(BATCH).isNotNull()))
        flags = [c for c in out.columns if c.startswith(SEEN)]
        seen = Observation(f"extract-{uuid.uuid4().hex}")
        kept = out.observe(seen, *[F.count_if(F.col(c)).alias(c) for c in flags]).drop(*flags) if flags else out
        kept.write.mode("overwrite").partitionBy(BATCH).parquet(f"{folder}/job={wave[0]['batch_no']}")
        if flags and on_seen:
            on_seen(wave[0]["batch_no"], seen.get)
        record(store, table, run_id, [b["batch_no"] for b in wave], "completed", _now())
    return [r["batch_no"] for r in todo]


def staged_rows(store: TableStore, layer: str, table: str, run_id: str) -> DataFrame:
    """All batches of a run as they were staged."""
    return store.spark.read.parquet(staging(store, layer, table, run_id)).drop("job", BATCH)


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
