"""One table's nightly load: decide, extract, clean, upsert, gate, publish, record.

``load_table`` strings the operators together the way the per-table
ingestion job does:

1. the load plan (full or incremental, with the reason) from the published
   table and the table's watermark;
2. full: the whole source, cleaned and cast in one pass, as a new version
   dealt into hash buckets (an empty source is skipped, never published);
   incremental: rows changed after the watermark are counted with the source,
   landed in one read of it and extracted in batches by a stored manifest
   (``plans.resume``), so a killed run is taken up where it stopped, and
   merged into the buckets they touch (``plans.buckets``); nothing is
   published when nothing changed;
3. both paths turn NULL tokens, infinities and NaN into NULL and cast to the
   given types, incremental batches also to the table's own; rejected values
   are counted per column while rows are written, and kept with the run;
4. gates on what was staged; a failing gate leaves the published version
   and the watermark date untouched and counts a failure; all verdicts are
   kept;
5. one row in the run log, in a folder of the run's own.

Loads of different tables share no file, so any number can run at once.
Watermarks are derived from the run log: a crash between publish and log
leaves the old watermark, and the next run upserts the same rows again.

All data work is Spark jobs; the driver reads only one-row frames (plan,
profile, counts, verdicts) and manifest rows.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.clean import cast_flagged, sanitize
from starloom.operators import quality
from starloom.operators.upsert import DeltaKeyError
from starloom.plans import buckets, control, resume
from starloom.plans.control import META
from starloom.sources import ingest

RUN_LOG = "extraction_log"
REJECTS = "cast_rejects"
REJECT_SCHEMA = "table_name string, run_id string, column string, target_type string, rejected bigint"


def _utcnow() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def read_log(store: control.TableStore, table: str | None = None) -> DataFrame:
    """Run log of one table, or of all (rows that a compaction has left twice are read once)."""
    return store.read_appended(META, RUN_LOG, control.LOG_SCHEMA, table).dropDuplicates()


def read_rejects(store: control.TableStore, table: str | None = None) -> DataFrame:
    """Values that no run could cast, counted per run and column (only counts above 0)."""
    return store.read_appended(META, REJECTS, REJECT_SCHEMA, table)


def read_watermarks(store: control.TableStore, table: str | None = None) -> DataFrame:
    """Watermarks from the run log, each table's runs taken from its last completed full load on.

    Runs that skipped an empty source leave no trace.
    """
    log = read_log(store, table).where(F.col("status") != "skipped_empty")
    full = (F.col("status") == "completed") & (F.col("extraction_type") == "full")
    since = log.groupBy("table_name").agg(F.max(F.when(full, F.col("start_time"))).alias("_since"))
    recent = log.join(since, "table_name").where(F.col("_since").isNull() | (F.col("start_time") >= F.col("_since")))
    return control.watermarks_from_log(recent.drop("_since"))


def load_table(store: control.TableStore, table: str, source: DataFrame, date_col: str | None = None, key: str = "id",
               critical: list[str] | None = None, source_name: str = "erp_source", layer: str = "raw",
               types: dict[str, str] | None = None, run_ts: dt.datetime | None = None, max_failures: int = control.MAX_FAILURES,
               max_age_days: int = control.MAX_FULL_LOAD_AGE_DAYS, n_buckets: int | None = None, batch_rows: int = ingest.CHUNK_ROWS,
               batches_per_job: int = resume.BATCHES_PER_JOB, on_batches: Callable[[list[int]], None] | None = None) -> dict:
    """Run one load of ``table`` from ``source``; returns the run summary.

    ``date_col`` and ``critical`` default to the table's configuration
    (``ingest.TRACKING_COLUMN``, ``ingest.CRITICAL_COLUMNS``), ``n_buckets`` of a
    new version to its rows. ``types`` names the warehouse types of columns
    to cast. ``on_batches`` is told which batches a job is about to read. One
    load of a table runs at a time; loads of different tables are independent.
    Raises ``quality.DataQualityError`` (after recording the failure) when a
    gate fails, and ``DeltaKeyError`` when the delta has NULL keys.
    """
    if date_col is None and table not in ingest.TRACKING_COLUMN:
        raise ValueError(f"no tracking column is configured for {table}: name one")
    date_col = date_col or ingest.TRACKING_COLUMN[table]
    critical = ingest.CRITICAL_COLUMNS.get(table, []) if critical is None else list(critical)
    run_ts, started, run_id = run_ts or _utcnow(), _utcnow(), uuid.uuid4().hex
    spark = store.spark
    tables = spark.createDataFrame([(table, store.exists(layer, table))], "table_name string, exists boolean")
    plan = control.load_plan(tables, read_watermarks(store, table), run_ts, max_failures, max_age_days).first()
    full = plan["mode"] == "full"
    summary = {"table": table, "mode": plan["mode"], "reason": plan["reason"], "run_id": run_id, "resumed": False, "batches": 0,
               "touched_buckets": 0, "extracted": 0, "inserted": 0, "updated": 0, "status": "completed", "max_date": None}
    attempt, error = run_id, None
    try:
        n_source, n_changed = (source.count(), 0) if full else _counts(source, date_col, plan["watermark"])
        source_rows = spark.createDataFrame([(n_source,)], "source_rows bigint")
        before = resume.open_run(store, table)
        if full and before:
            resume.close_run(store, table, before[0], "abandoned", _utcnow())
        if full and n_source == 0:
            # an empty source never replaces a table: nothing is published and the
            # watermark is left as it is; the run is only logged
            summary["status"] = "skipped_empty"
        elif full:
            snap, flags = cast_flagged(sanitize(ingest.full_snapshot(source, table, run_ts, source_name)), types or {})
            change, seen = buckets.publish_version(
                store, snap, layer, table, key, n_buckets or buckets.buckets_for(n_source), source_rows, critical, run_id, date_col,
                [date_col], observe={n: F.count_if(F.col(n)) for n in flags})
            _keep_rejects(store, table, run_id, run_id, flags, seen)
            summary.update(extracted=change.rows, inserted=change.rows, max_date=change.max_date, touched_buckets=change.touched)
        else:
            changed = ingest.incremental_scan(source, date_col, plan["watermark"])
            if before:
                (run_id, run_ts), summary["resumed"] = before, True
                summary["run_id"] = run_id
            elif n_changed:
                changed = resume.land(store, changed, layer, table, run_id)
                n_changed = _profile(changed, table, key)
                if n_changed:
                    resume.begin(store, changed, table, run_id, date_col, key, n_changed, run_ts, batch_rows)
            if before or n_changed:
                _extract(store, changed, layer, table, run_id, date_col, key, source_name, run_ts, types or {}, batches_per_job, on_batches, summary)
                delta = resume.staged_rows(store, layer, table, run_id)
                change = _merge(store, delta, layer, table, key, date_col, source_rows, critical, attempt, n_source, n_buckets)
                summary.update(inserted=change.inserts, updated=change.updates, max_date=change.max_date, touched_buckets=change.touched)
                resume.close_run(store, table, run_id, "published", _utcnow())
    except (quality.DataQualityError, DeltaKeyError) as exc:
        summary["status"] = "quality_failed" if isinstance(exc, quality.DataQualityError) else "failed"
        error = exc
        if resume.open_run(store, table):  # what was staged is bad: the next run extracts anew
            resume.close_run(store, table, run_id, "abandoned", _utcnow())
    except Exception as exc:  # noqa: BLE001 - any failed run is counted, then re-raised
        summary["status"] = "failed"
        error = exc
    try:
        _log(store, table, summary, full, started, None if error is None else str(error), attempt)
    except Exception as log_error:  # noqa: BLE001 - the load's own error comes first
        if error is None:
            raise
        error.add_note(f"the run log was not written: {log_error}")
    if error is not None:
        raise error
    return summary


def _counts(source: DataFrame, date_col: str, watermark) -> tuple[int, int]:
    """Rows of the source and those changed after the watermark, in one read."""
    found = ingest.delta_profile(source, date_col, watermark).first()
    return found["total_rows"], found["modified_rows"]


def _profile(changed: DataFrame, table: str, key: str) -> int:
    """Changed rows; raises when one of them has no key (no manifest could hold it)."""
    found = changed.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(key).isNull()).alias("null_keys")).first()
    if found["null_keys"]:
        raise DeltaKeyError(f"{table}: {found['null_keys']} delta rows without {key}")
    return found["rows"]


def _extract(store: control.TableStore, changed: DataFrame, layer: str, table: str, run_id: str, date_col: str, key: str, source_name: str,
             run_ts: dt.datetime, types: dict[str, str], batches_per_job: int, on_batches, summary: dict) -> None:
    """Stage the run's pending batches: cleaned, sanitised, cast to ``types`` and the table's own."""
    current = store.read(layer, table)
    table_types = {f.name: f.dataType for f in current.schema.fields}
    flags: dict[str, tuple[str, str]] = {}

    def clean(rows: DataFrame) -> DataFrame:
        out = sanitize(ingest.clean_batch(rows, table, run_ts, source_name))
        own = {f.name: table_types[f.name] for f in out.schema.fields if table_types.get(f.name, f.dataType) != f.dataType}
        cast, found = cast_flagged(out, {**types, **own})
        flags.update(found)
        return cast

    done = resume.extract_pending(store, changed, clean, layer, table, run_id, date_col, key, batches_per_job, on_batches,
                                  lambda job, seen: _keep_rejects(store, table, run_id, f"{run_id}-{job}-{uuid.uuid4().hex[:8]}", flags, seen))
    mine = resume.read_manifest(store, table).where(F.col("run_id") == run_id)
    summary.update(batches=len(done), extracted=mine.agg(F.sum("rows")).first()[0])


def _merge(store: control.TableStore, delta: DataFrame, layer: str, table: str, key: str, date_col: str, source_rows: DataFrame,
           critical: list[str], run_id: str, n_source: int, n_buckets: int | None) -> buckets.Change:
    if store.pointer(layer, table)["buckets"] is None:  # a version written without buckets is dealt into them first
        buckets.publish_version(store, store.read(layer, table), layer, table, key, n_buckets or buckets.buckets_for(n_source), None,
                                critical, f"{run_id}-dealt", date_col, [date_col])
    return buckets.apply_delta(store, delta, layer, table, key, date_col, source_rows, critical, run_id, date_col, [date_col])


def _keep_rejects(store: control.TableStore, table: str, run_id: str, part: str, flags: dict[str, tuple[str, str]], seen: dict) -> None:
    """Rejected values that a write has counted, one row per column (only counts above 0)."""
    rows = [(table, run_id, column, kind, int(seen[name])) for name, (column, kind) in flags.items() if seen.get(name)]
    if rows:
        store.append(store.spark.createDataFrame(rows, REJECT_SCHEMA).coalesce(1), META, REJECTS, table, part)


def _log(store: control.TableStore, table: str, summary: dict, full: bool, started: dt.datetime,
         error: str | None, attempt: str) -> None:
    """One row of the run log; its id is taken from the attempt's."""
    ok = summary["status"] == "completed"
    entry = control.log_entry(store.spark, table, "full" if full else "incremental", started, _utcnow(),
                              int(summary["extracted"]), int(summary["inserted"]) if ok else 0,
                              int(summary["updated"]) if ok else 0, summary["status"],
                              summary["max_date"] if ok else None, error, int(attempt[:15], 16))
    store.append(entry.coalesce(1), META, RUN_LOG, table, attempt)
