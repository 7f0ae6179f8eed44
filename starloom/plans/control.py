"""Ingestion control plane: watermarks, the full-or-incremental decision,
run log, batch resume and the gated publish of table versions.

Control tables are small (one row per source table or run) but are still
DataFrames: decisions are one vectorised ``CASE`` over all tables, and the
driver only reads the handful of rows it must act on.

The watermark is derived state: the run log is the record, so a crash between
publish and log only makes the next run read the same rows again.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.keys import ts_lit
from starloom.operators import quality
from starloom.session import ensure_checkpoint_dir

# Decision limits.
MAX_FAILURES = 3
MAX_FULL_LOAD_AGE_DAYS = 30
LOG_RETENTION_DAYS = 30
FAILED_STATUSES = ("failed", "quality_failed")

WATERMARK_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("last_extracted_date", T.TimestampNTZType()),
    T.StructField("total_rows", T.LongType()),
    T.StructField("last_full_load", T.TimestampNTZType()),
    T.StructField("last_successful_extraction", T.TimestampNTZType()),
    T.StructField("consecutive_failures", T.IntegerType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

LOG_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("table_name", T.StringType(), False),
    T.StructField("extraction_type", T.StringType(), False),
    T.StructField("start_time", T.TimestampNTZType(), False),
    T.StructField("end_time", T.TimestampNTZType()),
    T.StructField("last_extracted_date", T.TimestampNTZType()),
    T.StructField("rows_extracted", T.LongType()),
    T.StructField("rows_inserted", T.LongType()),
    T.StructField("rows_updated", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
])

MANIFEST_SCHEMA = "table_name string, run_id string, batch_no int, lo_date timestamp_ntz, lo_id string, " \
                  "hi_date timestamp_ntz, hi_id string, rows bigint"
PROGRESS_SCHEMA = "table_name string, run_id string, batch_no int, status string, updated_at timestamp_ntz"


def _ts(v) -> Column:
    return ts_lit(v)


def empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


# ------------------------------------------------------------- watermarks

def watermarks_from_log(log: DataFrame) -> DataFrame:
    """Watermark table derived from the run log.

    Per table: the high-water mark of completed runs (max, so it never moves
    back), rows inserted, last full load, last success, and the failures
    since the last success.
    """
    ok = F.col("status") == "completed"
    per = log.groupBy("table_name").agg(
        F.max(F.when(ok, F.col("last_extracted_date"))).alias("last_extracted_date"),
        F.sum(F.when(ok, F.col("rows_inserted"))).alias("total_rows"),
        F.max(F.when(ok & (F.col("extraction_type").startswith("full")), F.col("start_time"))).alias("last_full_load"),
        F.max(F.when(ok, F.col("end_time"))).alias("last_successful_extraction"),
        F.max(F.when(ok, F.col("start_time"))).alias("_last_ok_start"),
        F.max(F.coalesce(F.col("end_time"), F.col("start_time"))).alias("updated_at"),
    )
    fails = log.where(F.col("status").isin(*FAILED_STATUSES)).select("table_name", F.col("start_time").alias("_fs"))
    counted = fails.join(per.select("table_name", "_last_ok_start"), "table_name") \
        .where(F.col("_last_ok_start").isNull() | (F.col("_fs") > F.col("_last_ok_start"))) \
        .groupBy("table_name").agg(F.count(F.lit(1)).cast("int").alias("consecutive_failures"))
    return per.join(counted, "table_name", "left").select(
        "table_name", "last_extracted_date", F.col("total_rows").cast("bigint").alias("total_rows"), "last_full_load",
        "last_successful_extraction", F.coalesce("consecutive_failures", F.lit(0)).alias("consecutive_failures"),
        "updated_at")


def high_water_mark(df: DataFrame, date_col: str, floor=None) -> DataFrame:
    """One row: the max tracking date (NULLs ignored), never below ``floor``."""
    m = F.max(F.col(date_col))
    if floor is not None:
        m = F.greatest(m, _ts(floor))
    return df.agg(m.alias("high_water_mark"))


def advance_watermark(watermarks: DataFrame, results: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Apply run results to the watermark table (upsert on ``table_name``).

    ``results``: table_name, status, max_date, rows_inserted, full (bool).
    Success: date = greatest(old, new) (a NULL new date keeps the old one),
    rows added, failures reset. Failure: failures + 1 and the date kept; a
    first-ever failure inserts a row with NULL date, which forces a full
    load next time.
    """
    now = _ts(run_ts)
    r = results.select(F.col("table_name"), F.col("status").alias("_status"), F.col("max_date").alias("_max"),
                       F.col("rows_inserted").alias("_ins"), F.col("full").alias("_full"))
    j = watermarks.join(r, "table_name", "full_outer")
    ran = F.col("_status").isNotNull()
    ok = F.col("_status") == "completed"
    failed = ran & ~ok
    return j.select(
        "table_name",
        F.when(ok & F.col("_full"), F.col("_max"))
        .when(ok, F.coalesce(F.greatest(F.col("last_extracted_date"), F.col("_max")), F.col("last_extracted_date"),
                             F.col("_max")))
        .otherwise(F.col("last_extracted_date")).alias("last_extracted_date"),
        F.when(ok & F.col("_full"), F.col("_ins"))
        .when(ok, F.coalesce(F.col("total_rows"), F.lit(0)) + F.coalesce(F.col("_ins"), F.lit(0)))
        .otherwise(F.col("total_rows")).cast("bigint").alias("total_rows"),
        F.when(ok & F.col("_full"), now).otherwise(F.col("last_full_load")).alias("last_full_load"),
        F.when(ok, now).otherwise(F.col("last_successful_extraction")).alias("last_successful_extraction"),
        F.when(ok, F.lit(0)).when(failed, F.coalesce(F.col("consecutive_failures"), F.lit(0)) + 1)
        .otherwise(F.col("consecutive_failures")).cast("int").alias("consecutive_failures"),
        F.when(ran, now).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def load_plan(tables: DataFrame, watermarks: DataFrame, now: dt.datetime, max_failures: int = MAX_FAILURES,
              max_age_days: int = MAX_FULL_LOAD_AGE_DAYS) -> DataFrame:
    """Full-or-incremental decision for every configured table, with the reason.

    ``tables``: table_name, exists (the target is published). First match
    wins: missing table → no watermark → failures ≥ max → last full load at
    least ``max_age_days`` whole days ago → incremental. A NULL last full
    load never ages.
    """
    days = F.floor((F.unix_micros(_ts(now).cast("timestamp"))
                    - F.unix_micros(F.col("last_full_load").cast("timestamp"))) / F.lit(86_400_000_000))
    j = tables.join(watermarks, "table_name", "left")
    reason = (
        F.when(~F.coalesce(F.col("exists"), F.lit(False)), F.lit("table_missing"))
        .when(F.col("last_extracted_date").isNull(), F.lit("no_watermark"))
        .when(F.coalesce(F.col("consecutive_failures"), F.lit(0)) >= max_failures, F.lit("too_many_failures"))
        .when(F.col("last_full_load").isNotNull() & (days >= max_age_days), F.lit("full_load_expired"))
        .otherwise(F.lit("incremental"))
    )
    return j.select(
        "table_name",
        F.when(reason == "incremental", F.lit("incremental")).otherwise(F.lit("full")).alias("mode"),
        reason.alias("reason"),
        F.col("last_extracted_date").alias("watermark"),
    )


# ---------------------------------------------------------------- run log

def log_entry(spark: SparkSession, table: str, extraction_type: str, start: dt.datetime, end: dt.datetime,
              extracted: int, inserted: int, updated: int, status: str, last_date=None,
              error: str | None = None, entry_id: int | None = None) -> DataFrame:
    """One log row; ``start`` is the real run start (not the log instant)."""
    row = (entry_id, table, extraction_type, start, end, last_date, extracted, inserted, updated, status, error, end)
    return spark.createDataFrame([row], LOG_SCHEMA)


def append_log(log: DataFrame, entry: DataFrame) -> DataFrame:
    return log.unionByName(entry.select(*log.columns))


def log_retention(log: DataFrame, now: dt.datetime, days: int = LOG_RETENTION_DAYS) -> DataFrame:
    """Log rows created within the last ``days`` (older ones are dropped)."""
    return log.where(F.col("created_at") >= _ts(now - dt.timedelta(days=days)))


def last_updated(log: DataFrame) -> DataFrame:
    """Per table: the end of its latest successful run."""
    return log.where(F.col("status") == "completed").groupBy("table_name") \
        .agg(F.max("end_time").alias("last_updated"))


# ------------------------------------------------------------ batch resume

def pending_batches(manifest: DataFrame, progress: DataFrame) -> DataFrame:
    """Manifest batches not yet completed (resume point of a failed run)."""
    done = progress.where(F.col("status") == "completed").select("table_name", "run_id", "batch_no")
    return manifest.join(done, ["table_name", "run_id", "batch_no"], "left_anti")


# ---------------------------------------------------------- gated publish

MAX_RECORDS_PER_FILE = 5_000_000
BUCKET = "_bucket"
POINTER_SCHEMA = ("seq bigint, path string, high_water_mark string, batch_id bigint, "
                  "published_at timestamp_ntz, stream string, run_id string, buckets int, schema string, "
                  "stage string, touched array<int>")
META, GATE_HISTORY = "metadata", "quality_checks"
GATE_SCHEMA = ("table_name string, run_id string, checked_at timestamp_ntz, gate string, subject string, value double, "
               "threshold double, status string")


class TableStore:
    """Versioned Parquet tables under a shared root with a pointer log.

    ``root/<layer>/<table>/v=<run_id>/`` holds a version. ``_pointers/`` is a
    small append-only Parquet log, one row per publish; the current version
    is its highest ``seq``. Writing a version never touches the published
    one, and publishing is one Spark append (a committed file or none), so
    any file system the cluster uses works. The root defaults to a folder
    under ``spark.checkpoint.dir`` (shared storage on a cluster). Versions
    dealt into hash buckets, and changes to single buckets, are written by
    ``plans.buckets``; ``read`` shows them.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or ensure_checkpoint_dir(spark).rstrip("/") + "/starloom-tables"

    def _dir(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def _pointer_dir(self, layer: str, table: str) -> str:
        return f"{self._dir(layer, table)}/_pointers"

    def _has_pointers(self, layer: str, table: str) -> bool:
        return self._exists(self._pointer_dir(layer, table))

    def _exists(self, folder: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return fs.exists(path)

    def pointer(self, layer: str, table: str) -> dict | None:
        if not self._has_pointers(layer, table):
            return None
        log = self.spark.read.schema(POINTER_SCHEMA).parquet(self._pointer_dir(layer, table))
        row = log.orderBy(F.desc("seq")).limit(1).collect()
        return row[0].asDict() if row else None

    def exists(self, layer: str, table: str) -> bool:
        return self.pointer(layer, table) is not None

    def read(self, layer: str, table: str) -> DataFrame | None:
        """The published rows. While staged buckets are being copied into a version, they are read from their stage."""
        ptr = self.pointer(layer, table)
        if ptr is None:
            return None
        if ptr["buckets"] is None:
            return self.spark.read.parquet(ptr["path"])
        return self.read_buckets(ptr).drop(BUCKET)

    def read_buckets(self, ptr: dict) -> DataFrame:
        """A bucketed version as ``ptr`` names it, with the bucket number of every row."""
        schema = T.StructType.fromJson(json.loads(ptr["schema"]))
        rows = self.spark.read.schema(schema).parquet(ptr["path"])
        if ptr["stage"] is None:
            return rows
        staged = self.spark.read.schema(schema).parquet(ptr["stage"])
        return rows.where(~F.col(BUCKET).isin(ptr["touched"])).unionByName(staged)

    def stage(self, df: DataFrame, layer: str, table: str, run_id: str | None = None,
              sort_within: list[str] | None = None, max_records_per_file: int = MAX_RECORDS_PER_FILE) -> str:
        """Write a version. ``sort_within`` orders rows inside each task (no
        shuffle) so Parquet row-group statistics on those columns are tight
        and later range predicates (``date > watermark``) skip row groups;
        ``max_records_per_file`` bounds file size."""
        run_id = run_id or uuid.uuid4().hex
        path = f"{self._dir(layer, table)}/v={run_id}"
        out = df.sortWithinPartitions(*sort_within) if sort_within else df
        out.write.mode("overwrite").option("maxRecordsPerFile", str(max_records_per_file)).parquet(path)
        return path

    def append(self, rows: DataFrame, layer: str, name: str, table: str, run_id: str) -> None:
        """Add a run's rows about ``table`` to the log ``name``, in a folder that no other run writes."""
        rows.write.mode("errorifexists").parquet(f"{self._dir(layer, name)}/{table}/{run_id}")

    def read_appended(self, layer: str, name: str, schema, table: str | None = None) -> DataFrame:
        """All rows of the log ``name``, or those about one table."""
        folder = f"{self._dir(layer, name)}/{table}" if table else self._dir(layer, name)
        if not self._exists(folder):
            return empty(self.spark, schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(folder)

    def last_batch(self, layer: str, table: str, stream: str) -> int:
        """The last batch that ``stream`` published, -1 before its first."""
        if not self._has_pointers(layer, table):
            return -1
        log = self.spark.read.schema(POINTER_SCHEMA).parquet(self._pointer_dir(layer, table))
        last = log.where(F.col("stream") == stream).agg(F.max("batch_id")).first()[0]
        return -1 if last is None else int(last)

    def publish(self, layer: str, table: str, path: str, high_water_mark=None, batch_id: int | None = None,
                stream: str | None = None, run_id: str | None = None, buckets: int | None = None,
                schema: T.StructType | None = None, stage: str | None = None, touched: list[int] | None = None) -> None:
        ptr = self.pointer(layer, table)
        seq = 0 if ptr is None else ptr["seq"] + 1
        row = (seq, path, None if high_water_mark is None else str(high_water_mark), batch_id,
               dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), stream, run_id, buckets,
               None if schema is None else schema.json(), stage, touched)
        self.spark.createDataFrame([row], POINTER_SCHEMA).coalesce(1).write.mode("append") \
            .parquet(self._pointer_dir(layer, table))

    def pointers(self, layer: str, table: str) -> DataFrame:
        """The pointer log of one table (empty before its first publish)."""
        if not self._has_pointers(layer, table):
            return empty(self.spark, POINTER_SCHEMA)
        return self.spark.read.schema(POINTER_SCHEMA).parquet(self._pointer_dir(layer, table))


def keep_verdicts(store: TableStore, table: str, run_id: str, verdicts: list[dict]) -> None:
    """Gate history: the verdicts of a run, whether it published or not."""
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows = [(table, run_id, now, v["gate"], v["subject"], v["value"], v["threshold"], v["status"]) for v in verdicts]
    store.append(store.spark.createDataFrame(rows, GATE_SCHEMA).coalesce(1), META, GATE_HISTORY, table, run_id)


def read_verdicts(store: TableStore, table: str | None = None) -> DataFrame:
    """Gate history of one table, or of all."""
    return store.read_appended(META, GATE_HISTORY, GATE_SCHEMA, table)


def enforce(store: TableStore, table: str, run_id: str, verdicts: DataFrame) -> list[dict]:
    """Record the verdicts of a run, then raise on the first failed gate."""
    rows = [r.asDict() for r in verdicts.collect()]  # a few rows per table
    keep_verdicts(store, table, run_id, rows)
    return quality.raise_failed(rows)


def observed_metrics(critical: list[str]) -> list[Column]:
    """Gate metrics that a write can measure on its way (all but distinct ids)."""
    return [F.count(F.lit(1)).alias("dw_rows"), *[F.count_if(F.col(c).isNull()).alias(f"nulls__{c}") for c in critical]]


def gated_publish(store: TableStore, df: DataFrame, layer: str, table: str, source_rows: DataFrame,
                  critical: list[str] = (), run_id: str | None = None, high_water_mark=None,
                  id_col: str = "id", sort_within: list[str] | None = None) -> tuple[DataFrame, list[dict]]:
    """Stage → gate → publish. Gates judge what was written; a failing gate
    raises and the published version stays as it was.

    Rows and NULL counts are observed while the version is written; only the
    distinct ids need a second scan, of the id column alone.
    """
    run_id = run_id or uuid.uuid4().hex
    seen = Observation(f"staged-{run_id}")
    path = store.stage(df.observe(seen, *observed_metrics(list(critical))), layer, table, run_id, sort_within)
    ids = store.spark.read.schema(df.select(id_col).schema).parquet(path).agg(F.count_distinct(F.col(id_col)).alias("unique_ids"))
    metrics = ids.withColumns({name: F.lit(value).cast("bigint") for name, value in seen.get.items()})
    rows = enforce(store, table, run_id, quality.verdicts_of(metrics, table, source_rows, list(critical)))
    store.publish(layer, table, path, high_water_mark, run_id=run_id)
    return store.read(layer, table), rows
