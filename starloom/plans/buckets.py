"""Tables dealt into hash buckets of their key, changed bucket by bucket.

A version is one folder, partitioned by ``_bucket``: the key's hash modulo the
number of buckets, which the first write fixes. A change is merged with the
buckets its keys fall into and with nothing else:

1. the rows of the touched buckets (partition pruning) and the delta are merged
   and written to a stage of the run's own, partitioned alike;
2. gates judge the whole table from metrics per bucket: those of the touched
   buckets are measured on the stage, those of all others were kept when they
   were written. A key lives in one bucket, so distinct keys add up;
3. a failing gate leaves version and pointer as they were. Else one appended
   pointer row names the stage and the touched buckets: the change is
   published, and readers take these buckets from the stage;
4. the touched partitions of the version are overwritten from the stage
   (dynamic partition overwrite), and a second pointer row says so.

Step 4 reads the stage only, so a run that dies in it is finished by the next
writer, or begun again, with the same result. One writer per table at a time;
a reader that holds files of an overwritten bucket must read again.
Untouched buckets are neither read nor written. Rows without a key are dealt
by their content.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators import quality
from starloom.operators.upsert import OP, align_to, latest_per_key, merge, widen
from starloom.plans import control
from starloom.plans.control import BUCKET, MAX_RECORDS_PER_FILE, TableStore

ROWS_PER_BUCKET = 1_000_000
STATS = "_stats"
STATS_SCHEMA = "bucket int, rows bigint, unique_ids bigint, nulls map<string,bigint>"


@dataclass(frozen=True)
class Change:
    """What a run did to a table."""

    rows: int
    inserts: int
    updates: int
    max_date: object
    touched: int
    verdicts: list[dict]


def bucket_of(key: str, buckets: int) -> Column:
    content = F.xxhash64(F.to_json(F.struct("*")))
    hashed = F.when(F.col(key).isNotNull(), F.xxhash64(F.col(key))).otherwise(content)
    return F.pmod(hashed, F.lit(buckets)).cast("int")


def buckets_for(rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    return max(1, -(-rows // rows_per_bucket))


def _write(df: DataFrame, path: str, sort_within: list[str], dynamic: bool = False) -> None:
    """Write rows by bucket; ``sort_within`` orders each bucket, so row groups have tight bounds."""
    out = df.write.mode("overwrite").partitionBy(BUCKET).option("maxRecordsPerFile", str(MAX_RECORDS_PER_FILE))
    if dynamic:
        out = out.option("partitionOverwriteMode", "dynamic")
    out.parquet(path)


def _sorted(df: DataFrame, sort_within: list[str]) -> DataFrame:
    return df.repartition(BUCKET).sortWithinPartitions(BUCKET, *sort_within)


def measure(staged: DataFrame, key: str, critical: list[str]) -> DataFrame:
    """``bucket, rows, unique_ids, nulls``: one scan of the key and the critical columns."""
    nulls = F.map_from_arrays(F.array(*[F.lit(c) for c in critical]).cast("array<string>"),
                              F.array(*[F.count_if(F.col(c).isNull()) for c in critical]).cast("array<bigint>"))
    return staged.groupBy(F.col(BUCKET).alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(F.col(key)).alias("unique_ids"), nulls.alias("nulls"))


def _stats_path(store: TableStore, layer: str, table: str, run_id: str) -> str:
    return f"{store.root}/{layer}/{table}/{STATS}/run={run_id}"


def _keep_stats(store: TableStore, stats: DataFrame, layer: str, table: str, run_id: str) -> DataFrame:
    path = _stats_path(store, layer, table, run_id)
    stats.coalesce(1).write.mode("overwrite").parquet(path)  # one row per bucket
    return store.spark.read.schema(STATS_SCHEMA).parquet(path)


def bucket_stats(store: TableStore, layer: str, table: str) -> DataFrame:
    """The kept metrics of every bucket of the published version: its latest published run's."""
    ptr = store.pointer(layer, table)
    runs = (store.pointers(layer, table).where(F.col("path") == ptr["path"]).groupBy("run_id").agg(F.max("seq").alias("seq"))
            .where("run_id is not null").collect())  # one row per run on this version
    if not runs:
        return control.empty(store.spark, STATS_SCHEMA)
    found = None
    for r in runs:
        part = store.spark.read.schema(STATS_SCHEMA).parquet(_stats_path(store, layer, table, r["run_id"])).withColumn("seq", F.lit(r["seq"]))
        found = part if found is None else found.unionByName(part)
    row = F.struct("rows", "unique_ids", "nulls")
    return found.groupBy("bucket").agg(F.max_by(row, "seq").alias("s")).select("bucket", "s.*")


def _totals(stats: DataFrame, critical: list[str]) -> DataFrame:
    """One row of gate metrics for the whole table."""
    return stats.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("dw_rows"), F.coalesce(F.sum("unique_ids"), F.lit(0)).alias("unique_ids"),
                     *[F.coalesce(F.sum(F.col("nulls")[c]), F.lit(0)).alias(f"nulls__{c}") for c in critical])


def publish_version(store: TableStore, df: DataFrame, layer: str, table: str, key: str, buckets: int, source_rows: DataFrame | None = None,
                    critical: list[str] = (), run_id: str | None = None, date_col: str | None = None, sort_within: list[str] = (),
                    observe: dict[str, Column] | None = None, min_ratio: float = quality.MIN_UNIQUE_ID_RATIO, batch_id: int | None = None,
                    stream: str | None = None) -> tuple[Change, dict]:
    """Write ``df`` as a new bucketed version, gate it and publish it.

    ``observe`` names further aggregates to measure during the write, over
    columns of ``df``; columns that start with ``_seen_`` are only observed,
    not written. Returns the change and the observed values.
    """
    run_id = run_id or uuid.uuid4().hex
    path = f"{store.root}/{layer}/{table}/v={run_id}"
    dealt = df.withColumn(BUCKET, bucket_of(key, buckets))
    seen = Observation(f"version-{run_id}")
    values = {"rows": F.count(F.lit(1)), **({"max_date": F.max(date_col)} if date_col else {}), **(observe or {})}
    out = _sorted(dealt, list(sort_within)).observe(seen, *[c.alias(n) for n, c in values.items()])
    out = out.drop(*[c for c in out.columns if c.startswith("_seen_")])
    _write(out, path, list(sort_within))
    got = seen.get
    schema = T.StructType([f for f in out.schema.fields if f.name != BUCKET] + [T.StructField(BUCKET, T.IntegerType())])
    stats = _keep_stats(store, measure(store.spark.read.schema(schema).parquet(path), key, list(critical)), layer, table, run_id)
    verdicts = control.enforce(store, table, run_id, quality.verdicts_of(_totals(stats, list(critical)), table, source_rows, list(critical),
                                                                         min_ratio=min_ratio))
    store.publish(layer, table, path, got.get("max_date"), batch_id, stream, run_id, buckets, schema)
    n = int(got["rows"])
    return Change(n, n, 0, got.get("max_date"), buckets, verdicts), got


def recover(store: TableStore, layer: str, table: str) -> bool:
    """Finish a published change whose buckets were not all copied; says whether there was one."""
    ptr = store.pointer(layer, table)
    if ptr is None or ptr["stage"] is None:
        return False
    _copy(store, layer, table, ptr, [])
    return True


def _copy(store: TableStore, layer: str, table: str, ptr: dict, sort_within: list[str]) -> None:
    """Overwrite the touched partitions from the stage, then record that the version is whole."""
    schema = T.StructType.fromJson(json.loads(ptr["schema"]))
    staged = store.spark.read.schema(schema).parquet(ptr["stage"])
    _write(staged.sortWithinPartitions(BUCKET, *sort_within), ptr["path"], sort_within, dynamic=True)
    store.publish(layer, table, ptr["path"], ptr["high_water_mark"], ptr["batch_id"], ptr["stream"], ptr["run_id"], ptr["buckets"], schema)


def apply_delta(store: TableStore, delta: DataFrame, layer: str, table: str, key: str, order_col: str | None = None,
                source_rows: DataFrame | None = None, critical: list[str] = (), run_id: str | None = None, date_col: str | None = None,
                sort_within: list[str] = (), min_ratio: float = quality.MIN_UNIQUE_ID_RATIO, batch_id: int | None = None,
                stream: str | None = None) -> Change:
    """Upsert ``delta`` into the published bucketed version (see the module)."""
    run_id = run_id or uuid.uuid4().hex
    recover(store, layer, table)
    ptr = store.pointer(layer, table)
    current = store.read_buckets(ptr)
    latest = align_to(latest_per_key(delta, key, order_col), current.drop(BUCKET))
    d = latest.withColumn(BUCKET, bucket_of(key, ptr["buckets"]))
    touched = sorted(r[0] for r in d.select(BUCKET).distinct().collect())  # at most one number per bucket
    merged = merge(current.where(F.col(BUCKET).isin(touched)), d, key, [BUCKET])
    stage = f"{store.root}/{layer}/{table}/_stage/v={run_id}"
    seen = Observation(f"delta-{run_id}")
    values = {"inserts": F.count_if(F.col(OP) == "insert"), "updates": F.count_if(F.col(OP) == "update")}
    if date_col:
        values["max_date"] = F.max(F.when(F.col(OP).isNotNull(), F.col(date_col)))
    out = _sorted(merged, list(sort_within)).observe(seen, *[c.alias(n) for n, c in values.items()]).drop(OP)
    _write(out, stage, list(sort_within))
    got = seen.get
    schema = T.StructType([f for f in widen(current, d).schema.fields if f.name != BUCKET] + [T.StructField(BUCKET, T.IntegerType())])
    fresh = _keep_stats(store, measure(store.spark.read.schema(schema).parquet(stage), key, list(critical)), layer, table, run_id)
    kept = bucket_stats(store, layer, table).where(~F.col("bucket").isin(touched))
    if critical and kept.where(F.size(F.array_except(F.array(*map(F.lit, critical)), F.map_keys("nulls"))) > 0).limit(1).count():
        kept = measure(current.where(~F.col(BUCKET).isin(touched)), key, list(critical))  # a critical column no run has counted yet
    totals = _totals(kept.unionByName(fresh), list(critical))
    row = totals.first()
    metrics = store.spark.createDataFrame([row], totals.schema)
    verdicts = control.enforce(store, table, run_id, quality.verdicts_of(metrics, table, source_rows, list(critical), min_ratio=min_ratio))
    high = got.get("max_date")
    if high is None or (isinstance(high, dt.date) and str(high) < (ptr["high_water_mark"] or "")):
        high = ptr["high_water_mark"]  # the mark never moves back
    store.publish(layer, table, ptr["path"], high, batch_id, stream, run_id, ptr["buckets"], schema, stage, touched)
    _copy(store, layer, table, store.pointer(layer, table), list(sort_within))
    return Change(int(row["dw_rows"]), int(got["inserts"]), int(got["updates"]), got.get("max_date"), len(touched), verdicts)
