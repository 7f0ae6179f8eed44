"""Source scans for ingestion: full and incremental reads, ID ranges, batches.

On files the reads are ``spark.read.parquet`` with the high-water-mark
predicate on the raw tracking column, so it reaches the Parquet scan as a
pushed filter. For a live database ``even_ranges`` gives the predicates that
split a read evenly (``read_jdbc``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.clean import normalize_names, structs_to_json
from starloom.functions.keys import ts_lit
from starloom.plans.ranges import stage_ranges, with_offsets

# Tracking column per source table (others have to be named), batch sizes.
TRACKING_COLUMN = {
    "crm_lead": "write_date", "sale_order": "write_date", "res_partner": "write_date",
    "res_users": "write_date", "crm_team": "write_date", "crm_stage": "write_date",
    "crm_lost_reason": "write_date", "res_company": "write_date", "hr_employee": "write_date",
    "ir_model_fields": "write_date", "mail_tracking_value": "create_date", "mail_message": "date",
}
# Columns whose share of NULLs blocks a load, per source table.
CRITICAL_COLUMNS = {"crm_lead": ["name"], "sale_order": ["name", "state"], "res_partner": ["name"]}
JSON_TEXT_TABLES = ("crm_lost_reason", "crm_stage", "crm_team", "res_company")
CHUNK_ROWS = 10_000
HEAVY_CHUNKS = 5


def read_jdbc(spark: SparkSession, url: str, table: str, props: dict[str, str], predicates: list[str] | None = None,
              where: str | None = None) -> DataFrame:
    """Parallel JDBC read, one partition per predicate (see ``even_ranges``).

    Each partition issues its own query, so no single task or cursor carries
    the whole table. Needs the database's JDBC driver jar.
    """
    query = f"(select * from {table}{' where ' + where if where else ''}) as src"
    if predicates is None:
        return spark.read.jdbc(url, query, properties=props)
    return spark.read.jdbc(url, query, predicates=predicates, properties=props)


def with_lineage(df: DataFrame, run_ts: dt.datetime, source: str) -> DataFrame:
    """Lineage columns: one extraction instant per run (not per batch) and the
    source connection id."""
    return df.withColumns({
        "_extracted_at": ts_lit(run_ts),
        "_source_connection": F.lit(source),
    })


def clean_batch(df: DataFrame, table: str, run_ts: dt.datetime, source: str) -> DataFrame:
    """Column names normalised, nested values as JSON text for the tables
    whose translatable fields arrive as objects, lineage added."""
    out = normalize_names(df)
    if table in JSON_TEXT_TABLES:
        out = structs_to_json(out)
    return with_lineage(out, run_ts, source)


def full_snapshot(df: DataFrame, table: str, run_ts: dt.datetime, source: str) -> DataFrame:
    """Full extract: one consistent read of the whole source, cleaned."""
    return clean_batch(df, table, run_ts, source)


def incremental_scan(df: DataFrame, date_col: str, watermark) -> DataFrame:
    """Rows changed strictly after the watermark; NULL dates never qualify.

    A NULL watermark means no previous load: everything qualifies.
    """
    if watermark is None:
        return df
    return df.where(F.col(date_col) > ts_lit(watermark))


def delta_profile(df: DataFrame, date_col: str, watermark) -> DataFrame:
    """One row: total rows, rows changed after the watermark, their max date."""
    changed = F.col(date_col) > ts_lit(watermark) if watermark is not None else F.lit(True)
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(changed).alias("modified_rows"),
        F.max(F.when(changed, F.col(date_col))).alias("max_date"),
    )


def id_range_chunks(df: DataFrame, id_col: str = "id", chunks: int = HEAVY_CHUNKS) -> DataFrame:
    """Split the id domain into ``chunks`` equal inclusive ranges.

    width = ceil((max - min + 1) / chunks); empty ranges are dropped. Each
    row: chunk number, range bounds and the rows in it. The bounds are one
    scalar subquery; the rows are counted by a grouped aggregate, never on
    the driver.
    """
    ids = df.select(F.col(id_col).cast("bigint").alias("_id")).where(F.col("_id").isNotNull())
    b = ids.agg(F.min("_id").alias("min_id"), F.max("_id").alias("max_id"))
    width = F.expr(f"(max_id - min_id + {chunks}) div {chunks}")
    bounds = b.select(F.struct("min_id", "max_id", width.alias("width"))).scalar()
    chunk = F.expr("cast((_id - min_id) div width as int)")
    return (
        ids.withColumns({"min_id": bounds.getField("min_id"), "max_id": bounds.getField("max_id"),
                         "width": bounds.getField("width")})
        .groupBy(chunk.alias("chunk"))
        .agg(F.count(F.lit(1)).alias("rows"), F.first("min_id").alias("min_id"), F.first("width").alias("width"),
             F.first("max_id").alias("max_id"))
        .select(
            "chunk",
            (F.col("min_id") + F.col("chunk") * F.col("width")).alias("start_id"),
            F.least(F.col("min_id") + (F.col("chunk") + 1) * F.col("width") - 1, F.col("max_id")).alias("end_id"),
            "rows",
        )
    )


def delta_batches(df: DataFrame, date_col: str, id_col: str = "id", batch_rows: int = CHUNK_ROWS,
                  partitions: int | None = None) -> DataFrame:
    """Assign each delta row its batch number in (date, id) order.

    Exact global row numbers without a single-partition window: the delta is
    range-partitioned and sorted once and written with each row's place
    (``stage_ranges``); offsets come from the written rows. Returns the rows
    with ``batch_no`` and ``row_no``.
    """
    ranged = with_offsets(stage_ranges(df, [F.col(date_col), F.col(id_col)], partitions))
    row_no = F.col("_off") + F.col("_rn")
    return ranged.withColumn("row_no", row_no).withColumn(
        "batch_no", F.floor((F.col("row_no") - 1) / F.lit(batch_rows)).cast("int")).drop("_pid", "_rn", "_off")


def batch_manifest(batched: DataFrame, date_col: str, id_col: str = "id") -> DataFrame:
    """Keyset bounds per batch: first/last (date, id) and the row count."""
    first = F.min(F.struct(F.col(date_col), F.col(id_col)))
    last = F.max(F.struct(F.col(date_col), F.col(id_col)))
    return batched.groupBy("batch_no").agg(first.alias("_lo"), last.alias("_hi"), F.count(F.lit(1)).alias("rows")) \
        .select("batch_no", F.col(f"_lo.{date_col}").alias("lo_date"), F.col(f"_lo.{id_col}").alias("lo_id"),
                F.col(f"_hi.{date_col}").alias("hi_date"), F.col(f"_hi.{id_col}").alias("hi_id"), "rows")


def keyset_manifest(delta: DataFrame, date_col: str, id_col: str = "id", batch_rows: int = CHUNK_ROWS) -> DataFrame:
    """Batches whose bounds do not overlap: rows equal in (date, id) are never cut apart.

    Only the two key columns are read. A batch holds ``batch_rows`` distinct
    (date, id) pairs; ``rows`` counts the rows they stand for.
    """
    pairs = delta.groupBy(date_col, id_col).agg(F.count(F.lit(1)).alias("_rows"))
    batched = delta_batches(pairs, date_col, id_col, batch_rows)
    bounds = batch_manifest(batched, date_col, id_col).drop("rows")
    return bounds.join(batched.groupBy("batch_no").agg(F.sum("_rows").alias("rows")), "batch_no")


def in_batch(df: DataFrame, batch: dict, date_col: str, id_col: str = "id") -> Column:
    """Whether a row's (date, id) lies in the bounds of a manifest row; ids are compared in their own type."""
    kind = df.schema[id_col].dataType
    date, number = F.col(date_col), F.col(id_col)
    lo_id, hi_id = F.lit(batch["lo_id"]).cast(kind), F.lit(batch["hi_id"]).cast(kind)
    lo, hi = ts_lit(batch["lo_date"]), ts_lit(batch["hi_date"])
    return date.between(lo, hi) & ((date > lo) | (number >= lo_id)) & ((date < hi) | (number <= hi_id))


def even_ranges(df: DataFrame, id_col: str = "id", chunks: int = HEAVY_CHUNKS, accuracy: int = 10_000) -> list[tuple[int, int]]:
    """Inclusive id ranges that cover the table and hold about equally many rows.

    One pass builds a quantile summary (``approx_percentile``, error 1 /
    ``accuracy`` of the rows); all bounds are integers. Gaps between ids give
    wide ranges, not empty ones, and an id with more rows than a range should
    hold has its own. At most ``chunks`` pairs reach the driver.
    """
    number = F.col(id_col).cast("bigint")
    cuts = [i / chunks for i in range(1, chunks)]
    found = df.where(number.isNotNull()).agg(
        F.min(number).alias("lo"), F.max(number).alias("hi"),
        (F.percentile_approx(number, cuts, accuracy) if cuts else F.array().cast("array<bigint>")).alias("cuts")).first()
    if found["lo"] is None:
        return []
    ends = sorted({c for c in (found["cuts"] or []) if c < found["hi"]}) + [found["hi"]]
    return [(start, end) for start, end in zip([found["lo"]] + [e + 1 for e in ends[:-1]], ends)]


def range_predicates(ranges: list[tuple[int, int]], id_col: str = "id") -> list[str]:
    """One SQL predicate per range, and one for rows without an id: the partitions of a parallel read."""
    return [f"{id_col} between {lo} and {hi}" for lo, hi in ranges] + [f"{id_col} is null"]


def range_counts(df: DataFrame, ranges: list[tuple[int, int]], id_col: str = "id") -> DataFrame:
    """``chunk, start_id, end_id, rows`` of the given ranges, in one pass."""
    number = F.col(id_col).cast("bigint")
    place = F.lit(None).cast("int")
    for i in reversed(range(len(ranges))):
        place = F.when(number <= ranges[i][1], F.lit(i)).otherwise(place)
    listed = df.sparkSession.createDataFrame([(i, lo, hi) for i, (lo, hi) in enumerate(ranges)], "chunk int, start_id bigint, end_id bigint")
    rows = df.where(number.isNotNull()).groupBy(place.alias("chunk")).agg(F.count(F.lit(1)).alias("rows"))
    return listed.join(F.broadcast(rows), "chunk", "left").select("chunk", "start_id", "end_id", F.coalesce("rows", F.lit(0)).alias("rows"))
