"""Registered queries for scans, sinks and the ingestion control plane (groups A, B)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.operators import upsert as up
from starloom.plans import control, load, post_ingestion, star_job
from starloom.functions.keys import ts_lit
from starloom.operators import star
from starloom.registry import build_fact_sale_order, fact_sale_order_oracle, money, register
from starloom.sources import ingest
from starloom.sources.erp_fixture import ErpSources, oracle_with
from starloom.suites.quality import FACT_DATE_KEYS, FACT_KEYS, fact_dimensions, watermarks_sql

RUN_TS = dt.datetime(2024, 2, 1, 2, 0, 0)       # the nightly run instant
SOURCE = "erp_source"
WATERMARK = dt.datetime(2001, 6, 1)             # last extracted date of the sale-order copy
TARGET_CUT = dt.datetime(2001, 1, 1)            # upsert target: orders created before
DELTA_FROM = dt.datetime(2000, 12, 1)           # upsert delta: orders created from
LOG_CUT = dt.datetime(2024, 1, 25)              # watermark state before this, runs after it
PLAN_NOW = dt.datetime(2024, 2, 20)
RETENTION_NOW = dt.datetime(2024, 2, 15)
RESUME_CUT = dt.datetime(1999, 1, 1)            # batches ending before this completed before the crash

SO_MONEY = ["amount_untaxed", "amount_tax"]
SO_COLS = ["id", "name", "company_id", "partner_id", "user_id", "team_id", "state", "lost_reason_id",
           "opportunity_id", "rbe_status", "amount_untaxed", "amount_tax", "create_date", "signed_date",
           "validity_date"]
SO_SQL_COLS = ", ".join(c if c not in SO_MONEY else f"cast({c} as double) as {c}" for c in SO_COLS)

# Configured source tables and whether their target exists.
CONFIGURED_TABLES = [("sale_order", True), ("crm_lead", True), ("res_partner", True), ("mail_message", True),
                     ("mail_tracking_value", True), ("hr_employee", True), ("crm_stage", False),
                     ("res_company", True)]


def _so(spark, sf_dir):
    return ErpSources(spark, sf_dir).src_sale_order


# ------------------------------------------------------------------ scans

@register("full_snapshot", oracle_with(["src_sale_order"]) + f"""
select {SO_SQL_COLS}, timestamp '{RUN_TS}' as _extracted_at, '{SOURCE}' as _source_connection from src_sale_order""")
def q_full_snapshot(spark, sf_dir):
    """Full extract of the sale orders, cleaned, with run lineage."""
    return money(ingest.full_snapshot(_so(spark, sf_dir), "sale_order", RUN_TS, SOURCE), SO_MONEY)


@register("incremental_scan", oracle_with(["src_sale_order"]) + f"""
select id, name, state, create_date from src_sale_order where create_date > timestamp '{WATERMARK}'""")
def q_incremental_scan(spark, sf_dir):
    """Rows changed strictly after the watermark (the predicate reaches the scan)."""
    return ingest.incremental_scan(_so(spark, sf_dir), "create_date", WATERMARK).select("id", "name", "state",
                                                                                        "create_date")


@register("delta_profile", oracle_with(["src_sale_order"]) + f"""
select count(*) as total_rows, count(*) filter (where create_date > timestamp '{WATERMARK}') as modified_rows,
 max(case when create_date > timestamp '{WATERMARK}' then create_date end) as max_date from src_sale_order""")
def q_delta_profile(spark, sf_dir):
    return ingest.delta_profile(_so(spark, sf_dir), "create_date", WATERMARK)


GAP = 1_000_000_000  # between the ids of two generations of orders
EVEN_CHUNKS = 16


@register("id_range_even", f"""
with o as (select case when o_orderkey % 3 = 0 then o_orderkey + {GAP} else o_orderkey end as id from orders)
select count(*) as rows, min(id) as lo, max(id) as hi, true as covers, true as even from o""")
def q_id_range_even(spark, sf_dir):
    """Ranges by quantile over ids with a gap of 1e9: they join up and none holds over twice the mean."""
    number = F.col("o_orderkey")
    ids = ErpSources(spark, sf_dir).orders.select(F.when(number % 3 == 0, number + GAP).otherwise(number).alias("id"))
    counted = ingest.range_counts(ids, ingest.even_ranges(ids, "id", EVEN_CHUNKS), "id")
    before = F.lag("end_id").over(Window.orderBy("chunk"))  # one row per range
    joined = counted.withColumn("joins", F.coalesce(F.col("start_id") == before + 1, F.lit(True)))
    return joined.agg(F.sum("rows").alias("rows"), F.min("start_id").alias("lo"), F.max("end_id").alias("hi"),
                      F.every("joins").alias("covers"), (F.max("rows") * F.count(F.lit(1)) <= 2 * F.sum("rows")).alias("even"))


@register("id_range_chunks", """
with b as (select min(o_orderkey) as mn, max(o_orderkey) as mx,
  (max(o_orderkey) - min(o_orderkey) + 5) // 5 as w from orders)
select cast(floor((o_orderkey - mn) / w) as integer) as chunk, mn + cast(floor((o_orderkey - mn) / w) as bigint) * w as start_id,
 least(mn + (cast(floor((o_orderkey - mn) / w) as bigint) + 1) * w - 1, mx) as end_id, count(*) as rows
from orders, b group by all""")
def q_id_range_chunks(spark, sf_dir):
    """Five equal inclusive id ranges over the order ids, empty ones dropped."""
    orders = ErpSources(spark, sf_dir).orders
    return ingest.id_range_chunks(orders, "o_orderkey", ingest.HEAVY_CHUNKS)


def _delta(spark, sf_dir, since=dt.datetime(1996, 1, 1)):
    return ingest.incremental_scan(_so(spark, sf_dir), "create_date", since)


_BATCH_CTES = [
    ("d", "select id, create_date, row_number() over (order by create_date, id) as rn from src_sale_order "
          "where create_date > timestamp '1996-01-01'"),
    ("b", "select *, cast((rn - 1) // 10000 as integer) as batch_no from d"),
    ("manifest", "select batch_no, arg_min(create_date, rn) as lo_date, arg_min(id, rn) as lo_id, "
                 "arg_max(create_date, rn) as hi_date, arg_max(id, rn) as hi_id, count(*) as rows from b group by batch_no"),
]


@register("delta_batches", oracle_with(["src_sale_order"], _BATCH_CTES) + "select * from manifest")
def q_delta_batches(spark, sf_dir):
    """Delta cut into 10,000-row batches in (date, id) order: keyset manifest."""
    keys = _delta(spark, sf_dir).select("id", "create_date")  # bounds need no other column
    batched = ingest.delta_batches(keys, "create_date", "id", ingest.CHUNK_ROWS)
    return ingest.batch_manifest(batched, "create_date", "id")


# ------------------------------------------------------------------ sinks

@register("batch_contents", oracle_with(["src_sale_order"], [
    ("d", "select id, amount_untaxed, row_number() over (order by create_date, id) as rn from src_sale_order "
          "where create_date > timestamp '1996-01-01'")]) + """
select cast((rn - 1) // 10000 as integer) as batch_no, count(*) as rows, min(cast(id as bigint)) as min_id, max(cast(id as bigint)) as max_id,
 min(rn) as first_row, max(rn) as last_row, cast(sum(amount_untaxed) as double) as amount from d group by all""")
def q_batch_contents(spark, sf_dir):
    """What each 10,000-row batch of the delta holds, payload included."""
    delta = _delta(spark, sf_dir).select("id", "create_date", "amount_untaxed", "state", "user_id")
    batched = ingest.delta_batches(delta, "create_date", "id", ingest.CHUNK_ROWS)
    number = F.col("id").cast("bigint")
    return batched.groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("rows"), F.min(number).alias("min_id"), F.max(number).alias("max_id"),
        F.min("row_no").alias("first_row"), F.max("row_no").alias("last_row"), F.sum("amount_untaxed").cast("double").alias("amount"))


@register("append_rows", oracle_with(["src_sale_order"]) + f"""
select id, name, state, cast(amount_untaxed as double) as amount_untaxed, cast(null as integer) as extra_col
from src_sale_order where create_date < timestamp '{TARGET_CUT}'
union all
select id, name, null, cast(amount_untaxed as double), 1 from src_sale_order where create_date >= timestamp '{TARGET_CUT}'""")
def q_append_rows(spark, sf_dir):
    """Append by name: the batch lacks ``state`` and carries an extra column, which the table gains."""
    so = _so(spark, sf_dir)
    target = so.where(F.col("create_date") < ts_lit(TARGET_CUT)).select("id", "name", "state", "amount_untaxed")
    batch = so.where(F.col("create_date") >= ts_lit(TARGET_CUT)).select(
        "amount_untaxed", "id", "name", F.lit(1).alias("extra_col"))
    return money(up.append_rows(target, batch), ["amount_untaxed"])


def _upsert_inputs(spark, sf_dir):
    so = _so(spark, sf_dir)
    target = so.where(F.col("create_date") < ts_lit(TARGET_CUT))
    delta = so.where(F.col("create_date") >= ts_lit(DELTA_FROM)).select(
        "id", F.upper("state").alias("state"), (F.col("amount_untaxed") + 1).alias("amount_untaxed"), "create_date")
    return target, delta


_UPSERT_CTES = [
    ("t", f"select * from src_sale_order where create_date < timestamp '{TARGET_CUT}'"),
    ("d", f"select id, upper(state) as state, amount_untaxed + 1 as amount_untaxed, create_date from src_sale_order "
          f"where create_date >= timestamp '{DELTA_FROM}'"),
]


@register("upsert_merge", oracle_with(["src_sale_order"], _UPSERT_CTES) + """
select id, name, company_id, partner_id, user_id, team_id, state, lost_reason_id, opportunity_id, rbe_status,
 cast(amount_untaxed as double) as amount_untaxed, cast(amount_tax as double) as amount_tax, create_date, signed_date, validity_date
from t where id not in (select id from d)
union all
select d.id, t.name, t.company_id, t.partner_id, t.user_id, t.team_id, d.state, t.lost_reason_id, t.opportunity_id, t.rbe_status,
 cast(d.amount_untaxed as double), cast(t.amount_tax as double), d.create_date, t.signed_date, t.validity_date
from d left join t on d.id = t.id""")
def q_upsert_merge(spark, sf_dir):
    """Upsert on id; columns the delta lacks are kept on update, NULL on insert."""
    target, delta = _upsert_inputs(spark, sf_dir)
    return money(up.upsert(target, delta, "id", "create_date"), SO_MONEY)


@register("upsert_counts", oracle_with(["src_sale_order"], _UPSERT_CTES) + """
select count(*) filter (where t.id is null) as inserts, count(*) filter (where t.id is not null) as updates
from d left join t on d.id = t.id""")
def q_upsert_counts(spark, sf_dir):
    target, delta = _upsert_inputs(spark, sf_dir)
    return up.upsert_counts(target, delta, "id", "create_date")


@register("schema_types", oracle_with(["src_sale_order"]) + """
select column_name,
 case column_type when 'VARCHAR' then 'string' when 'TIMESTAMP' then 'timestamp_ntz' when 'BIGINT' then 'bigint'
  when 'INTEGER' then 'int' when 'DOUBLE' then 'double' when 'DATE' then 'date' when 'BOOLEAN' then 'boolean'
  else lower(column_type) end as data_type,
 cast(row_number() over () - 1 as integer) as ordinal,
 (select count(*) from src_sale_order) as table_rows
from (describe select * from src_sale_order)""")
def q_schema_types(spark, sf_dir):
    """Target schema introspection: column name, Spark type, position, rows."""
    so = _so(spark, sf_dir)
    rows = [(f.name, f.dataType.simpleString(), i) for i, f in enumerate(so.schema.fields)]
    return spark.createDataFrame(rows, "column_name string, data_type string, ordinal int") \
        .withColumn("table_rows", so.agg(F.count(F.lit(1))).scalar())


_LOG_COLS = ("id, table_name, extraction_type, start_time, end_time, last_extracted_date, rows_extracted, "
             "rows_inserted, rows_updated, status, error_message, created_at")


@register("extraction_log", oracle_with(["src_sale_order", "src_extraction_log"]) + f"""
select {_LOG_COLS} from src_extraction_log
union all
select null, 'sale_order', 'incremental', timestamp '{RUN_TS}', timestamp '{RUN_TS + dt.timedelta(minutes=3)}',
 max(case when create_date > timestamp '{WATERMARK}' then create_date end),
 count(*) filter (where create_date > timestamp '{WATERMARK}'), 0, 0, 'completed', null,
 timestamp '{RUN_TS + dt.timedelta(minutes=3)}' from src_sale_order""")
def q_extraction_log(spark, sf_dir):
    """Run log with this run's entry appended (counts from the delta profile)."""
    src = ErpSources(spark, sf_dir)
    prof = ingest.delta_profile(src.src_sale_order, "create_date", WATERMARK)
    end = RUN_TS + dt.timedelta(minutes=3)
    entry = prof.select(
        F.lit(None).cast("bigint").alias("id"), F.lit("sale_order").alias("table_name"),
        F.lit("incremental").alias("extraction_type"), ts_lit(RUN_TS).alias("start_time"),
        ts_lit(end).alias("end_time"), F.col("max_date").alias("last_extracted_date"),
        F.col("modified_rows").alias("rows_extracted"), F.lit(0).cast("bigint").alias("rows_inserted"),
        F.lit(0).cast("bigint").alias("rows_updated"), F.lit("completed").alias("status"),
        F.lit(None).cast("string").alias("error_message"), ts_lit(end).alias("created_at"))
    return control.append_log(src.src_extraction_log, entry)


@register("log_retention", oracle_with(["src_extraction_log"]) + f"""
select {_LOG_COLS} from src_extraction_log where created_at >= timestamp '{RETENTION_NOW - dt.timedelta(days=30)}'""")
def q_log_retention(spark, sf_dir):
    return control.log_retention(ErpSources(spark, sf_dir).src_extraction_log, RETENTION_NOW)


# ----------------------------------------------------------- control plane

def _log(spark, sf_dir):
    return ErpSources(spark, sf_dir).src_extraction_log


def _run_results(log, statuses):
    """Latest run per table at/after the cut with one of ``statuses``."""
    runs = log.where((F.col("start_time") >= ts_lit(LOG_CUT)) & F.col("status").isin(*statuses))
    best = runs.groupBy("table_name").agg(F.max(F.struct("start_time", "id", "status", "last_extracted_date",
                                                         "rows_inserted", "extraction_type")).alias("r"))
    return best.select("table_name", F.col("r.status").alias("status"),
                       F.col("r.last_extracted_date").alias("max_date"), F.col("r.rows_inserted").alias("rows_inserted"),
                       (F.col("r.extraction_type") == "full").alias("full"))


def _results_sql(statuses: str) -> str:
    return f"""
select table_name, status, last_extracted_date as max_date, rows_inserted, extraction_type = 'full' as "full" from (
 select *, row_number() over (partition by table_name order by start_time desc, id desc) as rk
 from src_extraction_log where start_time >= timestamp '{LOG_CUT}' and status in {statuses}) where rk = 1"""


def _advance_sql() -> str:
    now = f"timestamp '{RUN_TS}'"
    return f"""
select coalesce(w.table_name, r.table_name) as table_name,
 case when r.status = 'completed' and r."full" then r.max_date
  when r.status = 'completed' then coalesce(greatest(w.last_extracted_date, r.max_date), w.last_extracted_date, r.max_date)
  else w.last_extracted_date end as last_extracted_date,
 cast(case when r.status = 'completed' and r."full" then r.rows_inserted
  when r.status = 'completed' then coalesce(w.total_rows, 0) + coalesce(r.rows_inserted, 0) else w.total_rows end as bigint) as total_rows,
 case when r.status = 'completed' and r."full" then {now} else w.last_full_load end as last_full_load,
 case when r.status = 'completed' then {now} else w.last_successful_extraction end as last_successful_extraction,
 cast(case when r.status = 'completed' then 0 when r.status is not null then coalesce(w.consecutive_failures, 0) + 1
  else w.consecutive_failures end as integer) as consecutive_failures,
 case when r.status is not null then {now} else w.updated_at end as updated_at
from watermarks w full outer join results r on w.table_name = r.table_name"""


def _old_log_sql(exclude_first_failure: bool) -> str:
    extra = " and table_name <> 'hr_employee'" if exclude_first_failure else ""
    return f"select * from src_extraction_log where start_time < timestamp '{LOG_CUT}'{extra}"


@register("watermark_update", oracle_with(["src_extraction_log"], [("old_log", _old_log_sql(False))]
                                          + watermarks_sql("old_log")
                                          + [("results", _results_sql("('completed')"))]) + _advance_sql())
def q_watermark_update(spark, sf_dir):
    """Successful runs move the watermark forward (never back) and reset failures."""
    log = _log(spark, sf_dir)
    wm = control.watermarks_from_log(log.where(F.col("start_time") < ts_lit(LOG_CUT)))
    return control.advance_watermark(wm, _run_results(log, ["completed"]), RUN_TS)


@register("watermark_failure", oracle_with(["src_extraction_log"], [("old_log", _old_log_sql(True))]
                                           + watermarks_sql("old_log")
                                           + [("results", _results_sql("('failed', 'quality_failed')"))])
          + _advance_sql())
def q_watermark_failure(spark, sf_dir):
    """Failed runs add a failure and keep the date; a first-ever failure (hr_employee) has a NULL date."""
    log = _log(spark, sf_dir)
    old = log.where((F.col("start_time") < ts_lit(LOG_CUT)) & (F.col("table_name") != "hr_employee"))
    wm = control.watermarks_from_log(old)
    return control.advance_watermark(wm, _run_results(log, ["failed", "quality_failed"]), RUN_TS)


_TABLES_SQL = "select * from (values " + ", ".join(f"('{n}', {str(e).lower()})" for n, e in CONFIGURED_TABLES) \
    + ") as t(table_name, \"exists\")"


@register("load_plan", oracle_with(["src_extraction_log"], watermarks_sql() + [("tables", _TABLES_SQL)]) + f"""
select t.table_name,
 case when r = 'incremental' then 'incremental' else 'full' end as mode, r as reason, last_extracted_date as watermark
from (select t.table_name, w.last_extracted_date,
  case when not coalesce(t."exists", false) then 'table_missing'
   when w.last_extracted_date is null then 'no_watermark'
   when coalesce(w.consecutive_failures, 0) >= 3 then 'too_many_failures'
   when w.last_full_load is not null and floor((epoch_us(timestamp '{PLAN_NOW}') - epoch_us(w.last_full_load)) / 86400000000) >= 30
    then 'full_load_expired'
   else 'incremental' end as r
 from tables t left join watermarks w on t.table_name = w.table_name) t""")
def q_load_plan(spark, sf_dir):
    """Full-or-incremental decision with its reason for every configured table."""
    tables = spark.createDataFrame(CONFIGURED_TABLES, "table_name string, exists boolean")
    return control.load_plan(tables, control.watermarks_from_log(_log(spark, sf_dir)), PLAN_NOW)


@register("high_water_mark", oracle_with(["src_sale_order", "src_crm_lead", "src_tracking"]) + f"""
select 'sale_order' as table_name, greatest(max(create_date), timestamp '{WATERMARK}') as high_water_mark from src_sale_order
union all select 'crm_lead', greatest(max(create_date), timestamp '2024-02-15 00:00:00') from src_crm_lead
union all select 'mail_tracking_value', max(create_date) from src_tracking""")
def q_high_water_mark(spark, sf_dir):
    """Max tracking date ignoring NULLs, never below the previous mark."""
    src = ErpSources(spark, sf_dir)
    parts = [
        control.high_water_mark(src.src_sale_order, "create_date", WATERMARK).select(
            F.lit("sale_order").alias("table_name"), "high_water_mark"),
        control.high_water_mark(src.src_crm_lead, "create_date", dt.datetime(2024, 2, 15)).select(
            F.lit("crm_lead").alias("table_name"), "high_water_mark"),
        control.high_water_mark(src.src_tracking, "create_date").select(
            F.lit("mail_tracking_value").alias("table_name"), "high_water_mark"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("batch_resume", oracle_with(["src_sale_order"], _BATCH_CTES) + f"""
select 'sale_order' as table_name, 'r1' as run_id, * from manifest where hi_date >= timestamp '{RESUME_CUT}'""")
def q_batch_resume(spark, sf_dir):
    """Batches still pending after a run that stopped once early batches completed."""
    batched = ingest.delta_batches(_delta(spark, sf_dir).select("id", "create_date"), "create_date", "id", ingest.CHUNK_ROWS)
    manifest = ingest.batch_manifest(batched, "create_date", "id").select(
        F.lit("sale_order").alias("table_name"), F.lit("r1").alias("run_id"), "*")
    progress = manifest.where(F.col("hi_date") < ts_lit(RESUME_CUT)).select(
        "table_name", "run_id", "batch_no", F.lit("completed").alias("status"))
    return control.pending_batches(manifest, progress)


@register("gated_publish", oracle_with(["src_sale_order"]) + f"""
select {SO_SQL_COLS}, timestamp '{RUN_TS}' as _extracted_at, '{SOURCE}' as _source_connection from src_sale_order""")
def q_gated_publish(spark, sf_dir):
    """Stage → gate → publish of the sale-order snapshot; returns the published version read back."""
    src = ErpSources(spark, sf_dir)
    store = control.TableStore(spark)
    snap = ingest.full_snapshot(src.src_sale_order, "sale_order", RUN_TS, SOURCE)
    hwm = control.high_water_mark(src.src_sale_order, "create_date").first()[0]
    published, _ = control.gated_publish(
        store, snap, "raw", "sale_order", src.orders.agg(F.count(F.lit(1)).alias("source_rows")),
        critical=["name", "state"], high_water_mark=hwm)
    return money(published, SO_MONEY)


@register("lineage_columns", oracle_with(["src_crm_lead"]) + f"""
select id, type, create_date, timestamp '{RUN_TS}' as _extracted_at, '{SOURCE}' as _source_connection from src_crm_lead""")
def q_lineage_columns(spark, sf_dir):
    lead = ErpSources(spark, sf_dir).src_crm_lead.select("id", "type", "create_date")
    return ingest.with_lineage(lead, RUN_TS, SOURCE)


@register("upsert_new_column", """
select o_orderkey as id, case when o_orderkey % 7 = 0 then upper(o_orderstatus) else o_orderstatus end as state,
 case when o_orderkey % 7 = 0 then o_orderpriority end as priority from orders""")
def q_upsert_new_column(spark, sf_dir):
    """A delta with a column the target lacks: it is added, NULL in untouched rows."""
    orders = ErpSources(spark, sf_dir).orders
    target = orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("state"))
    delta = orders.where(F.col("o_orderkey") % 7 == 0).select(
        F.col("o_orderkey").alias("id"), F.upper("o_orderstatus").alias("state"), F.col("o_orderpriority").alias("priority"))
    return up.upsert(target, delta, "id")


# ------------------------------------------------------------------ loads

LOAD_2 = dt.datetime(2024, 2, 2, 2, 0, 0)
LOAD_3 = dt.datetime(2024, 2, 3, 2, 0, 0)
LOADED = ["id", "name", "state", "amount_untaxed", "write_date", "_extracted_at", "_source_connection"]


def _first_and_changed(spark, sf_dir):
    """The orders as a first load finds them, and later: every tenth has a new state, and the newest orders are new."""
    so = _so(spark, sf_dir).select("id", "name", "state", "amount_untaxed", F.col("create_date").alias("write_date"))
    bump = F.col("id").cast("bigint") % 10 == 0
    first = so.where(F.col("write_date") < ts_lit(TARGET_CUT))
    later = so.where((F.col("write_date") < ts_lit(TARGET_CUT)) & bump).withColumns(
        {"state": F.upper("state"), "write_date": F.col("write_date") + F.expr("interval 3000 day")})
    kept = so.where(~(bump & (F.col("write_date") < ts_lit(TARGET_CUT))))
    return first, kept.unionByName(later)


_LOAD_SQL = f"""
select id, name, case when bumped then upper(state) else state end as state, cast(amount_untaxed as double) as amount_untaxed,
 case when bumped then create_date + interval 3000 day else create_date end as write_date,
 case when bumped or create_date >= timestamp '{TARGET_CUT}' then timestamp '{LOAD_2}' else timestamp '{RUN_TS}' end as _extracted_at,
 '{SOURCE}' as _source_connection
from (select *, cast(id as bigint) % 10 = 0 and create_date < timestamp '{TARGET_CUT}' as bumped from src_sale_order)"""


@register("load_incremental", oracle_with(["src_sale_order"]) + _LOAD_SQL)
def q_load_incremental(spark, sf_dir):
    """A full load, then an incremental one that changes and adds orders; the published table is returned."""
    store = control.TableStore(spark, f"{control.TableStore(spark).root}/loads/{uuid.uuid4().hex}")
    first, changed = _first_and_changed(spark, sf_dir)
    load.load_table(store, "sale_order", first, run_ts=RUN_TS)
    load.load_table(store, "sale_order", changed, run_ts=LOAD_2)
    return money(store.read("raw", "sale_order").select(*LOADED), ["amount_untaxed"])


class Killed(RuntimeError):
    """The run was ended from outside."""


@register("load_resumed", oracle_with(["src_sale_order"]) + _LOAD_SQL)
def q_load_resumed(spark, sf_dir):
    """The incremental load is killed after two batches; the next run reads the others only and publishes them all."""
    store = control.TableStore(spark, f"{control.TableStore(spark).root}/loads/{uuid.uuid4().hex}")
    first, changed = _first_and_changed(spark, sf_dir)
    load.load_table(store, "sale_order", first, run_ts=RUN_TS)
    delta = ingest.incremental_scan(changed, "write_date", first.agg(F.max("write_date")).first()[0])
    batch_rows = max(1, -(-delta.count() // 6))

    def killed(batches):
        if batches[0] >= 2:
            raise Killed(f"before batch {batches[0]}")

    try:
        load.load_table(store, "sale_order", changed, run_ts=LOAD_2, batch_rows=batch_rows, batches_per_job=1, on_batches=killed)
    except Killed:
        pass
    load.load_table(store, "sale_order", changed, run_ts=LOAD_3, batch_rows=batch_rows, batches_per_job=4)
    return money(store.read("raw", "sale_order").select(*LOADED), ["amount_untaxed"])


# ------------------------------------------------------- jobs around the loads

def _own_store(spark, kind: str) -> control.TableStore:
    return control.TableStore(spark, f"{control.TableStore(spark).root}/{kind}/{uuid.uuid4().hex}")


def star_tables(spark, src: ErpSources):
    """The dimensions behind the sale-order fact by name, and the fact with its foreign keys."""
    behind = fact_dimensions(spark, src)
    names = {**FACT_KEYS, **{k: "dim_date" for k in FACT_DATE_KEYS}}
    dims = {name: behind[fk] for fk, name in names.items()}
    return dims, star_job.Fact("fact_sale_order", build_fact_sale_order(spark, src), "id", names)


@register("published_fact", fact_sale_order_oracle())
def q_published_fact(spark, sf_dir):
    """Dimensions and the sale-order fact written into their layers; all sixteen keys and the grain gate the fact."""
    dims, fact = star_tables(spark, ErpSources(spark, sf_dir))
    published = star_job.publish_star(_own_store(spark, "star"), dims, [fact])
    return money(published["fact_sale_order"], star.MONEY_COLUMNS)


AFTER = dt.datetime(2024, 2, 3, 6, 0, 0)


@register("post_ingestion_report", oracle_with(["src_sale_order", "src_crm_lead"]) + """
select 'sale_order' as table_name, count(*) as rows, count(distinct id) as unique_ids, 'OK' as status, 2 as runs, 2 as successes from src_sale_order
union all select 'crm_lead', count(*), count(distinct id), 'OK', 1, 1 from src_crm_lead
union all select 'hr_employee', null, null, 'ERROR', null, null""")
def q_post_ingestion_report(spark, sf_dir):
    """Two tables are loaded, a third is configured but never was; the job after the loads reports on all three."""
    src, store = ErpSources(spark, sf_dir), _own_store(spark, "loads")
    first, changed = _first_and_changed(spark, sf_dir)
    load.load_table(store, "sale_order", first, run_ts=RUN_TS)
    load.load_table(store, "sale_order", changed, run_ts=LOAD_2)
    leads = src.src_crm_lead.withColumns({"name": F.concat(F.lit("L"), "id"), "write_date": F.col("create_date")})
    load.load_table(store, "crm_lead", leads, run_ts=RUN_TS)
    found = post_ingestion.after_ingestion(store, [("raw", t) for t in ("sale_order", "crm_lead", "hr_employee")], AFTER)
    if found.failures:
        raise RuntimeError(str(found.failures))
    runs = load.read_log(store).groupBy("table_name").agg(F.count(F.lit(1)).cast("int").alias("runs"),
                                                          F.count_if(F.col("status") == "completed").cast("int").alias("successes"))
    return found.report.join(runs, "table_name", "left")
