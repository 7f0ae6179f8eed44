"""Registered queries for quality gates and reports (group D)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from starloom.operators import quality, star
from starloom.plans import control
from starloom.functions.keys import ts_lit
from starloom.registry import FACT_SALE_ORDER_CTES, FACT_SALE_ORDER_VIEWS, build_fact_sale_order, register
from starloom.sources.erp_fixture import ErpSources, oracle_with
from starloom.suites.star_models import CALENDAR_CTES, CALENDAR_VIEWS, calendar, dim_client, dim_vendor, lookup, lookup_sql

STALE_CUT = dt.datetime(2001, 1, 1)          # the warehouse copy checked by the row-count gate
STATS_NOW = dt.datetime(2024, 1, 31)          # "now" of the 7-day statistics
FRESH_NOW = dt.datetime(2024, 2, 2)           # "now" of the freshness check
CRITICAL = ["name", "state", "user_id", "rbe_status"]


def _source_rows(src: ErpSources):
    return src.orders.agg(F.count(F.lit(1)).alias("source_rows"))


def _pct_sql(num: str, den: str) -> str:
    return f"cast({num} as double) * 100.0 / cast(nullif({den}, 0) as double)"


_ROW_COUNT_CTES = [
    ("m", f"select count(*) as dw_rows from src_sale_order where create_date < timestamp '{STALE_CUT}'"),
    ("s", "select count(*) as source_rows from orders"),
]
_ROW_COUNT_SQL = f"""
select 'sale_order' as table_name, 'row_count' as gate, 'rows' as subject,
 coalesce({_pct_sql('abs(dw_rows - source_rows)', 'source_rows')}, 0.0) as value, cast(5.0 as double) as threshold,
 case when source_rows = 0 then 'SKIP' when {_pct_sql('abs(dw_rows - source_rows)', 'source_rows')} > 5.0 then 'FAIL'
 else 'PASS' end as status from m, s"""


@register("gate_row_count", oracle_with(["src_sale_order"], _ROW_COUNT_CTES) + _ROW_COUNT_SQL)
def q_gate_row_count(spark, sf_dir):
    """Row-count gate of a stale warehouse copy against the source."""
    src = ErpSources(spark, sf_dir)
    dw = src.src_sale_order.where(F.col("create_date") < ts_lit(STALE_CUT))
    return quality.gate_row_count(quality.gate_metrics(dw), _source_rows(src), "sale_order")


@register("gate_unique_id", oracle_with(["src_tracking"]) + """
select 'mail_tracking_value' as table_name, 'unique_id' as gate, 'id' as subject,
 coalesce(cast(count(distinct mail_message_id) as double) / cast(nullif(count(*), 0) as double), 1.0) as value,
 cast(0.98 as double) as threshold,
 case when count(*) = 0 then 'SKIP'
 when cast(count(distinct mail_message_id) as double) / cast(nullif(count(*), 0) as double) < 0.98 then 'FAIL'
 else 'PASS' end as status
from src_tracking""")
def q_gate_unique_id(spark, sf_dir):
    t = ErpSources(spark, sf_dir).src_tracking
    return quality.gate_unique_id(quality.gate_metrics(t, "mail_message_id"), "mail_tracking_value")


def _null_sql(cols: list[str], table_sql: str, table: str) -> str:
    parts = []
    for c in cols:
        pct = f"coalesce({_pct_sql(f'count(*) filter (where {c} is null)', 'count(*)')}, 0.0)"
        parts.append(f"select '{table}' as table_name, 'null_pct' as gate, '{c}' as subject, {pct} as value, "
                     f"cast(20.0 as double) as threshold, case when {pct} > 20.0 then 'FAIL' else 'PASS' end as status from {table_sql}")
    return "\nunion all ".join(parts)


@register("gate_null_pct", oracle_with(["src_sale_order"]) + _null_sql(["user_id", "rbe_status"], "src_sale_order",
                                                                      "sale_order"))
def q_gate_null_pct(spark, sf_dir):
    """NULL % of critical columns (user_id 1.7 %, rbe_status exactly 20 %: passes)."""
    so = ErpSources(spark, sf_dir).src_sale_order
    cols = ["user_id", "rbe_status"]
    return quality.gate_null_pct(quality.gate_metrics(so, "id", cols), "sale_order", cols)


@register("gate_verdicts", oracle_with(["src_sale_order"]) + f"""
select 'sale_order' as table_name, 'row_count' as gate, 'rows' as subject,
 coalesce({_pct_sql('abs(dw - s)', 's')}, 0.0) as value, cast(5.0 as double) as threshold,
 case when s = 0 then 'SKIP' when {_pct_sql('abs(dw - s)', 's')} > 5.0 then 'FAIL' else 'PASS' end as status
from (select (select count(*) from src_sale_order) as dw, (select count(*) from orders) as s)
union all
select 'sale_order', 'unique_id', 'id', coalesce(cast(count(distinct id) as double) / cast(nullif(count(*), 0) as double), 1.0),
 cast(0.98 as double), case when count(*) = 0 then 'SKIP' when cast(count(distinct id) as double) / cast(nullif(count(*), 0) as double) < 0.98
 then 'FAIL' else 'PASS' end from src_sale_order
union all {_null_sql(CRITICAL, 'src_sale_order', 'sale_order')}""")
def q_gate_verdicts(spark, sf_dir):
    """All blocking gates of the sale-order load from one metrics pass."""
    src = ErpSources(spark, sf_dir)
    return quality.gate_verdicts(src.src_sale_order, "sale_order", _source_rows(src), critical=CRITICAL)


# DuckDB text of control.watermarks_from_log over a filtered log.
def watermarks_sql(log: str = "src_extraction_log") -> list[tuple[str, str]]:
    return [
        ("wm_per", f"""
select table_name,
 max(case when status = 'completed' then last_extracted_date end) as last_extracted_date,
 cast(sum(case when status = 'completed' then rows_inserted end) as bigint) as total_rows,
 max(case when status = 'completed' and starts_with(extraction_type, 'full') then start_time end) as last_full_load,
 max(case when status = 'completed' then end_time end) as last_successful_extraction,
 max(case when status = 'completed' then start_time end) as last_ok_start,
 max(coalesce(end_time, start_time)) as updated_at
from {log} group by table_name"""),
        ("wm_fails", f"""
select l.table_name, count(*) as n from {log} l join wm_per p on l.table_name = p.table_name
where l.status in ('failed', 'quality_failed') and (p.last_ok_start is null or l.start_time > p.last_ok_start)
group by l.table_name"""),
        ("watermarks", """
select p.table_name, p.last_extracted_date, p.total_rows, p.last_full_load, p.last_successful_extraction,
 cast(coalesce(f.n, 0) as integer) as consecutive_failures, p.updated_at
from wm_per p left join wm_fails f on p.table_name = f.table_name"""),
    ]


@register("gate_freshness", oracle_with(["src_extraction_log"], watermarks_sql()) + f"""
select table_name, 'freshness' as gate, 'last_successful_extraction' as subject,
 (epoch_us(timestamp '{FRESH_NOW}') - epoch_us(last_successful_extraction)) / 3.6e9 as value, cast(48.0 as double) as threshold,
 case when last_successful_extraction is null
  or (epoch_us(timestamp '{FRESH_NOW}') - epoch_us(last_successful_extraction)) / 3.6e9 > 48.0 then 'WARN'
 else 'PASS' end as status
from watermarks""")
def q_gate_freshness(spark, sf_dir):
    log = ErpSources(spark, sf_dir).src_extraction_log
    return quality.gate_freshness(control.watermarks_from_log(log), FRESH_NOW)


def _verdict_run_sql(cut, run_id: str) -> str:
    t = f"(select * from src_sale_order where create_date < timestamp '{cut}')"
    return f"""
select *, '{run_id}' as run_id from (
select 'sale_order' as table_name, 'row_count' as gate, 'rows' as subject,
 coalesce({_pct_sql('abs(dw - s)', 's')}, 0.0) as value, cast(5.0 as double) as threshold,
 case when s = 0 then 'SKIP' when {_pct_sql('abs(dw - s)', 's')} > 5.0 then 'FAIL' else 'PASS' end as status
from (select (select count(*) from {t}) as dw, (select count(*) from orders) as s)
union all
select 'sale_order', 'unique_id', 'id', coalesce(cast(count(distinct id) as double) / cast(nullif(count(*), 0) as double), 1.0),
 cast(0.98 as double), case when count(*) = 0 then 'SKIP' when cast(count(distinct id) as double) / cast(nullif(count(*), 0) as double) < 0.98
 then 'FAIL' else 'PASS' end from {t}
union all {_null_sql(CRITICAL, t, 'sale_order')})"""


HISTORY_RUNS = (("r1", STALE_CUT), ("r2", dt.datetime(2002, 1, 1)))


@register("gate_history", oracle_with(["src_sale_order"]) + "\nunion all".join(
    _verdict_run_sql(cut, run_id) for run_id, cut in HISTORY_RUNS))
def q_gate_history(spark, sf_dir):
    """Gate history: verdicts of two runs appended with their run id."""
    src = ErpSources(spark, sf_dir)
    runs = []
    for run_id, cut in HISTORY_RUNS:
        dw = src.src_sale_order.where(F.col("create_date") < ts_lit(cut))
        v = quality.gate_verdicts(dw, "sale_order", _source_rows(src), critical=CRITICAL)
        runs.append(v.withColumn("run_id", F.lit(run_id)))
    return runs[0].unionByName(runs[1])


@register("quality_report", oracle_with(["src_sale_order", "src_crm_lead", "src_message", "src_tracking"], [("counts", """
select 'sale_order' as table_name, count(*) as rows, count(distinct id) as unique_ids from src_sale_order
union all select 'crm_lead', count(*), count(distinct id) from src_crm_lead
union all select 'mail_message', count(*), count(distinct id) from src_message
union all select 'mail_tracking_value', count(*), count(distinct mail_message_id) from src_tracking""")]) + """
select *, case when rows = unique_ids then 'OK' else 'WARN' end as status from counts
union all select 'hr_employee', null, null, 'ERROR'""")
def q_quality_report(spark, sf_dir):
    src = ErpSources(spark, sf_dir)
    frames = {
        "sale_order": src.src_sale_order, "crm_lead": src.src_crm_lead, "mail_message": src.src_message,
        "mail_tracking_value": src.src_tracking.withColumnRenamed("mail_message_id", "id"),
        "hr_employee": None,  # not loaded: reported as an error row
    }
    return quality.quality_report(frames)


@register("extraction_stats", oracle_with(["src_extraction_log"]) + f"""
select table_name, count(*) as runs, cast(sum(rows_extracted) as bigint) as total_rows,
 cast(sum(epoch_us(end_time) - epoch_us(start_time)) as double) / count(*) / 1e6 as avg_secs,
 count(*) filter (where status = 'completed') as successes,
 cast(count(*) filter (where status = 'completed') as double) * 100.0 / cast(count(*) as double) as success_pct
from src_extraction_log where start_time >= timestamp '{STATS_NOW - dt.timedelta(days=7)}'
group by table_name order by total_rows desc nulls last""")
def q_extraction_stats(spark, sf_dir):
    log = ErpSources(spark, sf_dir).src_extraction_log
    return quality.extraction_stats(log, STATS_NOW)


_GRAINS = {"clean": 0, "borderline_pass": 50, "borderline_fail": 48, "bad": 5}  # one id in so many occurs twice


def _repeated_sql(every: int) -> str:
    twice = f" union all select o_orderkey from orders where o_orderkey % {every} = 0" if every else ""
    return f"select o_orderkey as id from orders{twice}"


def _distinct_share(every: int) -> str:
    return f"(select cast(count(distinct id) as double) / count(*) from ({_repeated_sql(every)}))"


@register("gate_unique_id_merged", " union all ".join(
    f"select '{name}' as table_name, 'unique_id' as gate, 'id' as subject, cast(0.98 as double) as threshold, "
    f"case when {_distinct_share(every)} < 0.98 then 'FAIL' else 'PASS' end as status, {str(name.startswith('border')).lower()} as counted"
    for name, every in _GRAINS.items()))
def q_gate_unique_id_merged(spark, sf_dir):
    """The unique-id gate from one sketch per month, on clean, borderline and bad ids; only the borderline ones are counted."""
    orders = ErpSources(spark, sf_dir).orders.select(F.col("o_orderkey").alias("id"), F.trunc("o_orderdate", "month").alias("month"))
    out = None
    for name, every in _GRAINS.items():
        again = orders.where(F.col("id") % every == 0).withColumn("month", F.add_months("month", 1)) if every else None
        rows = orders if again is None else orders.unionByName(again)
        one = quality.gate_unique_id_merged(quality.id_sketches(rows, F.col("month")), rows, name).drop("value")
        out = one if out is None else out.unionByName(one)
    return out


# Dimension of every foreign key of the sale-order fact: a query name, or a function of the sources.
FACT_KEYS = {
    "vendor_id": "dim_vendor", "client_id": "dim_client", "company_id": "dim_company", "team_id": "dim_team",
    "id_state": "dim_sale_status", "project_type_id": "dim_project_type", "payment_method_id": "dim_payment_method",
    "rbe_status_id": "dim_rbe_status", "lost_reason_id": "dim_lost_reason",
}
FACT_DATE_KEYS = ["date_create_id", "date_order_id", "date_signed_id", "date_validity_id", "date_statut_signe_id", "date_rbe_id",
                  "date_last_state_update_id"]


def fact_dimensions(spark, src: ErpSources):
    """The dimension behind each of the fact's nine entity keys and seven date keys."""
    named = {
        "dim_vendor": dim_vendor(src), "dim_client": dim_client(src), "dim_team": star.label_dimension(src.src_team, "id", "name"),
        "dim_sale_status": star.dim_sale_status(spark), "dim_rbe_status": star.dim_rbe_status(spark),
        **{n: lookup(src, n) for n in ("dim_company", "dim_project_type", "dim_payment_method", "dim_lost_reason")},
    }
    days = calendar(spark, src)
    return {**{k: named[d] for k, d in FACT_KEYS.items()}, **{k: days for k in FACT_DATE_KEYS}}


_KEY_SQL = {
    "dim_vendor": "select id from src_vendor union all select '0'",
    "dim_client": "select cast(c_custkey + 1 as varchar) as id from customer union all select '0'",
    "dim_team": "select id from src_team union all select '0'",
    "dim_sale_status": "select id from dim_sale_status", "dim_rbe_status": "select id from dim_rbe_status",
    **{n: f"select id from ({lookup_sql(n)})" for n in ("dim_company", "dim_project_type", "dim_payment_method", "dim_lost_reason")},
}
FACT_DIM_VIEWS = FACT_SALE_ORDER_VIEWS + ["src_vendor", "src_team", "src_company", "src_project_type", "src_payment_method",
                                          "src_lost_reason"] + CALENDAR_VIEWS


def coverage_sql(fact: str) -> str:
    parts = [f"select '{k}' as fk, count(*) filter (where {k} is null or {k} not in ({_KEY_SQL[d]})) as orphans from {fact}"
             for k, d in FACT_KEYS.items()]
    parts += [f"select '{k}', count(*) filter (where {k} is null or {k} not in (select id from dim_date)) from {fact}" for k in FACT_DATE_KEYS]
    return " union all ".join(parts)


@register("fk_coverage", oracle_with(FACT_DIM_VIEWS, FACT_SALE_ORDER_CTES + CALENDAR_CTES) + coverage_sql("fact_sale_order"))
def q_fk_coverage(spark, sf_dir):
    """Orphans per fact foreign key, nine entity and seven date keys (100 % coverage: all 0)."""
    src = ErpSources(spark, sf_dir)
    return quality.fk_coverage(build_fact_sale_order(spark, src), fact_dimensions(spark, src))


_LOST_SQL = "(select * replace (case when cast(id as bigint) % 9 = 0 then 'no such vendor' else vendor_id end as vendor_id, " \
    "case when cast(id as bigint) % 8 = 0 then null else date_rbe_id end as date_rbe_id) from fact_sale_order)"


@register("fk_coverage_broken", oracle_with(FACT_DIM_VIEWS, FACT_SALE_ORDER_CTES + CALENDAR_CTES) + coverage_sql(_LOST_SQL))
def q_fk_coverage_broken(spark, sf_dir):
    """The same over a fact with unknown vendors and NULL date keys: every lost row is counted."""
    src = ErpSources(spark, sf_dir)
    number = F.col("id").cast("bigint")
    fact = build_fact_sale_order(spark, src).withColumns({
        "vendor_id": F.when(number % 9 == 0, F.lit("no such vendor")).otherwise(F.col("vendor_id")),
        "date_rbe_id": F.when(number % 8 != 0, F.col("date_rbe_id"))})
    return quality.fk_coverage(fact, fact_dimensions(spark, src))


@register("fact_grain", oracle_with(FACT_SALE_ORDER_VIEWS, FACT_SALE_ORDER_CTES) + """
select 'fact_sale_order' as table_name, cast(sum(n) as bigint) as rows, count(*) filter (where n > 1) as duplicate_keys,
 cast(coalesce(sum(n) filter (where n > 1), 0) as bigint) as rows_in_duplicates
from (select id, count(*) as n from fact_sale_order group by id)
union all
select 'mail_tracking_value', cast(sum(n) as bigint), count(*) filter (where n > 1), cast(coalesce(sum(n) filter (where n > 1), 0) as bigint)
from (select mail_message_id, count(*) as n from src_tracking group by mail_message_id)""")
def q_fact_grain(spark, sf_dir):
    """Grain check: the fact is unique on id; the tracking table is not."""
    src = ErpSources(spark, sf_dir)
    fact = build_fact_sale_order(spark, src)
    return quality.grain_summary(fact, "id", "fact_sale_order").unionByName(
        quality.grain_summary(src.src_tracking, "mail_message_id", "mail_tracking_value"))
