"""Registered queries for the business measures (group F)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from starloom.operators import measures_hr as hr
from starloom.operators import measures_sales as ms
from starloom.operators import context as ctx
from starloom.operators import scope, star
from starloom.plans import control
from starloom.registry import FACT_SALE_ORDER_CTES, FACT_SALE_ORDER_VIEWS, build_fact_sale_order, register
from starloom.sources.erp_fixture import ErpSources, oracle_with
from starloom.suites.star_models import (
    CRM_VIEWS,
    FACT_CRM_SQL,
    HR_CTES,
    HR_VIEWS,
    build_activity,
    build_fact_crm,
    build_leave,
    dim_client,
    dim_vendor,
)

AS_OF = dt.date(2001, 8, 1)          # latest order date of the fixture ("today")
TARGET_YEAR = 2001
SCOPE_EMAIL = "v7@example.com"
SLICER_TEAMS = ("1", "2", "3", "4", "5", "6", "7", "8", "9", "10")
SLICER_PROJECT_TYPES = ("0", "1", "2")
LEAVE_TYPES = ["0", "1", "2", "3", "4"]


def P(expr: str) -> str:
    """DuckDB custom month period (month closes on the 25th)."""
    d = f"cast({expr} as date)"
    return (f"cast(case when day({d}) > 25 then date_trunc('month', {d}) + interval 1 month "
            f"else date_trunc('month', {d}) end as date)")


def KD(key: str) -> str:
    """DuckDB parse of a yyyyMMdd key ('0' → NULL)."""
    return f"cast(case when trim({key}) in ('', '0') then null else try_strptime(trim({key}), '%Y%m%d') end as date)"


def RATIO(num: str, den: str) -> str:
    return f"cast({num} as double) / cast(nullif(cast({den} as double), 0.0) as double)"


CRM = oracle_with(CRM_VIEWS, [("fact_crm", FACT_CRM_SQL)])
OPP = "(select * from fact_crm where type = 'opportunity')"
FACT = oracle_with(FACT_SALE_ORDER_VIEWS, FACT_SALE_ORDER_CTES)
HR = oracle_with(HR_VIEWS, HR_CTES)


def _crm(spark, sf_dir):
    return build_fact_crm(ErpSources(spark, sf_dir))


def _fact(spark, sf_dir):
    src = ErpSources(spark, sf_dir)
    return src, build_fact_sale_order(spark, src)


# ------------------------------------------------------------------- CRM

@register("total_opportunities", CRM + """
select vendor_id, count(*) filter (where type = 'opportunity') as total_opportunities from fact_crm group by vendor_id""")
def q_total_opportunities(spark, sf_dir):
    return ms.total_opportunities(_crm(spark, sf_dir), ["vendor_id"])


@register("win_loss_rates", CRM + f"""
select vendor_id, count(*) as total_opportunities, count(*) filter (where won_status_id = 'won') as won,
 count(*) filter (where won_status_id = 'lost') as lost,
 {RATIO("count(*) filter (where won_status_id = 'won')", "count(*)")} as won_rate,
 {RATIO("count(*) filter (where won_status_id = 'lost')", "count(*)")} as lost_rate,
 {RATIO("count(*) filter (where won_status_id = 'won')", "count(*) filter (where won_status_id in ('won', 'lost'))")} as conversion_rate
from {OPP} group by vendor_id""")
def q_win_loss_rates(spark, sf_dir):
    return ms.win_loss_rates(_crm(spark, sf_dir), ["vendor_id"])


@register("stage_share", CRM + f"""
select stage_id, count(*) as opportunities, {RATIO("count(*)", "sum(count(*)) over ()")} as share
from {OPP} group by stage_id""")
def q_stage_share(spark, sf_dir):
    """Share per CRM stage; the denominator ignores the stage filter."""
    return ms.stage_share(_crm(spark, sf_dir))


@register("custom_month_period", CRM + f"""
select id, create_date, {P("create_date")} as period from fact_crm""")
def q_custom_month_period(spark, sf_dir):
    return ms.with_period(_crm(spark, sf_dir).select("id", "create_date"), "create_date")


_PERIODS = f"""
cal as (select distinct {P("d")} as p from (select unnest(range(cast(date_trunc('year', min(create_date)) as timestamp),
  cast(date_trunc('year', max(create_date)) + interval 1 year as timestamp), interval 1 day)) as d from fact_crm)),
cur as (select max(create_date) as latest_date, {P("max(create_date)")} as current_period from fact_crm),
periods as (select latest_date, current_period, (select max(p) from cal where p < current_period) as previous_period from cur)
"""


def _periods(spark, crm):
    return ms.resolve_periods(crm, "create_date", star.date_dimension(spark, *star.date_bounds(crm.select("create_date"))))


@register("resolve_periods", CRM.rstrip() + ",\n" + _PERIODS + "select * from periods")
def q_resolve_periods(spark, sf_dir):
    """Current period = the latest fact date's; previous = greatest earlier period in the calendar."""
    return _periods(spark, _crm(spark, sf_dir))


@register("mom_pct", CRM.rstrip() + ",\n" + _PERIODS + f"""
select p.current_period, p.previous_period,
 cast(count(*) filter (where {P("o.create_date")} = p.current_period) as bigint) as current_value,
 cast(count(*) filter (where {P("o.create_date")} = p.previous_period) as bigint) as previous_value,
 {RATIO(f"count(*) filter (where {P('o.create_date')} = p.current_period) - count(*) filter (where {P('o.create_date')} = p.previous_period)",
        f"count(*) filter (where {P('o.create_date')} = p.previous_period)")} as mom_pct
from {OPP} o, periods p group by p.current_period, p.previous_period""")
def q_mom_pct(spark, sf_dir):
    """Opportunities in the current vs previous custom month and the MoM %."""
    crm = _crm(spark, sf_dir)
    opp = crm.where(F.col("type") == ms.OPPORTUNITY)
    counts = ms.period_counts(opp, _periods(spark, crm), "create_date")
    return ms.mom_pct(counts)


@register("monthly_average", CRM + f"""
select cast(sum(n) as double) / cast(count(*) as double) as monthly_average, count(*) as periods
from (select {P("create_date")} as period, count(*) as n from {OPP} group by all)""")
def q_monthly_average(spark, sf_dir):
    opp = _crm(spark, sf_dir).where(F.col("type") == ms.OPPORTUNITY)
    return ms.monthly_average(ms.monthly_series(opp, "create_date"))


@register("trend_minmax", CRM + f"""
select period, value, case when value = min(value) over () or value = max(value) over () then value end as label
from (select {P("create_date")} as period, count(*) as value from {OPP} group by all)""")
def q_trend_minmax(spark, sf_dir):
    opp = _crm(spark, sf_dir).where(F.col("type") == ms.OPPORTUNITY)
    return ms.trend_minmax(ms.monthly_series(opp, "create_date"))


@register("stage_trend", CRM + f"""
select stage_id, {P("create_date")} as period, count(*) as value from {OPP} group by all""")
def q_stage_trend(spark, sf_dir):
    opp = _crm(spark, sf_dir).where(F.col("type") == ms.OPPORTUNITY)
    return ms.monthly_series(opp, "create_date", by=["stage_id"])


# ------------------------------------------------------------ sale orders

@register("mom_matrix", FACT + f"""
, f as (select *, {P(KD("date_create_id"))} as period from fact_dec),
 c as (select max(period) as cp, (select max(period) from f where period < (select max(period) from f)) as pp from f),
 g as (select project_type_id, sum(amount_untaxed) filter (where period = cp) as cur,
   sum(amount_untaxed) filter (where period = pp) as prev from f, c group by project_type_id)
select project_type_id, cast(prev as double) as previous_value, cast(cur as double) as current_value,
 {RATIO("cur - prev", "prev")} as mom_pct from g""")
def q_mom_matrix(spark, sf_dir):
    """Revenue M vs M-1 by project type (custom months of the creation date)."""
    _, fact = _fact(spark, sf_dir)
    return ms.mom_matrix(fact, ["project_type_id"])


@register("mom_matrix_agency", FACT + f"""
, f as (select *, {P(KD("date_create_id"))} as period from fact_dec),
 c as (select max(period) as cp, (select max(period) from f where period < (select max(period) from f)) as pp from f),
 g as (select team_id, sum(amount_untaxed) filter (where period = cp) as cur,
   sum(amount_untaxed) filter (where period = pp) as prev from f, c group by team_id)
select team_id, cast(prev as double) as previous_value, cast(cur as double) as current_value,
 {RATIO("cur - prev", "prev")} as mom_pct from g""")
def q_mom_matrix_agency(spark, sf_dir):
    """Revenue M vs M-1 by agency (sales team)."""
    _, fact = _fact(spark, sf_dir)
    return ms.mom_matrix(fact, ["team_id"])


@register("signed_revenue", FACT + """
select company_id, cast(sum(amount_untaxed) filter (where id_state = '2') as double) as signed_revenue,
 cast(sum(amount_untaxed) filter (where id_state = '2' and rbe_status_id = '1') as double) as collected_revenue,
 count(*) filter (where id_state = '2') as signed_orders
from fact_dec group by company_id""")
def q_signed_revenue(spark, sf_dir):
    _, fact = _fact(spark, sf_dir)
    return ms.signed_revenue(fact, ["company_id"])


@register("cancel_share", FACT + f"""
select team_id, project_type_id, count(*) as orders, count(*) filter (where lost_reason_id <> '0') as cancelled,
 {RATIO("count(*) filter (where lost_reason_id <> '0')", "count(*)")} as cancel_rate,
 {RATIO("count(*) filter (where lost_reason_id <> '0')", "sum(count(*) filter (where lost_reason_id <> '0')) over (partition by team_id)")}
  as share_of_agency
from fact_dec group by team_id, project_type_id""")
def q_cancel_share(spark, sf_dir):
    _, fact = _fact(spark, sf_dir)
    return ms.cancel_share(fact)


@register("loss_reasons", FACT + f"""
select lost_reason_id, count(*) as orders, cast(sum(amount_untaxed) as double) as amount,
 {RATIO("count(*)", "sum(count(*)) over ()")} as share
from fact_dec where lost_reason_id <> '0' group by lost_reason_id""")
def q_loss_reasons(spark, sf_dir):
    _, fact = _fact(spark, sf_dir)
    return ms.loss_reasons(fact)


@register("sales_portfolio", FACT.rstrip() + ", dv as (select cast(s_suppkey + 1 as varchar) as id, s_name as name from supplier"
          " union all select '0', 'Unknown'),\n dc as (select cast(c_custkey + 1 as varchar) as id, c_name as name from customer"
          " union all select '0', 'Unknown')\n" + """
select f.id, f.order_name, v.name as vendor_name, c.name as client_name, s.state as status, f.date_signed_id,
 cast(f.amount_untaxed as double) as amount_untaxed
from fact_dec f left join dv v on f.vendor_id = v.id
 left join dc c on f.client_id = c.id
 left join dim_sale_status s on f.id_state = s.id""")
def q_sales_portfolio(spark, sf_dir):
    src, fact = _fact(spark, sf_dir)
    return ms.sales_portfolio(fact, dim_vendor(src), dim_client(src), star.dim_sale_status(spark))


_TARGET_SQL = f"""
t as (select id, min(begin_date) as begin_date from src_vendor group by id),
tg as (select id, begin_date,
  case when year(begin_date) < {TARGET_YEAR} then 12 else 13 - month(begin_date) end as months_active from t),
tt as (select *, cast(months_active as double) / 12.0 * 4000000.0 as adjusted_target,
  greatest({AS_OF.month} - case when year(begin_date) < {TARGET_YEAR} then 1 else month(begin_date) end + 1, 0) as months_to_date
  from tg)
"""


def _targets(src):
    return ms.target_to_date(ms.adjusted_target(src.src_vendor, TARGET_YEAR), TARGET_YEAR, AS_OF)


@register("adjusted_target", oracle_with(["src_vendor"]).rstrip() + ",\n" + _TARGET_SQL + """
select id, begin_date, cast(months_active as integer) as months_active, adjusted_target from tt""")
def q_adjusted_target(spark, sf_dir):
    """Annual target prorated by the vendor's start month."""
    return ms.adjusted_target(ErpSources(spark, sf_dir).src_vendor, TARGET_YEAR)


@register("target_to_date", oracle_with(["src_vendor"]).rstrip() + ",\n" + _TARGET_SQL + """
select id, begin_date, cast(months_active as integer) as months_active, adjusted_target,
 cast(months_to_date as integer) as months_to_date, cast(months_to_date as double) / 12.0 * 4000000.0 as target_to_date from tt""")
def q_target_to_date(spark, sf_dir):
    return _targets(ErpSources(spark, sf_dir))


@register("target_gauge", FACT.rstrip() + ",\n src_vendor as (select cast(s_suppkey + 1 as varchar) as id, "
          "date '1999-06-15' + cast(s_suppkey * 37 % 900 as int) as begin_date from supplier),\n" + _TARGET_SQL + f"""
, ach as (select vendor_id, sum(amount_untaxed) as achieved from fact_dec
  where id_state = '2' and left(date_signed_id, 4) = '{TARGET_YEAR}' group by vendor_id),
 j as (select tt.id as vendor_id, tt.adjusted_target, cast(months_to_date as double) / 12.0 * 4000000.0 as target_to_date,
  coalesce(cast(ach.achieved as double), 0.0) as achieved from tt left join ach on tt.id = ach.vendor_id)
select vendor_id, adjusted_target, target_to_date, achieved, achieved - target_to_date as gap,
 case when achieved - target_to_date >= 0 then 'ahead' else 'behind' end as position from j""")
def q_target_gauge(spark, sf_dir):
    """Signed revenue of the year vs the prorated target to date, per vendor."""
    src, fact = _fact(spark, sf_dir)
    return ms.target_gauge(fact, _targets(src), TARGET_YEAR)


@register("prev_month_revenue", FACT.rstrip() + ",\n src_vendor as (select cast(s_suppkey + 1 as varchar) as id, "
          "cast(s_nationkey + 1 as varchar) as team_id from supplier)\n" + f"""
, f as (select *, {P(KD("date_last_state_update_id"))} as p from fact_dec),
 c as (select last_day(max(p) - interval 1 month) as prev from f)
select vendor_id, project_type_id, cast(sum(amount_untaxed) as double) as prev_month_revenue
from f, c where id_state = '2' and month(p) = month(prev) and year(p) = year(prev)
 and project_type_id in {SLICER_PROJECT_TYPES} and vendor_id in (select id from src_vendor where team_id in {SLICER_TEAMS})
group by vendor_id, project_type_id""")
def q_prev_month_revenue(spark, sf_dir):
    """M-1 revenue keeping only the project-type and vendor slicers (semi joins)."""
    src, fact = _fact(spark, sf_dir)
    types = spark.createDataFrame([(t,) for t in SLICER_PROJECT_TYPES], "id string")
    vendors = src.src_vendor.where(F.col("team_id").isin(*SLICER_TEAMS))
    return ms.prev_month_revenue(fact, types, vendors)


@register("kpi_delta", FACT + f"""
, f as (select *, {P(KD("date_create_id"))} as p from fact_dec),
 c as (select max(p) as cp from f),
 g as (select vendor_id, cast(coalesce(sum(amount_untaxed) filter (where p = cp), 0) as double) as current_value,
  cast(coalesce(sum(amount_untaxed) filter (where p = cp - interval 1 month), 0) as double) as previous_value
  from f, c where id_state = '2' group by vendor_id)
select *, current_value - previous_value as delta, {RATIO("current_value - previous_value", "previous_value")} as delta_pct from g""")
def q_kpi_delta(spark, sf_dir):
    _, fact = _fact(spark, sf_dir)
    return ms.kpi_delta(fact)


@register("vendor_rank", FACT + """
, g as (select team_id, vendor_id, sum(amount_untaxed) as revenue from fact_dec where id_state = '2' group by all)
, v as (select vendor_id, cast(rank() over (order by sum(revenue) desc) as integer) as rank_in_company from g group by vendor_id)
select g.team_id, g.vendor_id, cast(g.revenue as double) as revenue,
 cast(rank() over (partition by g.team_id order by g.revenue desc) as integer) as rank_in_agency,
 v.rank_in_company from g join v on g.vendor_id is not distinct from v.vendor_id""")
def q_vendor_rank(spark, sf_dir):
    _, fact = _fact(spark, sf_dir)
    return ms.vendor_rank(fact)


@register("sales_mix", FACT + f"""
, tot as (select count(*) as n, sum(amount_untaxed) as a from fact_dec),
 g as (select 'payment_method_id' as dimension, payment_method_id as value, count(*) as orders, sum(amount_untaxed) as amount
   from fact_dec group by payment_method_id
  union all select 'project_type_id', project_type_id, count(*), sum(amount_untaxed) from fact_dec group by project_type_id
  union all select 'total', null, n, a from tot)
select dimension, value, orders, cast(amount as double) as amount, {RATIO("amount", "a")} as amount_share,
 {RATIO("orders", "n")} as order_share from g, tot""")
def q_sales_mix(spark, sf_dir):
    """Mix by payment method and project type (grouping sets) with shares of the total."""
    _, fact = _fact(spark, sf_dir)
    return ms.sales_mix(fact)


@register("days_in_status", FACT + f"""
select id, date_last_state_update_id, cast(date_diff('day', {KD("date_last_state_update_id")}, date '{AS_OF}') as integer)
 as days_in_status from fact_dec""")
def q_days_in_status(spark, sf_dir):
    _, fact = _fact(spark, sf_dir)
    return ms.days_in_status(fact, AS_OF)


@register("vendor_scope", FACT + f"""
select * exclude (amount_untaxed, amount_tax, amount_total), cast(amount_untaxed as double) as amount_untaxed
from fact_dec where vendor_id in (select cast(s_suppkey + 1 as varchar) from supplier
 where lower(concat('v', cast(s_suppkey + 1 as varchar), '@example.com')) = '{SCOPE_EMAIL}')""")
def q_vendor_scope(spark, sf_dir):
    """Row-level security: the caller (by e-mail) sees only their own orders."""
    src, fact = _fact(spark, sf_dir)
    f = fact.drop("amount_tax", "amount_total", "amount_to_invoice", "acompte_1_pourcent", "acompte_1",
                  "acompte_1_bis", "acompte_2_pourcent", "acompte_2", "acompte_3_pourcent", "acompte_3")
    return ms.vendor_scope(f, src.src_vendor, SCOPE_EMAIL).withColumn(
        "amount_untaxed", F.col("amount_untaxed").cast("double"))


@register("last_updated", oracle_with(["src_extraction_log"]) + """
select table_name, max(end_time) as last_updated from src_extraction_log where status = 'completed' group by table_name""")
def q_last_updated(spark, sf_dir):
    return control.last_updated(ErpSources(spark, sf_dir).src_extraction_log)


# --------------------------------------------------------------------- HR

@register("headcount", HR + f"""
select department_id, count(distinct employee_id) as headcount from fact_employee_activity
where cast(contract_create_date as date) <= date '{AS_OF}'
 and ({KD("departure_date")} is null or {KD("departure_date")} > date '{AS_OF}') group by department_id""")
def q_headcount(spark, sf_dir):
    return hr.headcount(build_activity(ErpSources(spark, sf_dir)), AS_OF, ["department_id"])


@register("entries_exits", HR + f"""
select month, count(*) filter (where kind = 'entry') as entries, count(*) filter (where kind = 'exit') as exits from (
 select cast(date_trunc('month', cast(contract_create_date as date)) as date) as month, 'entry' as kind
  from fact_employee_activity where contract_create_date is not null
 union all
 select cast(date_trunc('month', {KD("departure_date")}) as date), 'exit' from fact_employee_activity
  where {KD("departure_date")} is not null) group by month""")
def q_entries_exits(spark, sf_dir):
    return hr.entries_exits(build_activity(ErpSources(spark, sf_dir)))


@register("turnover_ratio", HR + f"""
, g as (select count(distinct case when {KD("departure_date")} <= date '{AS_OF}' then employee_id end) as departed,
  count(distinct case when departure_date is null or trim(departure_date) in ('', '0') then employee_id end) as active
  from fact_employee_activity)
select departed, active, {RATIO("departed", "cast(departed + active as double) / 2.0")} * 100.0 as turnover_pct from g""")
def q_turnover_ratio(spark, sf_dir):
    """Turnover % as of the fixture's latest date (1,393 departed, 1,499 active at sf0.01)."""
    return hr.turnover_ratio(build_activity(ErpSources(spark, sf_dir)), AS_OF)


@register("age_bands", oracle_with(["src_employee"]) + f"""
, a as (select cast({AS_OF.year} - year(birth_date) - case when month(birth_date) > {AS_OF.month}
   or (month(birth_date) = {AS_OF.month} and day(birth_date) > {AS_OF.day}) then 1 else 0 end as integer) as age
  from src_employee where birth_date is not null)
select cast(floor(age / 10) * 10 as integer) as age_band, count(*) as employees,
 cast(sum(age) as double) / cast(count(*) as double) as avg_age from a group by all""")
def q_age_bands(spark, sf_dir):
    return hr.age_bands(ErpSources(spark, sf_dir).src_employee, AS_OF)


@register("workforce_split", oracle_with(["src_employee"]) + """
select 'job' as dimension, job as value, count(distinct id) as employees from src_employee group by job
union all select 'gender', gender, count(distinct id) from src_employee group by gender
union all select 'department_id', department_id, count(distinct id) from src_employee group by department_id
union all select 'company_id', company_id, count(distinct id) from src_employee group by company_id""")
def q_workforce_split(spark, sf_dir):
    return hr.workforce_split(ErpSources(spark, sf_dir).src_employee)


@register("absenteeism", HR + f"""
, hc as (select count(distinct id) as headcount from src_employee)
select leave_type_id, cast(sum(number_of_days) as bigint) as leave_days, headcount,
 coalesce({RATIO("sum(number_of_days)", "headcount * 22")}, 0.0) * 100.0 as absenteeism_pct
from fact_leave, hc group by leave_type_id, headcount""")
def q_absenteeism(spark, sf_dir):
    """Leave days over (all employees × 22) per leave type."""
    src = ErpSources(spark, sf_dir)
    return hr.absenteeism(build_leave(src), src.src_employee)


@register("leave_by_type", HR + """
select leave_type_id, count(*) as requests, cast(sum(number_of_days) as bigint) as leave_days from fact_leave group by leave_type_id""")
def q_leave_by_type(spark, sf_dir):
    return hr.leave_by_type(build_leave(ErpSources(spark, sf_dir)))


@register("leave_monthly", HR + "select cast(date_trunc('month', cast(request_date_from as date)) as date) as month, "
          + ", ".join(f"cast(coalesce(sum(number_of_days) filter (where leave_type_id = '{t}'), 0) as bigint) as type_{t}"
                      for t in LEAVE_TYPES)
          + ", cast(coalesce(sum(number_of_days) filter (where not coalesce(leave_type_id in ("
          + ", ".join(f"'{t}'" for t in LEAVE_TYPES) + "), false)), 0) as bigint) as type_other from fact_leave group by all")
def q_leave_monthly(spark, sf_dir):
    return hr.leave_monthly(build_leave(ErpSources(spark, sf_dir)), LEAVE_TYPES)


@register("leave_monthly_long", HR + "select cast(date_trunc('month', cast(request_date_from as date)) as date) as month, "
          "leave_type_id, cast(sum(number_of_days) as bigint) as leave_days from fact_leave group by all")
def q_leave_monthly_long(spark, sf_dir):
    """Leave days per month and type, whatever the types."""
    return hr.leave_monthly_long(build_leave(ErpSources(spark, sf_dir)))


@register("avg_latest_wage", oracle_with(["src_contract"]) + """
, lw as (select employee_id, max(wage) as w from (
   select employee_id, wage, rank() over (partition by employee_id order by create_date desc) as rk
   from src_contract where wage is not null) where rk = 1 group by employee_id)
select count(*) as employees, cast(sum(w) as double) / cast(count(*) as double) as avg_latest_wage from lw""")
def q_avg_latest_wage(spark, sf_dir):
    """Average of each employee's max wage at their latest contract date (250,732.402953 at sf0.01)."""
    return hr.avg_latest_wage(ErpSources(spark, sf_dir).src_contract)


@register("payroll_monthly", oracle_with(["src_contract"]) + f"""
, m as (select cast(d as date) as month from range(timestamp '1995-01-01', timestamp '{AS_OF}' + interval 1 day, interval 1 month) t(d)),
 g as (select m.month, sum(c.wage) as total, count(c.id) as n from m left join src_contract c
   on cast(c.create_date as date) <= last_day(m.month)
  and (c.departure_date is null or cast(c.departure_date as date) >= m.month) and c.wage is not null
  group by m.month)
select strftime(month, '%Y-%m') as month, cast(year(month) as integer) as year, coalesce(cast(total as double), 0.0) as payroll_total,
 cast(n as bigint) as active_contracts, {RATIO("coalesce(total, 0)", "n")} as payroll_avg from g""")
def q_payroll_monthly(spark, sf_dir):
    """Monthly payroll over active contracts, 1995-01 to 2001-08 (80 months)."""
    return hr.payroll_monthly(ErpSources(spark, sf_dir).src_contract, dt.date(1995, 1, 1), AS_OF)


PAYROLL_YEARS = list(range(1995, AS_OF.year + 1))


@register("payroll_by_year", oracle_with(["src_contract"]) + f"""
, m as (select cast(d as date) as month from range(timestamp '1995-01-01', timestamp '{AS_OF}' + interval 1 day, interval 1 month) t(d)),
 g as (select m.month, sum(c.wage) as total from m left join src_contract c
   on cast(c.create_date as date) <= last_day(m.month)
  and (c.departure_date is null or cast(c.departure_date as date) >= m.month) and c.wage is not null
  group by m.month)
select strftime(month, '%m') as month_of_year, """ + ", ".join(
    f"max(case when year(month) = {y} then coalesce(cast(total as double), 0.0) end) as \"{y}\"" for y in PAYROLL_YEARS)
    + " from g group by all")
def q_payroll_by_year(spark, sf_dir):
    """Monthly payroll with the years overlaid (one column per year)."""
    monthly = hr.payroll_monthly(ErpSources(spark, sf_dir).src_contract, dt.date(1995, 1, 1), AS_OF)
    return hr.payroll_by_year(monthly, PAYROLL_YEARS)


@register("contract_share", HR + f"""
select contract_type_id, count(*) as contracts, cast(sum(monthly_wage) as double) as wage_total,
 {RATIO("count(*)", "sum(count(*)) over ()")} as share
from fact_employee_activity where contract_id <> '0' group by contract_type_id""")
def q_contract_share(spark, sf_dir):
    return hr.contract_share(build_activity(ErpSources(spark, sf_dir)))


@register("employee_roster", HR + """
select a.employee_id, e.name, e.gender, a.department_id, a.job_id, a.contract_id, a.contract_create_date as entry_date,
 cast(a.monthly_wage as double) as monthly_wage
from fact_employee_activity a left join src_employee e on a.employee_id = e.id
where year(a.contract_create_date) = 2000 and a.job_id = 'BUILDING'""")
def q_employee_roster(spark, sf_dir):
    """Roster filtered by year and job (the other slicers left open)."""
    src = ErpSources(spark, sf_dir)
    return hr.employee_roster(build_activity(src), src.src_employee, year=2000, job="BUILDING")


@register("employee_roster_company", HR + """
select a.employee_id, e.name, e.gender, a.department_id, a.job_id, a.contract_id, a.contract_create_date as entry_date,
 cast(a.monthly_wage as double) as monthly_wage
from fact_employee_activity a left join src_employee e on a.employee_id = e.id
where month(a.contract_create_date) = 3 and a.company_id = '2'""")
def q_employee_roster_company(spark, sf_dir):
    """Roster filtered by company and month of entry."""
    src = ErpSources(spark, sf_dir)
    return hr.employee_roster(build_activity(src), src.src_employee, month=3, company="2")


# Views of the HR pages that complete F24, F27 and F30.

_AGE_SQL = f"""cast({AS_OF.year} - year(birth_date) - case when month(birth_date) > {AS_OF.month}
   or (month(birth_date) = {AS_OF.month} and day(birth_date) > {AS_OF.day}) then 1 else 0 end as integer)"""


@register("average_age", oracle_with(["src_employee"]) + f"""
select count(*) as employees, cast(sum({_AGE_SQL}) as double) / cast(count(*) as double) as average_age
from src_employee where birth_date is not null""")
def q_average_age(spark, sf_dir):
    return hr.average_age(ErpSources(spark, sf_dir).src_employee, AS_OF)


@register("leave_by_department", HR + """
select department_id, cast(sum(number_of_days) as bigint) as leave_days from fact_leave group by department_id""")
def q_leave_by_department(spark, sf_dir):
    return hr.leave_by_department(build_leave(ErpSources(spark, sf_dir)))


def _wage_sql(col: str) -> str:
    return HR + f"""
select {col}, cast(sum(monthly_wage) as double) as wage_total,
 cast(sum(monthly_wage) as double) / cast(count(*) as double) as wage_avg
from fact_employee_activity where monthly_wage is not null group by {col}"""


@register("wage_by_job", _wage_sql("job_id"))
def q_wage_by_job(spark, sf_dir):
    return hr.wage_by(build_activity(ErpSources(spark, sf_dir)), "job_id")


@register("wage_by_department", _wage_sql("department_id"))
def q_wage_by_department(spark, sf_dir):
    return hr.wage_by(build_activity(ErpSources(spark, sf_dir)), "department_id")


# ------------------------------------------------ filter context and row-level security

CONTEXT_TEAMS = [str(i) for i in range(1, 16)]
CONTEXT_STAGES, CONTEXT_PROJECTS, CONTEXT_LEAVES = ["1", "4"], ["0", "1"], ["1", "2", "3"]


def _sql_list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


_V, _T = "vendor_id in (select id from src_vendor where cast(id as bigint) % 3 = 1)", f"team_id in {_sql_list(CONTEXT_TEAMS)}"
_SALES_PERIOD = P(KD("date_last_state_update_id"))


@register("measures_in_context", oracle_with(FACT_SALE_ORDER_VIEWS + CRM_VIEWS + HR_VIEWS,
                                             FACT_SALE_ORDER_CTES + [("fact_crm", FACT_CRM_SQL)] + HR_CTES + [
    ("crm", f"select * from fact_crm where type = 'opportunity' and {_V} and {_T}"),
    ("sales", f"select *, {_SALES_PERIOD} as period from fact_dec"),
]) + f"""
select 'stage_share' as measure, stage_id as grp, cast(count(*) as double) as numerator, cast((select count(*) from crm) as double) as denominator,
 cast(count(*) as double) / (select count(*) from crm) as value from crm where stage_id in {_sql_list(CONTEXT_STAGES)} group by stage_id
union all
select 'previous_month_revenue', project_type_id, cast(sum(amount_untaxed) filter (where id_state = '2' and {_V}
  and period = (select max(period) from sales) - interval 1 month) as double), null, null
from sales where project_type_id in {_sql_list(CONTEXT_PROJECTS)} group by project_type_id having count(*) filter (where {_V} and {_T}) > 0
union all
select 'absenteeism', leave_type_id, cast(sum(number_of_days) as double), cast((select count(distinct id) * 22 from src_employee) as double),
 cast(sum(number_of_days) as double) / cast((select count(distinct id) * 22 from src_employee) as double) * 100.0
from fact_leave where leave_type_id in {_sql_list(CONTEXT_LEAVES)} group by leave_type_id""")
def q_measures_in_context(spark, sf_dir):
    """Five slicers; the stage share drops the stage's, previous-month revenue all but vendor and project type,
    absenteeism divides by all employees."""
    src = ErpSources(spark, sf_dir)
    chosen = ctx.Context({
        "vendor_id": src.src_vendor.where("cast(id as bigint) % 3 = 1").select("id"), "team_id": CONTEXT_TEAMS, "stage_id": CONTEXT_STAGES,
        "project_type_id": CONTEXT_PROJECTS, "leave_type_id": CONTEXT_LEAVES})
    leads = build_fact_crm(src).where(F.col("type") == ms.OPPORTUNITY)
    share = ctx.evaluate(leads, chosen, [ctx.Measure("numerator", F.lit(1)),
                                         ctx.Measure("denominator", F.lit(1), ctx.removing("stage_id"))], ["stage_id"])
    sales = ms.order_period(build_fact_sale_order(spark, src), "date_last_state_update_id")
    previous = F.col("period") == F.add_months(sales.agg(F.max("period")).scalar(), -1)
    collected = ctx.evaluate(sales, chosen, [ctx.Measure("numerator", F.col("amount_untaxed"), ctx.only("project_type_id", "vendor_id"),
                                                         (F.col("id_state") == ms.SALE_STATE_ID) & previous)], ["project_type_id"])
    leaves = ctx.evaluate(build_leave(src), chosen, [ctx.Measure("numerator", F.col("number_of_days"))], ["leave_type_id"])
    everyone = src.src_employee.agg(F.count_distinct("id") * hr.WORKING_DAYS_PER_MONTH).scalar()  # no selection reaches it
    number = lambda c: c.cast("double")

    def rows(df, name, group, denominator, scale):
        over = number(denominator)
        return df.select(F.lit(name).alias("measure"), F.col(group).alias("grp"), number(F.col("numerator")).alias("numerator"),
                         over.alias("denominator"), (scale * ms.ratio(F.col("numerator"), over)).alias("value"))

    return rows(share, "stage_share", "stage_id", F.col("denominator"), F.lit(1.0)).unionByName(
        rows(collected, "previous_month_revenue", "project_type_id", F.lit(None), F.lit(1.0))).unionByName(
        rows(leaves, "absenteeism", "leave_type_id", everyone, F.lit(100.0)))


_MINE = f"(select id from src_vendor where lower(email) = '{SCOPE_EMAIL}')"


@register("vendor_scope_all", oracle_with(FACT_SALE_ORDER_VIEWS + CRM_VIEWS, FACT_SALE_ORDER_CTES + [("fact_crm", FACT_CRM_SQL)] + [
    ("my_sales", f"select * from fact_dec where vendor_id in {_MINE}"), ("my_crm", f"select * from fact_crm where vendor_id in {_MINE}")]) + """
select 'sales' as measure, id_state as grp, count(*) as rows, cast(sum(amount_untaxed) as double) as amount from my_sales group by id_state
union all select 'signed_revenue', 'all', count(*) filter (where id_state = '2'), cast(sum(amount_untaxed) filter (where id_state = '2') as double) from my_sales
union all select 'crm', won_status_id, count(*), cast(sum(expected_revenue) as double) from my_crm group by won_status_id
union all select 'opportunities', stage_id, count(*) filter (where type = 'opportunity'), null from my_crm group by stage_id
union all select 'vendors', 'all', (select count(*) from src_vendor where id in """ + _MINE + """), null""")
def q_vendor_scope_all(spark, sf_dir):
    """The caller's e-mail filters the vendor dimension; sales, CRM and the measures on them follow."""
    src = ErpSources(spark, sf_dir)
    seen = scope.vendor_scope_all({"dim_vendor": dim_vendor(src), "fact_sale_order": build_fact_sale_order(spark, src),
                                   "fact_crm": build_fact_crm(src), "dim_client": dim_client(src)}, SCOPE_EMAIL)
    sales, crm = seen["fact_sale_order"], seen["fact_crm"]
    row = lambda df, name, group, n, amount: df.select(
        F.lit(name).alias("measure"), group.alias("grp"), n.cast("bigint").alias("rows"), amount.cast("double").alias("amount"))
    counted = lambda df, by, money_col: df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.sum(money_col).alias("a"))
    signed = ms.signed_revenue(sales)
    opportunities = ms.total_opportunities(crm, ["stage_id"])
    parts = [
        row(counted(sales, "id_state", "amount_untaxed"), "sales", F.col("id_state"), F.col("n"), F.col("a")),
        row(signed, "signed_revenue", F.lit("all"), F.col("signed_orders"), F.col("signed_revenue")),
        row(counted(crm, "won_status_id", "expected_revenue"), "crm", F.col("won_status_id"), F.col("n"), F.col("a")),
        row(opportunities, "opportunities", F.col("stage_id"), F.col("total_opportunities"), F.lit(None)),
        row(seen["dim_vendor"].agg(F.count(F.lit(1)).alias("n")), "vendors", F.lit("all"), F.col("n"), F.lit(None)),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
