"""Registered queries for dimensions, model steps and the other facts (group E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.operators import star
from starloom.registry import (
    FACT_SALE_ORDER_CTES,
    FACT_SALE_ORDER_VIEWS,
    PERIOD_START,
    money,
    register,
)
from starloom.sources.erp_fixture import ErpSources, oracle_with

JSON_LABEL_SQL = ("case when left({c}, 1) = '{{' then coalesce(json_extract_string({c}, '$.fr_FR'), "
                  "json_extract_string({c}, '$.en_US'), 'Unknown') else {c} end")

FACT_CRM_SQL = """
select l.id, type, coalesce(user_id, '0') as vendor_id, coalesce(partner_id, '0') as client_id,
 coalesce(stage_id, '0') as stage_id, coalesce(won_status, '0') as won_status_id, coalesce(v.team_id, '0') as team_id,
 coalesce(strftime(create_date, '%Y%m%d'), '0') as date_create_id, create_date, expected_revenue
from src_crm_lead l left join src_vendor v on l.user_id = v.id"""
CRM_VIEWS = ["src_crm_lead", "src_vendor"]

FACT_ACTIVITY_SQL = """
select concat_ws('-', e.id, coalesce(c.id, '0')) as activity_id, e.id as employee_id,
 coalesce(e.department_id, '0') as department_id, coalesce(e.job, '0') as job_id, coalesce(e.company_id, '0') as company_id, coalesce(c.id, '0') as contract_id,
 coalesce(c.contract_type_id, '0') as contract_type_id, coalesce(strftime(c.create_date, '%Y%m%d'), '0') as contract_start_date_key,
 c.create_date as contract_create_date, c.wage as monthly_wage, coalesce(strftime(c.departure_date, '%Y%m%d'), '0') as departure_date
from src_employee e left join src_contract c on e.id = c.employee_id"""

FACT_LEAVE_SQL = """
select l.id as leave_id, coalesce(l.employee_id, '0') as employee_id, coalesce(l.leave_type_id, '0') as leave_type_id,
 coalesce(e.department_id, '0') as department_id, coalesce(strftime(l.request_date_from, '%Y%m%d'), '0') as request_date_from_key,
 l.request_date_from, l.number_of_days, l.number_of_days * 8 as number_of_hours
from src_leave l left join src_employee e on l.employee_id = e.id"""

HR_VIEWS = ["src_employee", "src_contract", "src_leave"]
HR_CTES = [("fact_employee_activity", FACT_ACTIVITY_SQL), ("fact_leave", FACT_LEAVE_SQL)]


def build_fact_crm(src: ErpSources):
    return star.fact_crm(src.src_crm_lead, src.src_vendor)


def build_activity(src: ErpSources):
    return star.fact_employee_activity(src.src_employee, src.src_contract)


def build_leave(src: ErpSources):
    return star.fact_leave(src.src_leave, src.src_employee)


def dim_client(src: ErpSources):
    c = src.customer.select((F.col("c_custkey") + 1).cast("string").alias("id"), F.col("c_name").alias("name"))
    return star.dimension(c, "id", {"name": "name"})


def dim_vendor(src: ErpSources):
    return star.dimension(src.src_vendor, "id", {"name": "name", "email": "email", "team_id": "team_id",
                                                 "begin_date": "begin_date"},
                          sentinel={"email": None, "team_id": "0", "begin_date": None})


# ------------------------------------------------------------- dimensions

@register("dim_vendor", oracle_with(["src_vendor"]) + """
select id, name, email, team_id, begin_date from src_vendor
union all select '0', 'Unknown', null, '0', null""")
def q_dim_vendor(spark, sf_dir):
    return dim_vendor(ErpSources(spark, sf_dir))


@register("dim_client", """
select cast(c_custkey + 1 as varchar) as id, c_name as name from customer union all select '0', 'Unknown'""")
def q_dim_client(spark, sf_dir):
    return dim_client(ErpSources(spark, sf_dir))


@register("dim_team", oracle_with(["src_team"]) + f"""
select id, {JSON_LABEL_SQL.format(c='name')} as label from src_team union all select '0', 'Unknown'""")
def q_dim_team(spark, sf_dir):
    return star.label_dimension(ErpSources(spark, sf_dir).src_team, "id", "name")


@register("dim_employee", oracle_with(["src_employee"]) + """
select id, name, gender from src_employee union all select '0', 'Unknown', 'Unknown'""")
def q_dim_employee(spark, sf_dir):
    return star.dimension(ErpSources(spark, sf_dir).src_employee, "id", {"name": "name", "gender": "gender"})


@register("dim_department", """
select cast(n_nationkey + 1 as varchar) as id, n_name as name from nation union all select '0', 'Unknown'""")
def q_dim_department(spark, sf_dir):
    n = ErpSources(spark, sf_dir).nation
    return star.dimension(n.select((F.col("n_nationkey") + 1).alias("id"), F.col("n_name").alias("name")), "id",
                          {"name": "name"})


@register("dim_sale_status", oracle_with(FACT_SALE_ORDER_VIEWS, FACT_SALE_ORDER_CTES) + """
select d.id, d.state, d.label, count(o.id) as orders
from dim_sale_status d left join orders_resolved o on o.id_state = d.id group by d.id, d.state, d.label
union all
select r.id, 'rbe', r.label, count(o.id)
from dim_rbe_status r left join orders_resolved o on o.rbe_status_id = r.id group by r.id, r.label""")
def q_dim_sale_status(spark, sf_dir):
    """Status dimensions of the sale-order fact (sale status and RBE labels)
    with the number of source orders each key resolves; misses land on '0'."""
    src = ErpSources(spark, sf_dir)
    status, rbe = star.dim_sale_status(spark), star.dim_rbe_status(spark)
    audit = star.last_state_change(src.src_tracking, src.src_message, src.src_field)
    o = star.orders_resolved(star.stg_sale_order(src.src_sale_order_amounts), audit, status, rbe)
    per_state = o.groupBy(F.col("id_state").alias("id")).agg(F.count(F.lit(1)).alias("orders"))
    per_rbe = o.groupBy(F.col("rbe_status_id").alias("id")).agg(F.count(F.lit(1)).alias("orders"))
    sale = status.join(per_state, "id", "left")
    rbe_rows = rbe.select("id", F.lit("rbe").alias("state"), "label").join(per_rbe, "id", "left")
    out = sale.unionByName(rbe_rows)
    return out.withColumn("orders", F.coalesce("orders", F.lit(0)).cast("bigint"))


def calendar(spark, src: ErpSources):
    """The date dimension over every date the facts carry."""
    dates = [src.src_sale_order_amounts.select("create_date", "validity_date", "status_signed_date"),
             src.src_crm_lead.select("create_date", "x_studio_date_rbe"), src.src_tracking.select("create_date"),
             src.src_contract.select("create_date", "departure_date"), src.src_leave.select("request_date_from")]
    return star.date_dimension(spark, *star.date_bounds(*dates))


CALENDAR_VIEWS = ["src_sale_order_amounts", "src_crm_lead", "src_tracking", "src_contract", "src_leave"]
CALENDAR_CTES = [
    ("days", " union all ".join(f"select {c} as d from {t}" for t, c in (
        ("src_sale_order_amounts", "create_date"), ("src_sale_order_amounts", "validity_date"), ("src_sale_order_amounts", "status_signed_date"),
        ("src_crm_lead", "create_date"), ("src_crm_lead", "x_studio_date_rbe"), ("src_tracking", "create_date"),
        ("src_contract", "create_date"), ("src_contract", "departure_date"), ("src_leave", "request_date_from")))),
    ("dim_date", """
select strftime(d, '%Y%m%d') as id, cast(d as date) as date, cast(year(d) as integer) as year,
 cast(month(d) as integer) as month, cast(day(d) as integer) as day,
 cast(case when day(d) > 25 then date_trunc('month', d) + interval 1 month else date_trunc('month', d) end as date)
  as custom_month_period
from (select unnest(range(cast(date_trunc('year', min(d)) as timestamp), cast(date_trunc('year', max(d)) + interval 1 year as timestamp),
 interval 1 day)) as d from days)
union all select '0', null, null, null, null, null"""),
]


@register("dim_date", """
select strftime(d, '%Y%m%d') as id, cast(d as date) as date, cast(year(d) as integer) as year,
 cast(month(d) as integer) as month, cast(day(d) as integer) as day,
 cast(case when day(d) > 25 then date_trunc('month', d) + interval 1 month else date_trunc('month', d) end as date)
  as custom_month_period
from range(timestamp '1995-01-01', timestamp '2003-01-01', interval 1 day) t(d)
union all select '0', null, null, null, null, null""")
def q_dim_date(spark, sf_dir):
    """Calendar 1995-2002 (2,922 days) with the custom month and the sentinel.

    The range is the order-date span of the given tables, rounded to years.
    """
    o = ErpSources(spark, sf_dir).orders
    bounds = o.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi")).first()
    start = f"{bounds['lo'].year}-01-01"
    end = f"{bounds['hi'].year + 1}-12-31"
    return star.date_dimension(spark, start, end)


@register("dim_date_facts", oracle_with(CALENDAR_VIEWS, CALENDAR_CTES) + "select * from dim_date")
def q_dim_date_facts(spark, sf_dir):
    """Calendar of whole years over all dates of the facts, with the custom month and the sentinel."""
    return calendar(spark, ErpSources(spark, sf_dir))


# Lookup dimensions by name: (source view, key, label column, whether the label is translatable).
LOOKUPS = {
    "dim_company": ("src_company", "id", "name", True),
    "dim_lost_reason": ("src_lost_reason", "id", "name", True),
    "dim_crm_stage": ("src_stage", "id", "name", True),
    "dim_crm_type": ("src_crm_lead", "type", "type", False),
    "dim_project_type": ("src_project_type", "id", "name", False),
    "dim_payment_method": ("src_payment_method", "id", "name", False),
    "dim_job": ("src_employee", "job", "job", False),
    "dim_contract_type": ("src_contract_type", "id", "name", False),
    "dim_leave_type": ("src_leave_type", "id", "name", False),
}


def lookup(src: ErpSources, name: str):
    view, key, label, translated = LOOKUPS[name]
    df = src.table(view).select(F.col(key).alias("id"), F.col(label).alias("label"))
    return star.label_dimension(df, "id", "label") if translated else star.dimension(df, "id", {"label": "label"})


def lookup_sql(name: str) -> str:
    view, key, label, translated = LOOKUPS[name]
    shown = JSON_LABEL_SQL.format(c=label) if translated else label
    return f"select distinct {key} as id, {shown} as label from {view} where {key} is not null union all select '0', 'Unknown'"


def _register_lookup(name: str) -> None:
    @register(name, oracle_with([LOOKUPS[name][0]]) + lookup_sql(name))
    def query(spark, sf_dir):
        return lookup(ErpSources(spark, sf_dir), name)

    query.__doc__ = f"Lookup dimension {name[4:]} with the sentinel."


for _name in LOOKUPS:
    _register_lookup(_name)


# ---------------------------------------------------------- model steps

@register("last_state_change", oracle_with(FACT_SALE_ORDER_VIEWS, FACT_SALE_ORDER_CTES[:2])
          + "select * from last_state_change")
def q_last_state_change(spark, sf_dir):
    src = ErpSources(spark, sf_dir)
    return star.last_state_change(src.src_tracking, src.src_message, src.src_field)


@register("orders_with_crm", oracle_with(FACT_SALE_ORDER_VIEWS, FACT_SALE_ORDER_CTES) + """
select id, opportunity_id, project_type_id, payment_method_id, date_rbe_id from orders_resolved""")
def q_orders_with_crm(spark, sf_dir):
    """Orders ⟕ lead on opportunity id guarded by id <> '0' (one row per order)."""
    src = ErpSources(spark, sf_dir)
    o = star.orders_with_crm(star.stg_sale_order(src.src_sale_order_amounts), src.src_crm_lead)
    return o.select("id", "opportunity_id", "project_type_id", "payment_method_id", "date_rbe_id")


@register("orders_resolved", oracle_with(FACT_SALE_ORDER_VIEWS, FACT_SALE_ORDER_CTES) + """
select id, state, rbe_status, date_last_state_update_id, id_state, rbe_status_id from orders_resolved""")
def q_orders_resolved(spark, sf_dir):
    src = ErpSources(spark, sf_dir)
    audit = star.last_state_change(src.src_tracking, src.src_message, src.src_field)
    o = star.orders_resolved(star.stg_sale_order(src.src_sale_order_amounts), audit, star.dim_sale_status(spark),
                             star.dim_rbe_status(spark))
    return o.select("id", "state", "rbe_status", "date_last_state_update_id", "id_state", "rbe_status_id")


@register("reporting_period", oracle_with(FACT_SALE_ORDER_VIEWS, FACT_SALE_ORDER_CTES) + f"""
select id, date_create_id, date_last_state_update_id from orders_resolved
where left(date_create_id, 4) >= '{PERIOD_START[:4]}'
 or (left(date_create_id, 4) < '{PERIOD_START[:4]}' and date_last_state_update_id >= '{PERIOD_START}')""")
def q_reporting_period(spark, sf_dir):
    """Orders of the period: created from the start year, or older with a state change since the start."""
    src = ErpSources(spark, sf_dir)
    audit = star.last_state_change(src.src_tracking, src.src_message, src.src_field)
    o = star.orders_resolved(star.stg_sale_order(src.src_sale_order_amounts), audit, star.dim_sale_status(spark),
                             star.dim_rbe_status(spark))
    return star.reporting_period(o, PERIOD_START).select("id", "date_create_id", "date_last_state_update_id")


# ------------------------------------------------------------ other facts

@register("fact_crm", oracle_with(CRM_VIEWS, [("fact_crm", FACT_CRM_SQL)])
          + "select * exclude (expected_revenue), cast(expected_revenue as double) as expected_revenue from fact_crm")
def q_fact_crm(spark, sf_dir):
    return money(build_fact_crm(ErpSources(spark, sf_dir)), ["expected_revenue"])


@register("fact_employee_activity", oracle_with(HR_VIEWS, HR_CTES)
          + "select * exclude (monthly_wage), cast(monthly_wage as double) as monthly_wage from fact_employee_activity")
def q_fact_employee_activity(spark, sf_dir):
    return money(build_activity(ErpSources(spark, sf_dir)), ["monthly_wage"])


@register("fact_leave", oracle_with(HR_VIEWS, HR_CTES) + "select * from fact_leave")
def q_fact_leave(spark, sf_dir):
    return build_leave(ErpSources(spark, sf_dir))
