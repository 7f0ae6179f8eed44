"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` and DuckDB oracles.

Each query builds the ERP-shaped sources from the given tables and runs
one library operator over them, whole tables in, whole result out. The
oracle is independent SQL over the same mapping views; output columns and
types are aligned (money as double after exact decimal sums, ratios as
double divisions, keys as text).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import star
from starloom.session import apply_core_conf
from starloom.sources.erp_fixture import ErpSources, oracle_with

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

PERIOD_START = "20010101"


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_core_conf(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return deco


def money(df: DataFrame, cols: list[str]) -> DataFrame:
    """Exact decimals out as double (same value in both engines)."""
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


# ------------------------------------------------------------- shared CTEs
# DuckDB text for the staged models; mirrors starloom.operators.star.

STG_SALE_ORDER_SQL = """
select id, name, coalesce(company_id, '0') as company_id, coalesce(partner_id, '0') as partner_id,
 coalesce(user_id, '0') as user_id, coalesce(team_id, '0') as team_id, state,
 coalesce(lost_reason_id, '0') as lost_reason_id, opportunity_id, rbe_status,
 amount_untaxed, amount_tax, amount_total, amount_to_invoice, acompte_1_pourcent, acompte_1, acompte_1_bis,
 acompte_2_pourcent, acompte_2, acompte_3_pourcent, acompte_3,
 coalesce(strftime(create_date, '%Y%m%d'), '0') as date_create_id,
 coalesce(strftime(order_date, '%Y%m%d'), '0') as date_order_id,
 coalesce(strftime(signed_date, '%Y%m%d'), '0') as date_signed_id,
 coalesce(strftime(validity_date, '%Y%m%d'), '0') as date_validity_id,
 coalesce(strftime(status_signed_date, '%Y%m%d'), '0') as date_statut_signe_id
from src_sale_order_amounts"""

LAST_STATE_CHANGE_SQL = """
select cast(m.res_id as bigint) as sale_order_id, strftime(max(t.create_date), '%Y%m%d') as date_last_state_change_key
from src_tracking t join src_message m on t.mail_message_id = m.id join src_field f on t.field_id = f.id
where m.model = 'sale.order' and f.name = 'state'
group by m.res_id"""

DIM_SALE_STATUS_SQL = "select * from (values ('0','Unknown','Unknown'),('1','draft','Quotation'),('2','sale','Sales Order')) as d(id, state, label)"
DIM_RBE_STATUS_SQL = "select * from (values ('0','Unknown'),('1','Paid'),('2',' PENDING')) as d(id, label)"

ORDERS_RESOLVED_SQL = """
select so.*,
 coalesce(crm.project_type_id, '0') as project_type_id, coalesce(crm.payment_mode, '0') as payment_method_id,
 coalesce(strftime(crm.x_studio_date_rbe, '%Y%m%d'), '0') as date_rbe_id,
 coalesce(a.date_last_state_change_key, '0') as date_last_state_update_id,
 coalesce(ds.id, '0') as id_state, coalesce(dr.id, '0') as rbe_status_id
from stg_sale_order so
left join src_crm_lead crm on so.opportunity_id = crm.id and so.opportunity_id <> '0'
left join last_state_change a on cast(so.id as bigint) = a.sale_order_id
left join dim_sale_status ds on lower(so.state) = ds.state
left join dim_rbe_status dr on lower(trim(so.rbe_status)) = lower(trim(dr.label))"""

FACT_SALE_ORDER_CTES = [
    ("stg_sale_order", STG_SALE_ORDER_SQL),
    ("last_state_change", LAST_STATE_CHANGE_SQL),
    ("dim_sale_status", DIM_SALE_STATUS_SQL),
    ("dim_rbe_status", DIM_RBE_STATUS_SQL),
    ("orders_resolved", ORDERS_RESOLVED_SQL),
    ("fact_sale_order", f"""
select id, name as order_name, user_id as vendor_id, partner_id as client_id, company_id, team_id, id_state,
 project_type_id, payment_method_id, rbe_status_id, lost_reason_id, date_create_id, date_order_id, date_signed_id,
 date_validity_id, date_statut_signe_id, date_rbe_id, date_last_state_update_id,
 cast(amount_untaxed as double) as amount_untaxed, cast(amount_tax as double) as amount_tax,
 cast(amount_total as double) as amount_total, cast(amount_to_invoice as double) as amount_to_invoice,
 cast(acompte_1_pourcent as double) as acompte_1_pourcent, cast(acompte_1 as double) as acompte_1,
 cast(acompte_1_bis as double) as acompte_1_bis, cast(acompte_2_pourcent as double) as acompte_2_pourcent,
 cast(acompte_2 as double) as acompte_2, cast(acompte_3_pourcent as double) as acompte_3_pourcent,
 cast(acompte_3 as double) as acompte_3
from orders_resolved
where left(date_create_id, 4) >= '{PERIOD_START[:4]}'
 or (left(date_create_id, 4) < '{PERIOD_START[:4]}' and date_last_state_update_id >= '{PERIOD_START}')"""),
]
FACT_SALE_ORDER_CTES.append(("fact_dec", f"""
select id, name as order_name, user_id as vendor_id, partner_id as client_id, company_id, team_id, id_state,
 project_type_id, payment_method_id, rbe_status_id, lost_reason_id, date_create_id, date_order_id, date_signed_id,
 date_validity_id, date_statut_signe_id, date_rbe_id, date_last_state_update_id, amount_untaxed, amount_tax, amount_total
from orders_resolved
where left(date_create_id, 4) >= '{PERIOD_START[:4]}'
 or (left(date_create_id, 4) < '{PERIOD_START[:4]}' and date_last_state_update_id >= '{PERIOD_START}')"""))
FACT_SALE_ORDER_VIEWS = ["src_sale_order_amounts", "src_crm_lead", "src_message", "src_tracking", "src_field"]


def fact_sale_order_oracle(final: str = "select * from fact_sale_order", extra=()) -> str:
    return oracle_with(FACT_SALE_ORDER_VIEWS, FACT_SALE_ORDER_CTES + list(extra)) + final


def build_fact_sale_order(spark: SparkSession, src: ErpSources, period_start: str = PERIOD_START) -> DataFrame:
    audit = star.last_state_change(src.src_tracking, src.src_message, src.src_field)
    return star.fact_sale_order(
        star.stg_sale_order(src.src_sale_order_amounts), src.src_crm_lead, audit,
        star.dim_sale_status(spark), star.dim_rbe_status(spark), period_start,
    )


@register("fact_sale_order", fact_sale_order_oracle())
def q_fact_sale_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: the commercial sale-order fact for the reporting period."""
    src = ErpSources(spark, sf_dir)
    return money(build_fact_sale_order(spark, src), star.MONEY_COLUMNS)


# Query suites register themselves on import.
from starloom.suites import clean as _clean  # noqa: E402,F401
from starloom.suites import quality as _quality  # noqa: E402,F401
from starloom.suites import ingest as _ingest  # noqa: E402,F401
from starloom.suites import star_models as _star_models  # noqa: E402,F401
from starloom.suites import measures as _measures  # noqa: E402,F401
from starloom.suites import stream as _stream  # noqa: E402,F401
