"""ERP-shaped source tables derived from the TPC-H-like test tables.

The test data has no ERP tables, so each source (sale orders, CRM leads,
audit messages, employees, ...) is a mapping view over the given parquet
tables. The text of every view is fixed by the fixture specification and
runs unchanged in Spark SQL (tables bound as DataFrame parameters) and in
DuckDB (tables bound by name), which keeps the oracle and the job on the
same inputs.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession

# The source contract of the given tables (declared, not
# inferred: no schema-inference job per read, and drift shows at the reader).
BASE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
BASE_TABLES = tuple(BASE_SCHEMAS)

# Mapping view texts from the fixture specification.
MAPPING_SQL: dict[str, str] = {
    "order_vendor": """
select l_orderkey, min(l_suppkey) as suppkey, min(l_partkey) as partkey,
 sum(cast(l_extendedprice as decimal(18,2)) * cast(l_tax as decimal(4,2))) as tax_amt
from {lineitem} group by l_orderkey""",
    "src_sale_order": """
select cast(o.o_orderkey as string) as id, concat('S', lpad(cast(o.o_orderkey as string), 9, '0')) as name,
 cast(n.n_regionkey + 1 as string) as company_id, cast(o.o_custkey + 1 as string) as partner_id,
 cast(v.suppkey + 1 as string) as user_id, cast(s.s_nationkey + 1 as string) as team_id,
 case o.o_orderstatus when 'F' then 'Sale' when 'O' then 'draft' else 'cancel' end as state,
 case when o.o_orderstatus = 'P' then cast(o.o_orderkey % 4 + 1 as string) end as lost_reason_id,
 case when o.o_orderkey % 3 = 0 then '0' else cast(o.o_orderkey as string) end as opportunity_id,
 case o.o_orderkey % 5 when 0 then ' Paid ' when 1 then 'PAID' when 2 then 'pending' when 3 then 'no-such-label' end as rbe_status,
 cast(o.o_totalprice as decimal(18,2)) as amount_untaxed, cast(v.tax_amt as decimal(18,2)) as amount_tax,
 o.o_orderdate as create_date, case when o.o_orderstatus = 'F' then o.o_orderdate + interval '10' day end as signed_date,
 o.o_orderdate + interval '30' day as validity_date
from {orders} o join {customer} c on o.o_custkey = c.c_custkey join {nation} n on c.c_nationkey = n.n_nationkey
 left join {order_vendor} v on o.o_orderkey = v.l_orderkey left join {supplier} s on v.suppkey = s.s_suppkey""",
    "src_crm_lead": """
select cast(event_id as string) as id, case when event_id % 10 = 0 then 'lead' else 'opportunity' end as type,
 cast(user_id + 1 as string) as partner_id, cast(event_id % 10 + 1 as string) as user_id,
 case event_type when 'view' then '1' when 'click' then '2' when 'signup' then '3' when 'purchase' then '4' else '5' end as stage_id,
 case event_type when 'purchase' then 'won' when 'error' then 'lost' else 'pending' end as won_status,
 cast(value as decimal(18,2)) as expected_revenue,
 case when event_id % 4 <> 3 then cast(event_id % 4 + 1 as string) end as project_type_id,
 case when event_id % 5 <> 4 then cast(event_id % 5 + 1 as string) end as payment_mode,
 case when event_id % 2 = 0 then ts end as x_studio_date_rbe, ts as create_date
from {events}""",
    "src_message": """
select distinct cast(l_orderkey * 100 + l_linenumber as string) as id,
 case when l_orderkey % 10 = 9 then 'crm.lead' else 'sale.order' end as model, l_orderkey as res_id
from {lineitem}""",
    "src_tracking": """
select cast(l_orderkey * 100 + l_linenumber as string) as mail_message_id,
 case l_returnflag when 'R' then '1' when 'A' then '2' else '3' end as field_id, l_shipdate as create_date
from {lineitem}""",
    "src_field": """
select * from (values ('1','state'),('2','user_id'),('3','amount_total')) as f(id, name)""",
    "src_vendor": """
select cast(s_suppkey + 1 as string) as id, s_name as name, concat('v', cast(s_suppkey + 1 as string), '@example.com') as email,
 cast(s_nationkey + 1 as string) as team_id, date '1999-06-15' + cast(s_suppkey * 37 % 900 as int) as begin_date
from {supplier}""",
    "src_team": """
select cast(n_nationkey + 1 as string) as id,
 case n_nationkey % 5 when 0 then concat('{{"fr_FR": "', n_name, '-fr", "en_US": "', n_name, '-en"}}')
 when 1 then concat('{{"en_US": "', n_name, '-en"}}') when 2 then concat('{{"fr_FR": null, "en_US": "', n_name, '-en"}}')
 when 3 then '{{"de_DE": "x"}}' else n_name end as name
from {nation}""",
    "src_employee": """
select cast(c_custkey + 1 as string) as id, c_name as name, case when c_custkey % 2 = 0 then 'female' else 'male' end as gender,
 case when c_custkey % 7 = 0 then null else cast(c_nationkey + 1 as string) end as department_id, c_mktsegment as job,
 date '1955-01-01' + cast(c_custkey * 131 % 16000 as int) as birth_date, cast(n_regionkey + 1 as string) as company_id
from {customer} left join {nation} on c_nationkey = n_nationkey""",
    "src_contract": """
select cast(o_orderkey + 1 as string) as id, cast(o_custkey + 1 as string) as employee_id,
 case when o_orderpriority = '4-NOT SPECIFIED' then null else substr(o_orderpriority, 1, 1) end as contract_type_id,
 o_orderdate as create_date, cast(o_totalprice as decimal(18,2)) as wage,
 case when o_orderstatus = 'F' then o_orderdate + interval '365' day end as departure_date
from {orders}""",
    "src_leave": """
select cast(event_id as string) as id, cast(user_id + 1 as string) as employee_id,
 case event_type when 'error' then '1' when 'click' then '2' when 'view' then '3' when 'signup' then '4' end as leave_type_id,
 cast(ceil(value / 50) as int) as number_of_days, ts as request_date_from
from {events}""",
}

# Our own mapping views (not from the fixture specification): the amounts an
# ERP order carries (its total is not always untaxed + tax, so a model that
# recomputes it differs), the lookup tables behind the keys, raw extracts
# that carry the dirty values the cleaning operators must handle, and a run
# history for the ingestion control plane, both derived from the tables.
MAPPING_SQL.update({
    "src_sale_order_amounts": """
select s.*, cast(s.total_due as decimal(18,2)) as amount_total,
 case when lower(s.state) = 'sale' then cast(s.total_due as decimal(18,2)) else cast(0 as decimal(18,2)) end as amount_to_invoice,
 cast(30 as decimal(5,2)) as acompte_1_pourcent, cast(s.total_due * cast(0.30 as decimal(3,2)) as decimal(18,2)) as acompte_1,
 case when cast(s.id as bigint) % 13 = 0 then cast(25 as decimal(18,2)) end as acompte_1_bis,
 cast(40 as decimal(5,2)) as acompte_2_pourcent, cast(s.total_due * cast(0.40 as decimal(3,2)) as decimal(18,2)) as acompte_2,
 cast(30 as decimal(5,2)) as acompte_3_pourcent, cast(s.total_due * cast(0.30 as decimal(3,2)) as decimal(18,2)) as acompte_3,
 s.signed_date as order_date, case when s.signed_date is not null then s.signed_date + interval '1' day end as status_signed_date
from (select *, cast(amount_untaxed + coalesce(amount_tax, 0)
  - case when cast(id as bigint) % 11 = 0 then cast(1 as decimal(18,2)) else cast(0 as decimal(18,2)) end as decimal(18,2)) as total_due
 from {src_sale_order}) s""",
    "src_company": """
select cast(r_regionkey + 1 as string) as id, concat('{{"fr_FR": "', r_name, '-fr"}}') as name from {region}""",
    "src_lost_reason": """
select distinct cast(o_orderkey % 4 + 1 as string) as id, concat('{{"en_US": "Reason ', cast(o_orderkey % 4 + 1 as string), '"}}') as name
from {orders} where o_orderstatus = 'P'""",
    "src_stage": """
select distinct case event_type when 'view' then '1' when 'click' then '2' when 'signup' then '3' when 'purchase' then '4' else '5' end as id,
 concat('{{"en_US": "', event_type, '"}}') as name from {events}""",
    "src_project_type": """
select distinct project_type_id as id, concat('Project type ', project_type_id) as name from {src_crm_lead} where project_type_id is not null""",
    "src_payment_method": """
select distinct payment_mode as id, concat('Payment ', payment_mode) as name from {src_crm_lead} where payment_mode is not null""",
    "src_contract_type": """
select distinct substr(o_orderpriority, 1, 1) as id, substr(o_orderpriority, 3) as name from {orders} where o_orderpriority <> '4-NOT SPECIFIED'""",
    "src_leave_type": """
select distinct leave_type_id as id, concat('Leave type ', leave_type_id) as name from {src_leave} where leave_type_id is not null""",
    "src_raw_partner": """
select cast(c_custkey + 1 as string) as id,
 case c_custkey % 13 when 0 then 'nan' when 1 then 'None' when 2 then '<NA>' when 3 then 'NaN' when 4 then '' else c_name end as name,
 case c_custkey % 17 when 0 then cast('Infinity' as double) when 1 then cast('-Infinity' as double) when 2 then cast('NaN' as double) else c_acctbal end as balance,
 case c_custkey % 19 when 0 then 'abc' when 1 then '12.5' when 2 then ' 7 ' else cast(c_nationkey as string) end as nation_txt,
 case c_custkey % 23 when 0 then 'n/a' else cast(cast(c_acctbal as decimal(18,2)) as string) end as balance_txt,
 case c_custkey % 3 when 0 then 'true' when 1 then 'false' else 'maybe' end as active_txt,
 case c_custkey % 29 when 0 then 'not-a-date' when 1 then '2024-13-45'
  else concat(cast(2000 + c_custkey % 24 as string), '-', lpad(cast(c_custkey % 12 + 1 as string), 2, '0'), '-', lpad(cast(c_custkey % 28 + 1 as string), 2, '0')) end as since_txt,
 c_nationkey as nation_key, c_mktsegment as segment
from {customer}""",
    "src_extraction_log": """
select event_id + 1 as id,
 case user_id % 6 when 0 then 'sale_order' when 1 then 'crm_lead' when 2 then 'res_partner' when 3 then 'mail_message'
  when 4 then 'mail_tracking_value' else 'hr_employee' end as table_name,
 case when event_type = 'signup' then 'full' else 'incremental' end as extraction_type,
 ts as start_time, ts + cast(floor(value) as int) * interval '1' second as end_time,
 case when event_type = 'error' then null else ts - interval '1' hour end as last_extracted_date,
 cast(floor(value * 10) as bigint) as rows_extracted,
 case when event_type = 'error' then 0 else cast(floor(value * 7) as bigint) end as rows_inserted,
 case when event_type = 'error' then 0 else cast(floor(value * 3) as bigint) end as rows_updated,
 case when event_type = 'error' then 'failed' when event_type = 'click' and event_id % 7 = 0 then 'quality_failed' else 'completed' end as status,
 case when event_type = 'error' then 'source timeout' end as error_message,
 ts as created_at
from {events}""",
})

_REF = re.compile(r"(?<!\{)\{([a-z_]+)\}(?!\})")


def _deps(name: str) -> list[str]:
    return _REF.findall(MAPPING_SQL[name])


class ErpSources:
    """Lazily built source DataFrames for one test-data folder.

    Base tables are read with ``spark.read.parquet`` (column pruning and
    filter pushdown reach the scan); each mapping view is planned once per
    instance and reused by every model built on it.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name in MAPPING_SQL:
                args = {d: self.table(d) for d in _deps(name)}
                self._cache[name] = self.spark.sql(MAPPING_SQL[name], **args)
            else:
                reader = self.spark.read
                if name in BASE_SCHEMAS:
                    reader = reader.schema(BASE_SCHEMAS[name])
                self._cache[name] = reader.parquet(os.path.join(self.sf_dir, f"{name}.parquet"))
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.table(name)


def duckdb_text(name: str) -> str:
    """The mapping view text with tables bound by name (DuckDB oracle)."""
    return MAPPING_SQL[name].replace("{{", "\x00").replace("}}", "\x01").replace("{", "").replace("}", "") \
        .replace("\x00", "{").replace("\x01", "}")


def oracle_with(views: list[str], extra: list[tuple[str, str]] = ()) -> str:
    """A DuckDB ``WITH`` clause holding ``views`` (and their dependencies) then ``extra``."""
    order: list[str] = []

    def visit(v: str) -> None:
        if v in order or v not in MAPPING_SQL:
            return
        for d in _deps(v):
            visit(d)
        order.append(v)

    for v in views:
        visit(v)
    parts = [f"{v} AS ({duckdb_text(v)}\n)" for v in order]
    parts += [f"{n} AS ({body}\n)" for n, body in extra]
    return "WITH " + ",\n".join(parts) + "\n"
