"""Registered queries for cleaning, casting and key functions (group C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.functions import clean, keys
from starloom.registry import register
from starloom.sources.erp_fixture import ErpSources, oracle_with

_INT_RE = r"^\s*[+-]?[0-9]+\s*$"
_TOKENS = "('nan', 'None', '<NA>', 'NaN', '')"


def _raw(spark, sf_dir):
    return ErpSources(spark, sf_dir).src_raw_partner


@register("normalize_names", """
select c_custkey as cust_key, c_name as cust_name, c_mktsegment as mkt_segment, c_acctbal as acct_bal from customer""")
def q_normalize_names(spark, sf_dir):
    src = ErpSources(spark, sf_dir).customer
    raw = src.select(F.col("c_custkey").alias("Cust Key"), F.col("c_name").alias("Cust-Name"),
                     F.col("c_mktsegment").alias("MKT Segment"), F.col("c_acctbal").alias("acct-Bal"))
    return clean.normalize_names(raw)


@register("struct_to_json", """
select n_nationkey as id, to_json({'key': n_nationkey, 'name': n_name,
 'region': case when n_nationkey % 3 = 0 then null else n_regionkey end})::varchar as payload from nation""")
def q_struct_to_json(spark, sf_dir):
    n = ErpSources(spark, sf_dir).nation
    nested = n.select(
        F.col("n_nationkey").alias("id"),
        F.struct(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"),
                 F.when(F.col("n_nationkey") % 3 == 0, F.lit(None)).otherwise(F.col("n_regionkey")).alias("region"))
        .alias("payload"),
    )
    return clean.structs_to_json(nested)


@register("sanitize_strings", oracle_with(["src_raw_partner"]) + f"""
select id, case when name in {_TOKENS} then null else name end as name,
 case when segment in {_TOKENS} then null else segment end as segment from src_raw_partner""")
def q_sanitize_strings(spark, sf_dir):
    return clean.sanitize_strings(_raw(spark, sf_dir).select("id", "name", "segment"))


@register("sanitize_numbers", oracle_with(["src_raw_partner"]) + """
select id, case when isnan(balance) or isinf(balance) then null else balance end as balance,
 nation_key from src_raw_partner""")
def q_sanitize_numbers(spark, sf_dir):
    return clean.sanitize_numbers(_raw(spark, sf_dir).select("id", "balance", "nation_key"))


def _cast_one(spark, sf_dir, col, target, out=None):
    df, _ = clean.cast_to(_raw(spark, sf_dir).select("id", col), {col: target})
    return df.withColumnRenamed(col, out or col)


@register("cast_int", oracle_with(["src_raw_partner"]) + f"""
select id, case when regexp_matches(nation_txt, '{_INT_RE}') then try_cast(trim(nation_txt) as bigint) end as nation_txt
from src_raw_partner""")
def q_cast_int(spark, sf_dir):
    return _cast_one(spark, sf_dir, "nation_txt", "int8")


@register("cast_float", oracle_with(["src_raw_partner"]) + """
select id, try_cast(trim(balance_txt) as double) as balance_txt from src_raw_partner""")
def q_cast_float(spark, sf_dir):
    return _cast_one(spark, sf_dir, "balance_txt", "double precision")


@register("cast_decimal", oracle_with(["src_raw_partner"]) + """
select id, cast(try_cast(trim(balance_txt) as decimal(18,2)) as double) as balance_txt from src_raw_partner""")
def q_cast_decimal(spark, sf_dir):
    df = _cast_one(spark, sf_dir, "balance_txt", "numeric(18,2)")
    return df.withColumn("balance_txt", F.col("balance_txt").cast("double"))


@register("cast_text", oracle_with(["src_raw_partner"]) + f"""
select id, case when name in {_TOKENS} then null else name end as name, cast(nation_key as varchar) as nation_key
from src_raw_partner""")
def q_cast_text(spark, sf_dir):
    df, _ = clean.cast_to(_raw(spark, sf_dir).select("id", "name", "nation_key"),
                          {"name": "text", "nation_key": "varchar(10)"})
    return df


@register("cast_bool", oracle_with(["src_raw_partner"]) + """
select id, try_cast(trim(active_txt) as boolean) as active_txt from src_raw_partner""")
def q_cast_bool(spark, sf_dir):
    return _cast_one(spark, sf_dir, "active_txt", "boolean")


@register("cast_timestamp", oracle_with(["src_raw_partner"]) + """
select id, try_strptime(since_txt || ' 10:30:00', '%Y-%m-%d %H:%M:%S') as since_ts from src_raw_partner""")
def q_cast_timestamp(spark, sf_dir):
    raw = _raw(spark, sf_dir).select("id", F.concat("since_txt", F.lit(" 10:30:00")).alias("since_ts"))
    df, _ = clean.cast_to(raw, {"since_ts": "timestamp"})
    return df


@register("cast_date", oracle_with(["src_raw_partner"]) + """
select id, cast(try_strptime(trim(since_txt), '%Y-%m-%d') as date) as since_txt from src_raw_partner""")
def q_cast_date(spark, sf_dir):
    return _cast_one(spark, sf_dir, "since_txt", "date")


CAST_PLAN = {"nation_txt": "int8", "balance_txt": "numeric(18,2)", "active_txt": "bool", "since_txt": "date",
             "name": "text", "missing_col": "int4"}


@register("cast_report", oracle_with(["src_raw_partner"]) + f"""
select 'nation_txt' as "column", 'bigint' as target_type,
 count(*) filter (where nation_txt is not null and not regexp_matches(nation_txt, '{_INT_RE}')) as rejected from src_raw_partner
union all select 'balance_txt', 'decimal(18,2)', count(*) filter (where balance_txt is not null and try_cast(trim(balance_txt) as decimal(18,2)) is null) from src_raw_partner
union all select 'active_txt', 'boolean', count(*) filter (where active_txt is not null and try_cast(trim(active_txt) as boolean) is null) from src_raw_partner
union all select 'since_txt', 'date', count(*) filter (where since_txt is not null and try_strptime(trim(since_txt), '%Y-%m-%d') is null) from src_raw_partner
union all select 'name', 'string', count(*) filter (where name in {_TOKENS}) from src_raw_partner""")
def q_cast_report(spark, sf_dir):
    """Rejected-value count per cast column; absent columns are skipped."""
    _, report = clean.cast_to(_raw(spark, sf_dir), CAST_PLAN)
    return report


@register("json_label", oracle_with(["src_team"]) + """
select id, case when left(name, 1) = '{' then coalesce(json_extract_string(name, '$.fr_FR'),
 json_extract_string(name, '$.en_US'), 'Unknown') else name end as label from src_team""")
def q_json_label(spark, sf_dir):
    t = ErpSources(spark, sf_dir).src_team
    return t.select("id", keys.json_label("name").alias("label"))


@register("fk_sentinel", oracle_with(["src_employee"]) + """
select id, coalesce(department_id, '0') as department_id from src_employee""")
def q_fk_sentinel(spark, sf_dir):
    e = ErpSources(spark, sf_dir).src_employee
    return e.select("id", keys.fk("department_id").alias("department_id"))


@register("date_key", oracle_with(["src_crm_lead"]) + """
select id, coalesce(strftime(x_studio_date_rbe, '%Y%m%d'), '0') as date_rbe_id,
 coalesce(strftime(create_date, '%Y%m%d'), '0') as date_create_id from src_crm_lead""")
def q_date_key(spark, sf_dir):
    lead = ErpSources(spark, sf_dir).src_crm_lead
    return lead.select("id", keys.date_key("x_studio_date_rbe").alias("date_rbe_id"),
                       keys.date_key("create_date").alias("date_create_id"))


@register("parse_date_key", oracle_with(["src_contract"]) + """
select id, coalesce(strftime(departure_date, '%Y%m%d'), '0') as departure_key,
 cast(departure_date as date) as departure_day from src_contract""")
def q_parse_date_key(spark, sf_dir):
    c = ErpSources(spark, sf_dir).src_contract
    k = c.select("id", keys.date_key("departure_date").alias("departure_key"))
    return k.withColumn("departure_day", keys.parse_date_key("departure_key"))
