"""Acceptance counts of the fixture specification (flagship and measures)."""

from pyspark.sql import functions as F

from starloom import registry
from tests.conftest import SF_CHECK, SF_SMALL


def test_fact_sale_order_acceptance_sf0001(spark):
    f = registry.QUERIES["fact_sale_order"](spark, SF_SMALL).cache()
    r = f.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids"),
        F.count_if(F.left("date_create_id", F.lit(4)) < "2001").alias("older"),
        F.count_if(F.col("vendor_id") == "0").alias("vendor0"),
        F.count_if(F.col("project_type_id") == "0").alias("project0"),
        F.count_if(F.col("payment_method_id") == "0").alias("payment0"),
        F.count_if(F.col("id_state") == "0").alias("status0"),
        F.count_if(F.col("rbe_status_id") == "0").alias("rbe0"),
        F.count_if(F.col("date_rbe_id") == "0").alias("rbe_date0"),
        F.count_if(F.col("date_last_state_update_id") == "0").alias("last0"),
        F.sum(F.col("amount_untaxed").cast("decimal(18,2)")).alias("untaxed"),
    ).first()
    assert (r["rows"], r["ids"], r["older"]) == (297, 297, 175)
    assert (r["vendor0"], r["project0"], r["payment0"]) == (3, 205, 192)
    assert (r["status0"], r["rbe0"], r["rbe_date0"], r["last0"]) == (101, 109, 225, 35)
    assert str(r["untaxed"]) == "74976154.49"


def test_fact_sale_order_rows_sf001(spark):
    assert registry.QUERIES["fact_sale_order"](spark, SF_CHECK).count() == 3183


def test_measure_acceptance_sf001(spark):
    q = registry.QUERIES
    assert abs(q["avg_latest_wage"](spark, SF_CHECK).first()["avg_latest_wage"] - 250732.402953) < 1e-6
    t = q["turnover_ratio"](spark, SF_CHECK).first()
    assert (t["departed"], t["active"]) == (1393, 1499) and abs(t["turnover_pct"] - 96.334716) < 1e-6
    ab = {r["leave_type_id"]: r for r in q["absenteeism"](spark, SF_CHECK).collect()}
    assert ab["1"]["leave_days"] == 3166 and abs(ab["1"]["absenteeism_pct"] - 9.593939) < 1e-6
    assert ab["0"]["leave_days"] == 3067 and abs(ab["0"]["absenteeism_pct"] - 9.293939) < 1e-6
    m = q["mom_pct"](spark, SF_CHECK).first()
    assert str(m["current_period"]) == "2024-02-01" and m["current_value"] == 1495
    assert str(m["previous_period"]) == "2024-01-01" and m["previous_value"] == 7505
    ss = {r["stage_id"]: r for r in q["stage_share"](spark, SF_CHECK).collect()}
    assert len(ss) == 5 and ss["1"]["opportunities"] == 1798 and abs(ss["1"]["share"] - 0.199778) < 1e-6
    assert abs(sum(r["share"] for r in ss.values()) - 1.0) < 1e-12
    c = q["upsert_counts"](spark, SF_CHECK).first()
    assert (c["inserts"], c["updates"]) == (1308, 199)
    assert q["upsert_merge"](spark, SF_CHECK).count() == 15000
    pm = q["payroll_monthly"](spark, SF_CHECK).orderBy("month").collect()
    assert len(pm) == 80 and pm[0]["month"] == "1995-01" and abs(pm[0]["payroll_total"] - 48593367.15) < 1e-6
    nulls = {r["subject"]: r for r in q["gate_null_pct"](spark, SF_CHECK).collect()}
    assert abs(nulls["user_id"]["value"] - 1.713333) < 1e-6
    assert nulls["rbe_status"]["value"] == 20.0 and nulls["rbe_status"]["status"] == "PASS"
    assert q["age_bands"](spark, SF_CHECK).count() == 5
    assert q["dim_date"](spark, SF_CHECK).where(F.col("id") != "0").count() == 2922
