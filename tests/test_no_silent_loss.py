"""Cases in which rows, columns or filters used to be lost without a word."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.operators import measures_hr, measures_sales, quality, upsert
from starloom.plans import control
from starloom.sources import ingest
from starloom.streaming.stream_upsert import stream_upsert


@pytest.mark.parametrize("parts", [1, 8, 16])
def test_batches_of_wide_frames_are_exact(spark, parts):
    df = spark.range(0, 20_011).select(
        F.col("id"), (F.col("id") % 977).cast("timestamp").alias("d"), *[F.sha2((F.col("id") + i).cast("string"), 256).alias(f"p{i}") for i in range(3)])
    out = ingest.delta_batches(df, "d", "id", 1000, partitions=parts)
    assert sorted(r.row_no for r in out.select("row_no", "p1").collect()) == list(range(1, 20_012))
    assert {r.batch_no: r["count"] for r in out.groupBy("batch_no").count().collect()} == {**{i: 1000 for i in range(20)}, 20: 11}


def test_new_columns_reach_the_table(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id long, x string")
    delta = spark.createDataFrame([(2, "B", 7), (3, "c", 8)], "id long, x string, y int")
    assert sorted(map(tuple, upsert.upsert(target, delta).collect())) == [(1, "a", None), (2, "B", 7), (3, "c", 8)]
    assert sorted(map(tuple, upsert.append_rows(target, delta.where("id = 3")).collect())) == [(1, "a", None), (2, "b", None), (3, "c", 8)]


def test_a_fresh_checkpoint_is_another_stream(spark, tmp_path):
    store, schema = control.TableStore(spark, str(tmp_path / "tables")), "id long, d timestamp_ntz"
    when = dt.datetime(2024, 1, 1)
    for n in range(2):
        spark.createDataFrame([(i, when) for i in range(10 * n, 10 * n + 10)], schema).coalesce(1).write.parquet(str(tmp_path / f"in{n}"))
        applied = stream_upsert(spark, str(tmp_path / f"in{n}"), spark.createDataFrame([], schema).schema, store, "raw", "t",
                                order_col="d", checkpoint=str(tmp_path / f"ck{n}"))
        assert len(applied) == 1
    assert store.read("raw", "t").count() == 20
    assert stream_upsert(spark, str(tmp_path / "in1"), spark.createDataFrame([], schema).schema, store, "raw", "t",
                         order_col="d", checkpoint=str(tmp_path / "ck1")) == []
    spark.createDataFrame([(1, when), (1, when)], schema).coalesce(1).write.parquet(str(tmp_path / "twice"))
    with pytest.raises(Exception, match="duplicate keys"):
        stream_upsert(spark, str(tmp_path / "twice"), spark.createDataFrame([], schema).schema, store, "raw", "u", checkpoint=str(tmp_path / "x"))


def test_unlisted_leave_types_and_years(spark):
    leaves = spark.createDataFrame([("1", 3, dt.date(2024, 1, 5)), ("9", 5, dt.date(2024, 1, 9)), (None, 1, dt.date(2024, 1, 9))],
                                   "leave_type_id string, number_of_days int, request_date_from date")
    assert [tuple(r)[1:] for r in measures_hr.leave_monthly(leaves, ["1", "2"]).collect()] == [(3, 0, 6)]
    assert sum(r.leave_days for r in measures_hr.leave_monthly_long(leaves).collect()) == 9
    monthly = spark.createDataFrame([("2024-01", 2024, 1.0), ("2025-01", 2025, 2.0)], "month string, year int, payroll_total double")
    with pytest.raises(Exception, match="year not listed"):
        measures_hr.payroll_by_year(monthly, [2024]).collect()
    assert tuple(measures_hr.payroll_by_year(monthly, [2024, 2025]).first()) == ("01", 1.0, 2.0)


def test_company_filter_is_never_ignored(spark):
    activity = spark.createDataFrame([("1", "j", "d", "c", dt.date(2024, 1, 1), 1.0)],
                                     "employee_id string, job_id string, department_id string, contract_id string, contract_create_date date, monthly_wage double")
    people = spark.createDataFrame([("1", "n", "f")], "id string, name string, gender string")
    assert measures_hr.employee_roster(activity, people).count() == 1
    with pytest.raises(ValueError):
        measures_hr.employee_roster(activity, people, company="nosuch")
    with_company = activity.withColumn("company_id", F.lit("7"))
    assert measures_hr.employee_roster(with_company, people, company="nosuch").count() == 0


def test_report_of_missing_tables_only(spark):
    assert [(r.table_name, r.status) for r in quality.quality_report({"a": None, "b": None}).collect()] == [("a", "ERROR"), ("b", "ERROR")]


def test_company_rank_is_per_vendor(spark):
    fact = spark.createDataFrame([("a1", "v1", "2", 10), ("a2", "v1", "2", 10), ("a1", "v2", "2", 15), ("a2", None, "2", 1)],
                                 "team_id string, vendor_id string, id_state string, amount_untaxed int")
    got = {(r.team_id, r.vendor_id): (r.rank_in_agency, r.rank_in_company) for r in measures_sales.vendor_rank(fact).collect()}
    assert got == {("a1", "v1"): (2, 1), ("a2", "v1"): (1, 1), ("a1", "v2"): (1, 2), ("a2", None): (2, 3)}
