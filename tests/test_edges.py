"""Hand-made edge frames: thresholds at the limit, empty inputs, ties, bad
casts, NULL tokens, zero denominators, month boundaries."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom.functions import clean, keys
from starloom.functions.keys import ts_lit
from starloom.operators import measures_hr as hr
from starloom.operators import measures_sales as ms
from starloom.operators import quality, star
from starloom.operators import upsert as up
from starloom.plans import control
from starloom.sources import ingest


# ------------------------------------------------------------------ clean

def test_null_tokens_and_non_finite(spark):
    df = spark.createDataFrame(
        [("nan", 1.0), ("None", float("inf")), ("<NA>", float("-inf")), ("NaN", float("nan")), ("", 2.0),
         ("keep", None), (" nan", 3.0)], "s string, x double")
    rows = clean.sanitize(df).collect()
    assert [r.s for r in rows] == [None, None, None, None, None, "keep", " nan"]
    assert [r.x for r in rows] == [1.0, None, None, None, 2.0, None, 3.0]


def test_normalize_names_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`A b` int, `a-b` int")
    with pytest.raises(clean.ColumnCollisionError):
        clean.normalize_names(df)
    assert clean.normalize_names(spark.createDataFrame([(1,)], "`Order Id` int")).columns == ["order_id"]


def test_casts_never_raise_and_report(spark):
    df = spark.createDataFrame([("12", "1.5", "true", "2024-02-29"), ("12.5", "x", "maybe", "2024-02-30"),
                                (" 7 ", None, "false", None)], "i string, f string, b string, d string")
    out, report = clean.cast_to(df, {"i": "int8", "f": "numeric(10,2)", "b": "bool", "d": "date", "zz": "int4"})
    rows = out.collect()
    assert [r.i for r in rows] == [12, None, 7]
    assert [r.f for r in rows] == [Decimal("1.50"), None, None]
    assert [r.b for r in rows] == [True, None, False]
    assert [r.d for r in rows] == [dt.date(2024, 2, 29), None, None]
    rep = {r.column: r.rejected for r in report.collect()}
    assert rep == {"i": 1, "f": 1, "b": 1, "d": 1}


def test_spark_type_names():
    from pyspark.sql import types as T
    assert clean.spark_type("numeric(18,2)") == T.DecimalType(18, 2)
    assert clean.spark_type("varchar(40)") == T.StringType()
    assert clean.spark_type("int8") == T.LongType()
    with pytest.raises(ValueError):
        clean.spark_type("geometry")


def test_json_label_and_keys(spark):
    df = spark.createDataFrame([('{"fr_FR": "Ventes", "en_US": "Sales"}',), ('{"fr_FR": null, "en_US": "Sales"}',),
                                ('{"de_DE": "x"}',), ('{broken',), ("plain",), (None,)], "name string")
    assert [r[0] for r in df.select(keys.json_label("name")).collect()] == \
        ["Ventes", "Sales", "Unknown", "Unknown", "plain", None]
    k = spark.createDataFrame([("20240105",), ("0",), ("",), (None,), ("2024-01-05",)], "k string")
    assert [r[0] for r in k.select(keys.parse_date_key("k")).collect()] == [dt.date(2024, 1, 5), None, None, None, None]
    d = spark.createDataFrame([(dt.datetime(2024, 1, 5, 23, 59),), (None,)], "t timestamp_ntz")
    assert [r[0] for r in d.select(keys.date_key("t")).collect()] == ["20240105", "0"]


# ---------------------------------------------------------------- quality

def _metrics(spark, rows, total, uniq):
    return spark.createDataFrame([(total, uniq)], "dw_rows bigint, unique_ids bigint")


def test_gate_thresholds_at_limit(spark):
    src = spark.createDataFrame([(100,)], "source_rows bigint")
    at = quality.gate_row_count(_metrics(spark, None, 105, 105), src, "t").first()
    over = quality.gate_row_count(_metrics(spark, None, 106, 106), src, "t").first()
    assert (at.status, over.status) == ("PASS", "FAIL")
    empty_src = spark.createDataFrame([(0,)], "source_rows bigint")
    assert quality.gate_row_count(_metrics(spark, None, 5, 5), empty_src, "t").first().status == "SKIP"
    assert quality.gate_unique_id(_metrics(spark, None, 100, 98), "t").first().status == "PASS"
    assert quality.gate_unique_id(_metrics(spark, None, 100, 97), "t").first().status == "FAIL"
    assert quality.gate_unique_id(_metrics(spark, None, 0, 0), "t").first().status == "SKIP"


def test_null_pct_and_enforce(spark):
    df = spark.createDataFrame([(str(i), None if i < 2 else "x") for i in range(10)], "id string, c string")
    v = quality.gate_verdicts(df, "t", spark.createDataFrame([(10,)], "source_rows bigint"), critical=["c"])
    rows = quality.enforce(v)
    assert [r["value"] for r in rows if r["gate"] == "null_pct"] == [20.0]
    bad = spark.createDataFrame([(str(i), None if i < 3 else "x") for i in range(10)], "id string, c string")
    with pytest.raises(quality.DataQualityError, match="null_pct"):
        quality.enforce(quality.gate_verdicts(bad, "t", spark.createDataFrame([(10,)], "source_rows bigint"),
                                              critical=["c"]))
    empty = spark.createDataFrame([], "id string, c string")
    e = quality.gate_null_pct(quality.gate_metrics(empty, "id", ["c"]), "t", ["c"]).first()
    assert (e.value, e.status) == (0.0, "PASS")


def test_fk_orphans_and_grain(spark):
    fact = spark.createDataFrame([("1", "a"), ("2", "b"), ("2", None)], "id string, fk string")
    dim = spark.createDataFrame([("a",), ("0",)], "id string")
    assert quality.fk_orphans(fact, "fk", dim).count() == 2
    assert [r.id for r in quality.grain_violations(fact, "id").collect()] == ["2"]


# ----------------------------------------------------------------- upsert

def test_upsert_semantics_and_idempotence(spark):
    target = spark.createDataFrame([("1", "a", 10, dt.datetime(2024, 1, 1)), ("2", "b", 20, dt.datetime(2024, 1, 1))],
                                   "id string, name string, qty int, d timestamp_ntz")
    delta = spark.createDataFrame([("2", 21, dt.datetime(2024, 1, 2)), ("2", 22, dt.datetime(2024, 1, 3)),
                                   ("3", 30, dt.datetime(2024, 1, 3))], "id string, qty bigint, d timestamp_ntz")
    once = up.upsert(target, delta, "id", "d")
    got = {r.id: (r.name, r.qty) for r in once.collect()}
    assert got == {"1": ("a", 10), "2": ("b", 22), "3": (None, 30)}
    assert once.schema == target.schema
    twice = up.upsert(once, delta, "id", "d")
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))
    c = up.upsert_counts(target, delta, "id", "d").first()
    assert (c.inserts, c.updates) == (1, 1)


def test_delta_key_check(spark):
    d = spark.createDataFrame([("1",), ("1",), (None,)], "id string")
    r = up.check_delta_keys(d).first()
    assert (r.null_keys, r.duplicate_keys) == (1, 1)
    with pytest.raises(up.DeltaKeyError):
        up.assert_delta_keys(d)


def test_latest_per_key_ties_are_deterministic(spark):
    d = spark.createDataFrame([("1", dt.datetime(2024, 1, 1), "x"), ("1", dt.datetime(2024, 1, 1), "y"),
                               ("1", None, "z")], "id string, d timestamp_ntz, v string")
    assert up.latest_per_key(d, "id", "d").first().v == "y"


# ------------------------------------------------------------ control plane

def test_load_plan_ladder(spark):
    now = dt.datetime(2024, 3, 1)
    wm = spark.createDataFrame([
        ("no_wm", None, None, None, None, 0, None),
        ("fails", dt.datetime(2024, 2, 1), 1, dt.datetime(2024, 2, 20), None, 3, None),
        ("old", dt.datetime(2024, 2, 1), 1, dt.datetime(2024, 1, 31), None, 2, None),
        ("young", dt.datetime(2024, 2, 1), 1, dt.datetime(2024, 1, 31, 0, 0, 1), None, 0, None),
        ("never_full", dt.datetime(2024, 2, 1), 1, None, None, 0, None),
    ], control.WATERMARK_SCHEMA)
    tables = spark.createDataFrame([("missing", False), ("no_wm", True), ("fails", True), ("old", True),
                                    ("young", True), ("never_full", True), ("unknown", True)],
                                   "table_name string, exists boolean")
    plan = {r.table_name: (r.mode, r.reason) for r in control.load_plan(tables, wm, now).collect()}
    assert plan == {
        "missing": ("full", "table_missing"), "no_wm": ("full", "no_watermark"),
        "fails": ("full", "too_many_failures"), "old": ("full", "full_load_expired"),
        "young": ("incremental", "incremental"), "never_full": ("incremental", "incremental"),
        "unknown": ("full", "no_watermark"),
    }


def test_advance_watermark_never_back_and_first_failure(spark):
    wm = spark.createDataFrame([("a", dt.datetime(2024, 2, 1), 10, None, None, 2, None)], control.WATERMARK_SCHEMA)
    res = spark.createDataFrame([("a", "completed", dt.datetime(2024, 1, 1), 5, False),
                                 ("b", "failed", None, 0, False)],
                                "table_name string, status string, max_date timestamp_ntz, rows_inserted bigint, full boolean")
    out = {r.table_name: r for r in control.advance_watermark(wm, res, dt.datetime(2024, 2, 2)).collect()}
    assert out["a"].last_extracted_date == dt.datetime(2024, 2, 1)
    assert (out["a"].total_rows, out["a"].consecutive_failures) == (15, 0)
    assert out["b"].last_extracted_date is None and out["b"].consecutive_failures == 1


def test_delta_batches_partition_the_delta(spark):
    df = spark.range(0, 2503).select(F.col("id").cast("string").alias("id"),
                                     (ts_lit(dt.datetime(2024, 1, 1)) + F.expr("make_interval(0,0,0,0,0,0,id % 97)"))
                                     .cast("timestamp_ntz").alias("d"))
    for parts in (1, 7):
        b = ingest.delta_batches(df, "d", "id", 1000, partitions=parts)
        rows = b.select("row_no", "batch_no").collect()
        assert sorted(r.row_no for r in rows) == list(range(1, 2504))
        man = ingest.batch_manifest(b, "d", "id").orderBy("batch_no").collect()
        assert [r.rows for r in man] == [1000, 1000, 503]
        for lo, hi in zip(man, man[1:]):
            assert (lo.hi_date, lo.hi_id) < (hi.lo_date, hi.lo_id)


def test_id_range_chunks_skip_empty(spark):
    df = spark.createDataFrame([(1,), (2,), (10,)], "id long")
    rows = ingest.id_range_chunks(df, "id", 5).orderBy("chunk").collect()
    assert [(r.start_id, r.end_id, r.rows) for r in rows] == [(1, 2, 2), (9, 10, 1)]


def test_incremental_scan_strict(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 2),), (None,)], "d timestamp_ntz")
    assert ingest.incremental_scan(df, "d", dt.datetime(2024, 1, 1)).count() == 1
    assert ingest.incremental_scan(df, "d", None).count() == 3


def test_pending_batches(spark):
    man = spark.createDataFrame([("t", "r", i) for i in range(4)], "table_name string, run_id string, batch_no int")
    prog = spark.createDataFrame([("t", "r", 0, "completed"), ("t", "r", 1, "failed")],
                                 "table_name string, run_id string, batch_no int, status string")
    assert sorted(r.batch_no for r in control.pending_batches(man, prog).collect()) == [1, 2, 3]


# -------------------------------------------------------------- measures

def test_custom_month_period_boundaries(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 25),), (dt.date(2024, 1, 26),), (dt.date(2024, 12, 26),)], "d date")
    got = [r[0] for r in df.select(star.custom_month_period("d")).collect()]
    assert got == [dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2025, 1, 1)]


def test_resolve_periods_skips_missing_calendar_period(spark):
    fact = spark.createDataFrame([(dt.datetime(2024, 3, 10),)], "create_date timestamp_ntz")
    cal = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 3, 1),)], "custom_month_period date")
    r = ms.resolve_periods(fact, "create_date", cal).first()
    assert (r.current_period, r.previous_period) == (dt.date(2024, 3, 1), dt.date(2024, 1, 1))


def test_zero_denominators(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "a long, b long")
    assert [r[0] for r in df.select(ms.ratio(F.col("a"), F.col("b"))).collect()] == [None, None]
    assert [r[0] for r in df.select(ms.ratio(F.col("a"), F.col("b"), F.lit(0.0))).collect()] == [0.0, 0.0]


def test_latest_wage_ties_take_max(spark):
    c = spark.createDataFrame([("e", dt.datetime(2024, 1, 1), Decimal("10")), ("e", dt.datetime(2024, 2, 1), Decimal("5")),
                               ("e", dt.datetime(2024, 2, 1), Decimal("7"))], "employee_id string, create_date timestamp_ntz, wage decimal(18,2)")
    assert hr.latest_wage(c).first().latest_wage == Decimal("7.00")


def test_turnover_employee_in_both_sets(spark):
    a = spark.createDataFrame([("e1", "20240101"), ("e1", "0"), ("e2", "0"), ("e3", "20990101")],
                              "employee_id string, departure_date string")
    r = hr.turnover_ratio(a, dt.date(2024, 6, 1)).first()
    assert (r.departed, r.active) == (1, 2) and abs(r.turnover_pct - 1 / 1.5 * 100) < 1e-9


def test_absenteeism_denominator_counts_all_employees(spark):
    leaves = spark.createDataFrame([("1", 11)], "leave_type_id string, number_of_days int")
    emps = spark.createDataFrame([(str(i),) for i in range(10)], "id string")
    assert abs(hr.absenteeism(leaves, emps).first().absenteeism_pct - 5.0) < 1e-12


def test_payroll_counts_departure_month(spark):
    c = spark.createDataFrame([("1", dt.datetime(2024, 1, 15), dt.datetime(2024, 2, 10), Decimal("100")),
                               ("2", dt.datetime(2023, 6, 1), None, Decimal("50"))],
                              "id string, create_date timestamp_ntz, departure_date timestamp_ntz, wage decimal(18,2)")
    got = {r.month: (r.payroll_total, r.active_contracts)
           for r in hr.payroll_monthly(c, dt.date(2024, 1, 1), dt.date(2024, 3, 1)).collect()}
    assert got == {"2024-01": (150.0, 2), "2024-02": (150.0, 2), "2024-03": (50.0, 1)}


def test_duplicate_normalised_rbe_label_is_rejected(spark):
    orders = spark.createDataFrame([("1", "sale", " Paid")], "id string, state string, rbe_status string")
    audit = spark.createDataFrame([], "sale_order_id bigint, date_last_state_change_key string")
    rbe = star.static_dimension(spark, [("1", "Paid"), ("2", " PAID ")], ["id", "label"])
    with pytest.raises(star.DimensionKeyError):
        star.orders_resolved(orders, audit, star.dim_sale_status(spark), rbe)
