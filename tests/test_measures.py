"""Measure semantics on hand-made frames."""

import datetime as dt
from decimal import Decimal

from starloom.operators import measures_sales as ms

D = "decimal(18,2)"


def test_adjusted_target_prorates_by_start_month(spark):
    v = spark.createDataFrame([("a", dt.date(2000, 5, 1)), ("a", dt.date(2001, 6, 1)), ("b", dt.date(2001, 3, 15)),
                               ("c", dt.date(2001, 10, 2))], "id string, begin_date date")
    t = {r.id: r for r in ms.target_to_date(ms.adjusted_target(v, 2001), 2001, dt.date(2001, 8, 1)).collect()}
    assert (t["a"].begin_date, t["a"].months_active, t["a"].adjusted_target) == (dt.date(2000, 5, 1), 12, 4_000_000.0)
    assert t["b"].months_active == 10 and abs(t["b"].adjusted_target - 10 / 12 * 4_000_000) < 1e-6
    assert (t["a"].months_to_date, t["b"].months_to_date, t["c"].months_to_date) == (8, 6, 0)
    assert t["c"].target_to_date == 0.0


def _fact(spark, rows):
    return spark.createDataFrame(
        rows, f"vendor_id string, project_type_id string, team_id string, id_state string, "
              f"date_last_state_update_id string, date_create_id string, amount_untaxed {D}")


def test_prev_month_revenue_keeps_only_slicers(spark):
    f = _fact(spark, [
        ("v1", "p1", "t1", "2", "20240310", "20240101", Decimal("5")),    # current month: defines "now"
        ("v1", "p1", "t1", "2", "20240210", "20240101", Decimal("10")),   # previous month, sale
        ("v1", "p1", "t9", "2", "20240215", "20240101", Decimal("20")),   # other team: team filter is removed
        ("v1", "p2", "t1", "2", "20240220", "20240101", Decimal("40")),   # project type not selected
        ("v2", "p1", "t1", "2", "20240205", "20240101", Decimal("80")),   # vendor not selected
        ("v1", "p1", "t1", "1", "20240205", "20240101", Decimal("160")),  # not a sale
        ("v1", "p1", "t1", "2", "20240226", "20240101", Decimal("320")),  # day 26 belongs to March
    ])
    types = spark.createDataFrame([("p1",)], "id string")
    vendors = spark.createDataFrame([("v1",)], "id string")
    rows = ms.prev_month_revenue(f, types, vendors, by=["vendor_id"]).collect()
    assert [(r.vendor_id, r.prev_month_revenue) for r in rows] == [("v1", 30.0)]


def test_kpi_delta_and_zero_previous(spark):
    f = _fact(spark, [
        ("v1", "p", "t", "2", "0", "20240310", Decimal("30")),
        ("v1", "p", "t", "2", "0", "20240210", Decimal("10")),
        ("v2", "p", "t", "2", "0", "20240305", Decimal("7")),
    ])
    got = {r.vendor_id: (r.current_value, r.previous_value, r.delta, r.delta_pct) for r in ms.kpi_delta(f).collect()}
    assert got == {"v1": (30.0, 10.0, 20.0, 2.0), "v2": (7.0, 0.0, 7.0, None)}


def test_vendor_rank_ties_share_rank(spark):
    f = _fact(spark, [("a", "p", "t1", "2", "0", "0", Decimal("10")), ("b", "p", "t1", "2", "0", "0", Decimal("10")),
                      ("c", "p", "t2", "2", "0", "0", Decimal("5")), ("d", "p", "t1", "1", "0", "0", Decimal("99"))])
    got = {r.vendor_id: (r.rank_in_agency, r.rank_in_company) for r in ms.vendor_rank(f).collect()}
    assert got == {"a": (1, 1), "b": (1, 1), "c": (1, 3)}


def test_stage_share_denominator_per_other_dimension(spark):
    crm = spark.createDataFrame([("opportunity", "v1", "s1"), ("opportunity", "v1", "s2"), ("opportunity", "v1", "s2"),
                                 ("opportunity", "v2", "s1"), ("lead", "v2", "s2")],
                                "type string, vendor_id string, stage_id string")
    got = {(r.vendor_id, r.stage_id): r.share for r in ms.stage_share(crm, ["vendor_id"]).collect()}
    assert got == {("v1", "s1"): 1 / 3, ("v1", "s2"): 2 / 3, ("v2", "s1"): 1.0}


def test_sales_mix_shares(spark):
    f = spark.createDataFrame([("cash", "pv", Decimal("10")), ("loan", "pv", Decimal("30")), ("cash", "pac", Decimal("60"))],
                              f"payment_method_id string, project_type_id string, amount_untaxed {D}")
    rows = ms.sales_mix(f).collect()
    by = {}
    for r in rows:
        by.setdefault(r.dimension, {})[r.value] = (r.orders, r.amount_share)
    assert by["total"] == {None: (3, 1.0)}
    assert by["payment_method_id"] == {"cash": (2, 0.7), "loan": (1, 0.3)}
    assert by["project_type_id"] == {"pv": (2, 0.4), "pac": (1, 0.6)}
