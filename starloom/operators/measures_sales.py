"""Commercial measures over the CRM and sale-order facts (group F, sales).

Each measure is a grouped DataFrame function ``(frames..., by=[...]) ->
DataFrame``: the dashboard's filter context becomes ``by`` columns and
explicit filter frames; "remove filters" becomes an aggregate over the
unfiltered frame or a window partition without that column. The current date
becomes an ``as_of`` argument so results are deterministic.

Only small frames (one row per period, or per group of a grouped result)
use unpartitioned windows; facts are always aggregated first.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.keys import date_lit, parse_date_key
from starloom.operators.star import custom_month_period
from starloom.plans.ranges import stage_ranges
from starloom.plans.sizing import bounded_broadcast

# Annual sales target and working days per month.
ANNUAL_TARGET = 4_000_000
OPPORTUNITY = "opportunity"
SALE_STATE_ID = "2"      # dim_sale_status id of 'sale'
PAID_RBE_ID = "1"        # dim_rbe_status id of 'Paid'


def ratio(num: Column, den: Column, alt: Column | None = None) -> Column:
    """Safe division: NULL (or ``alt``) when the denominator is 0 or NULL."""
    r = F.try_divide(num.cast("double"), F.nullif(den.cast("double"), F.lit(0.0)))
    return r if alt is None else F.coalesce(r, alt)


def _is_opp(col: str = "type") -> Column:
    return F.col(col) == OPPORTUNITY


# ----------------------------------------------------------- opportunities

def total_opportunities(crm: DataFrame, by: list[str] = ()) -> DataFrame:
    """Rows of type ``opportunity``."""
    return crm.groupBy(*by).agg(F.count_if(_is_opp()).alias("total_opportunities"))


def win_loss_rates(crm: DataFrame, by: list[str] = ()) -> DataFrame:
    """Won / lost counts, their rates over all opportunities, and the
    conversion rate won / (won + lost) (ours)."""
    opp = crm.where(_is_opp())
    g = opp.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_opportunities"),
        F.count_if(F.col("won_status_id") == "won").alias("won"),
        F.count_if(F.col("won_status_id") == "lost").alias("lost"),
    )
    return g.select(*by, "total_opportunities", "won", "lost",
                    ratio(F.col("won"), F.col("total_opportunities")).alias("won_rate"),
                    ratio(F.col("lost"), F.col("total_opportunities")).alias("lost_rate"),
                    ratio(F.col("won"), F.col("won") + F.col("lost")).alias("conversion_rate"))


def stage_share(crm: DataFrame, by: list[str] = (), stage: str = "stage_id") -> DataFrame:
    """Share of opportunities per stage; the denominator drops only the stage
    filter and keeps the other ``by`` columns."""
    g = crm.where(_is_opp()).groupBy(*by, stage).agg(F.count(F.lit(1)).alias("opportunities"))
    w = Window.partitionBy(*by) if by else Window.partitionBy()
    return g.withColumn("share", ratio(F.col("opportunities"), F.sum("opportunities").over(w)))


def with_period(df: DataFrame, date_col: str, out: str = "period", close_day: int = 25) -> DataFrame:
    return df.withColumn(out, custom_month_period(date_col, close_day))


def resolve_periods(fact: DataFrame, date_col: str, calendar: DataFrame, close_day: int = 25) -> DataFrame:
    """One row: the latest fact date, its custom period, and the previous
    period = the greatest smaller period that exists in ``calendar``
    (``custom_month_period`` column), not the previous calendar month."""
    latest = fact.agg(F.max(F.col(date_col))).scalar()
    current = custom_month_period(latest, close_day)
    prev = calendar.where(F.col("custom_month_period") < current).agg(F.max("custom_month_period")).scalar()
    return fact.sparkSession.range(1).select(latest.alias("latest_date"), current.alias("current_period"),
                                             prev.alias("previous_period"))


def period_counts(fact: DataFrame, periods: DataFrame, date_col: str, value: Column | None = None,
                  close_day: int = 25, by: list[str] = ()) -> DataFrame:
    """Current and previous period totals (count of rows, or sum of ``value``).

    ``periods`` is the one-row frame of ``resolve_periods``; its values enter
    as scalar subqueries (evaluated once, no join)."""
    p = custom_month_period(date_col, close_day)
    v = F.lit(1) if value is None else value
    j = fact.withColumns({"current_period": periods.select("current_period").scalar(),
                          "previous_period": periods.select("previous_period").scalar()})
    return j.groupBy(*by).agg(
        F.sum(F.when(p == F.col("current_period"), v)).alias("current_value"),
        F.sum(F.when(p == F.col("previous_period"), v)).alias("previous_value"),
        F.max("current_period").alias("current_period"),
        F.max("previous_period").alias("previous_period"),
    )


def mom_pct(counts: DataFrame, by: list[str] = ()) -> DataFrame:
    """Month-over-month % = (current − previous) / previous (ratio ours)."""
    return counts.select(*by, "current_period", "previous_period", "current_value", "previous_value",
                         ratio(F.col("current_value") - F.col("previous_value"), F.col("previous_value"))
                         .alias("mom_pct"))


def monthly_series(fact: DataFrame, date_col: str, value: Column | None = None, by: list[str] = (),
                   close_day: int = 25) -> DataFrame:
    v = F.lit(1) if value is None else value
    return fact.groupBy(*by, custom_month_period(date_col, close_day).alias("period")).agg(F.sum(v).alias("value"))


def monthly_average(series: DataFrame, by: list[str] = ()) -> DataFrame:
    """Historic monthly average: average over periods of the per-period totals."""
    return series.groupBy(*by).agg(
        (F.sum("value").cast("double") / F.count(F.lit(1)).cast("double")).alias("monthly_average"),
        F.count(F.lit(1)).alias("periods"))


def trend_minmax(series: DataFrame, by: list[str] = ()) -> DataFrame:
    """Label only the minimum and maximum points of each monthly series."""
    w = Window.partitionBy(*by) if by else Window.partitionBy()
    lo, hi = F.min("value").over(w), F.max("value").over(w)
    return series.withColumn("label", F.when((F.col("value") == lo) | (F.col("value") == hi), F.col("value")))


# ------------------------------------------------------------- sale orders

def order_period(fact: DataFrame, key: str = "date_create_id", out: str = "period", close_day: int = 25) -> DataFrame:
    return fact.withColumn(out, custom_month_period(parse_date_key(key), close_day))


def by_existing_period(fact: DataFrame, period: Column, by: list[str], value: Column) -> DataFrame:
    """``value`` summed per (``by``, period), plus ``current_period`` and ``previous_period``.

    The current period is the fact's latest; the previous one is the greatest
    earlier period that exists in the fact, not the calendar month before.
    The fact is grouped once: the periods are read from the grouped rows by a
    scalar subquery over the same exchange (its second field keeps both
    plans alike).
    """
    g = fact.groupBy(*by, period.alias("period")).agg(F.sum(value).alias("value"))
    found = g.agg(F.struct(F.sort_array(F.collect_set("period"), asc=False).alias("periods"), F.max("value").alias("largest"))).scalar()
    periods = found.getField("periods")
    return g.withColumns({"current_period": F.get(periods, F.lit(0)), "previous_period": F.get(periods, F.lit(1))})


def mom_matrix(fact: DataFrame, by: list[str], value: str = "amount_untaxed",
               key: str = "date_create_id", close_day: int = 25) -> DataFrame:
    """Current vs previous existing custom month per ``by`` (e.g. project type)."""
    g = by_existing_period(fact, custom_month_period(parse_date_key(key), close_day), by, F.col(value)).groupBy(*by).agg(
        F.sum(F.when(F.col("period") == F.col("current_period"), F.col("value"))).alias("current_value"),
        F.sum(F.when(F.col("period") == F.col("previous_period"), F.col("value"))).alias("previous_value"))
    return g.select(*by, F.col("previous_value").cast("double").alias("previous_value"),
                    F.col("current_value").cast("double").alias("current_value"),
                    ratio(F.col("current_value") - F.col("previous_value"), F.col("previous_value")).alias("mom_pct"))


def signed_revenue(fact: DataFrame, by: list[str] = (), value: str = "amount_untaxed") -> DataFrame:
    """Signed revenue (status sale) and collected revenue (sale with RBE Paid)."""
    signed = F.col("id_state") == SALE_STATE_ID
    return fact.groupBy(*by).agg(
        F.sum(F.when(signed, F.col(value))).cast("double").alias("signed_revenue"),
        F.sum(F.when(signed & (F.col("rbe_status_id") == PAID_RBE_ID), F.col(value))).cast("double")
        .alias("collected_revenue"),
        F.count_if(signed).alias("signed_orders"))


def cancel_share(fact: DataFrame, agency: str = "team_id", product: str = "project_type_id") -> DataFrame:
    """Cancellation rate per agency × product and each product's share of
    the agency's cancellations (100 % stacked bars). Cancelled = has a loss reason."""
    cancelled = F.col("lost_reason_id") != "0"
    g = fact.groupBy(agency, product).agg(F.count(F.lit(1)).alias("orders"),
                                          F.count_if(cancelled).alias("cancelled"))
    w = Window.partitionBy(agency)
    return g.withColumn("cancel_rate", ratio(F.col("cancelled"), F.col("orders"))) \
        .withColumn("share_of_agency", ratio(F.col("cancelled"), F.sum("cancelled").over(w)))


def loss_reasons(fact: DataFrame) -> DataFrame:
    """Cancelled orders per loss reason and share of all cancellations."""
    g = fact.where(F.col("lost_reason_id") != "0").groupBy("lost_reason_id") \
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("amount_untaxed").cast("double").alias("amount"))
    return g.withColumn("share", ratio(F.col("orders"), F.sum("orders").over(Window.partitionBy())))


def sales_portfolio(fact: DataFrame, vendors: DataFrame, clients: DataFrame, status: DataFrame) -> DataFrame:
    """Line-by-line portfolio: order, vendor, client, status label, signature date, amount."""
    v = vendors.select(F.col("id").alias("vendor_id"), F.col("name").alias("vendor_name"))
    c = clients.select(F.col("id").alias("client_id"), F.col("name").alias("client_name"))
    s = F.broadcast(status.select(F.col("id").alias("id_state"), F.col("state").alias("status")))
    return fact.join(v, "vendor_id", "left").join(c, "client_id", "left").join(s, "id_state", "left").select(
        "id", "order_name", "vendor_name", "client_name", "status", "date_signed_id",
        F.col("amount_untaxed").cast("double").alias("amount_untaxed"))


# ----------------------------------------------------------------- targets

def adjusted_target(vendors: DataFrame, year: int, annual: float = ANNUAL_TARGET, by: list[str] = ("id",)) -> DataFrame:
    """Prorated annual target: begin = MIN(begin_date) in context; 12 months
    if it is before ``year``, else 13 − month(begin); target = months/12 × annual."""
    g = vendors.groupBy(*by).agg(F.min("begin_date").alias("begin_date"))
    months = F.when(F.year("begin_date") < year, F.lit(12)).otherwise(13 - F.month("begin_date"))
    return g.withColumn("months_active", months) \
        .withColumn("adjusted_target", F.col("months_active").cast("double") / 12.0 * float(annual))


def target_to_date(targets: DataFrame, year: int, as_of: dt.date, annual: float = ANNUAL_TARGET) -> DataFrame:
    """Cumulative prorated target through ``as_of``'s month (ours): the
    active months of ``year`` up to that month, × annual / 12."""
    start_m = F.when(F.year("begin_date") < year, F.lit(1)).otherwise(F.month("begin_date"))
    end_m = F.lit(as_of.month if as_of.year == year else (12 if as_of.year > year else 0))
    m = F.greatest(end_m - start_m + 1, F.lit(0))
    return targets.withColumn("months_to_date", m) \
        .withColumn("target_to_date", F.col("months_to_date").cast("double") / 12.0 * float(annual))


def target_gauge(fact: DataFrame, targets_to_date: DataFrame, year: int, vendor: str = "vendor_id") -> DataFrame:
    """Achieved signed revenue in ``year`` vs the target to date: gap and ahead/behind."""
    signed_year = F.left(F.col("date_signed_id"), F.lit(4)) == str(year)
    ach = fact.where((F.col("id_state") == SALE_STATE_ID) & signed_year).groupBy(vendor) \
        .agg(F.sum("amount_untaxed").alias("achieved"))
    t = targets_to_date.select(F.col("id").alias(vendor), "adjusted_target", "target_to_date")
    j = t.join(ach, vendor, "left").withColumn("achieved", F.coalesce(F.col("achieved").cast("double"), F.lit(0.0)))
    return j.withColumn("gap", F.col("achieved") - F.col("target_to_date")) \
        .withColumn("position", F.when(F.col("gap") >= 0, "ahead").otherwise("behind"))


def prev_month_revenue(fact: DataFrame, project_types: DataFrame | None = None, vendors: DataFrame | None = None,
                       by: list[str] = ("vendor_id", "project_type_id"), close_day: int = 25) -> DataFrame:
    """Previous-month collected revenue: state sale, calendar month before
    the latest last-state-change period over the whole fact; only the
    project-type and vendor selections are kept (applied as semi joins on
    the grouped rows)."""
    sold = F.when(F.col("id_state") == SALE_STATE_ID, F.col("amount_untaxed"))
    keys = list(dict.fromkeys([*by, "project_type_id", "vendor_id"]))
    g = by_existing_period(fact.withColumn("_sold", F.when(F.col("id_state") == SALE_STATE_ID, 1)),
                           custom_month_period(parse_date_key("date_last_state_update_id"), close_day), [*keys, "_sold"], sold)
    sel = g.where((F.col("_sold") == 1) & (F.col("period") == F.add_months("current_period", -1)))
    if project_types is not None:
        sel = sel.join(project_types.select(F.col("id").alias("project_type_id")).distinct(), "project_type_id", "left_semi")
    if vendors is not None:
        sel = sel.join(vendors.select(F.col("id").alias("vendor_id")).distinct(), "vendor_id", "left_semi")
    return sel.groupBy(*by).agg(F.sum("value").cast("double").alias("prev_month_revenue"))


def kpi_delta(fact: DataFrame, by: list[str] = ("vendor_id",), close_day: int = 25) -> DataFrame:
    """Signed revenue in the current vs the previous existing custom month (by
    creation date): Δ and Δ %; periods are those of the whole fact, rows those
    with a signed order."""
    signed = F.col("id_state") == SALE_STATE_ID
    flagged = fact.withColumn("_signed", F.when(signed, 1).otherwise(0))
    g = by_existing_period(flagged, custom_month_period(parse_date_key("date_create_id"), close_day), [*by, "_signed"], F.col("amount_untaxed"))
    in_period = lambda p: F.coalesce(F.sum(F.when(F.col("period") == F.col(p), F.col("value"))), F.lit(0)).cast("double")
    g = g.where("_signed = 1").groupBy(*by).agg(in_period("current_period").alias("current_value"),
                                                in_period("previous_period").alias("previous_value"))
    return g.withColumn("delta", F.col("current_value") - F.col("previous_value")) \
        .withColumn("delta_pct", ratio(F.col("delta"), F.col("previous_value")))


def vendor_rank(fact: DataFrame, agency: str = "team_id", vendor: str = "vendor_id") -> DataFrame:
    """Signed revenue per agency and vendor, its rank in the agency, and the
    company-wide rank of the vendor's revenue over all agencies (ties share a
    rank).

    Both ranks are taken from one grouping of the fact, which is written once
    by ranges of the vendor's total (``stage_ranges``): a vendor's rows share a
    range, so ranks need one window per range and the ranges' offsets.
    """
    g = fact.where(F.col("id_state") == SALE_STATE_ID).groupBy(agency, vendor) \
        .agg(F.sum("amount_untaxed").alias("revenue"))
    whole = g.withColumn("_all", F.sum("revenue").over(Window.partitionBy(vendor)))
    first = F.row_number().over(Window.partitionBy(vendor).orderBy(agency)) == 1
    ranged = stage_ranges(whole.withColumn("_first", first.cast("int")), [F.desc("_all")])
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    counts = ranged.groupBy("_pid").agg(F.sum("_first").alias("_n")).select("_pid", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    above = Window.partitionBy("_pid").orderBy(F.desc("_all")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    tied = Window.partitionBy("_pid", "_all")
    vendors_above = F.sum("_first").over(above) - F.sum("_first").over(tied)
    in_agency = F.rank().over(Window.partitionBy(agency).orderBy(F.desc("revenue")))
    return ranged.join(F.broadcast(counts), "_pid").select(
        agency, vendor, F.col("revenue").cast("double").alias("revenue"), in_agency.alias("rank_in_agency"),
        (F.col("_off") + vendors_above + 1).cast("int").alias("rank_in_company"))


def sales_mix(fact: DataFrame, dims: tuple[str, str] = ("payment_method_id", "project_type_id")) -> DataFrame:
    """Mix by payment method and by project type in one grouping-sets pass,
    with each group's share of the grand total (read from the grand-total
    row of the same small grouped frame)."""
    a, b = dims
    g = fact.groupingSets([[a], [b], []], a, b).agg(
        F.count(F.lit(1)).alias("orders"), F.sum("amount_untaxed").alias("amount"),
        F.grouping_id().alias("_gid"))
    w = Window.partitionBy()
    total_amount = F.max(F.when(F.col("_gid") == 3, F.col("amount"))).over(w)
    total_orders = F.max(F.when(F.col("_gid") == 3, F.col("orders"))).over(w)
    return g.select(
        F.when(F.col("_gid") == 1, F.lit(a)).when(F.col("_gid") == 2, F.lit(b)).otherwise(F.lit("total"))
        .alias("dimension"),
        F.coalesce(F.col(a), F.col(b)).alias("value"),
        "orders", F.col("amount").cast("double").alias("amount"),
        ratio(F.col("amount"), total_amount).alias("amount_share"),
        ratio(F.col("orders"), total_orders).alias("order_share"))


def days_in_status(fact: DataFrame, as_of: dt.date) -> DataFrame:
    """Days since the last state change; NULL when the key is the sentinel."""
    d = parse_date_key("date_last_state_update_id")
    return fact.select("id", "date_last_state_update_id",
                       F.datediff(date_lit(as_of), d).alias("days_in_status"))


def vendor_scope(fact: DataFrame, vendors: DataFrame, email: str) -> DataFrame:
    """Row-level security: only the facts of the vendor whose e-mail is the caller's."""
    me = vendors.where(F.lower(F.col("email")) == email.lower()).select(F.col("id").alias("vendor_id"))
    return fact.join(bounded_broadcast(me), "vendor_id", "left_semi")
