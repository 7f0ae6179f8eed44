"""HR measures over the employee-activity and leave facts (group F, HR).

``as_of`` replaces the current date. Monthly series are built from per-month
aggregates (one row per month), never by exploding facts into months:
payroll uses +wage/−wage change events per month and a running sum over
the small monthly frame.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.keys import SENTINEL_KEY, date_lit, parse_date_key
from starloom.operators.measures_sales import ratio

# Working days per month in the absenteeism ratio.
WORKING_DAYS_PER_MONTH = 22


def _d(v) -> Column:
    return date_lit(v)


def _blank_key(col: str) -> Column:
    k = F.trim(F.col(col))
    return F.col(col).isNull() | (k == "") | (k == SENTINEL_KEY)


def headcount(activity: DataFrame, as_of: dt.date, by: list[str] = ()) -> DataFrame:
    """Distinct employees with a contract started by ``as_of`` and not left by then."""
    dep = parse_date_key("departure_date")
    active = (F.col("contract_create_date").cast("date") <= _d(as_of)) & (dep.isNull() | (dep > _d(as_of)))
    return activity.where(active).groupBy(*by).agg(F.count_distinct("employee_id").alias("headcount"))


def entries_exits(activity: DataFrame) -> DataFrame:
    """Entries (contract starts) and exits (departures) per calendar month."""
    starts = activity.where(F.col("contract_create_date").isNotNull()).select(
        F.trunc(F.col("contract_create_date").cast("date"), "month").alias("month"), F.lit("entry").alias("kind"))
    exits = activity.select(F.trunc(parse_date_key("departure_date"), "month").alias("month"),
                            F.lit("exit").alias("kind")).where(F.col("month").isNotNull())
    ev = starts.unionByName(exits)
    return ev.groupBy("month").agg(F.count_if(F.col("kind") == "entry").alias("entries"),
                                   F.count_if(F.col("kind") == "exit").alias("exits"))


def turnover_ratio(activity: DataFrame, as_of: dt.date) -> DataFrame:
    """Turnover % = departed / ((departed + active) / 2) × 100.

    Departed: distinct employees with a parsed departure on/before ``as_of``;
    active: distinct employees with a sentinel/blank departure key. One
    employee can be in both sets. Flags are reduced per employee first (one
    shuffle, partial aggregation) instead of two distinct counts.
    """
    dep = parse_date_key("departure_date")
    per = activity.groupBy("employee_id").agg(
        F.max(F.when(dep <= _d(as_of), 1).otherwise(0)).alias("_dep"),
        F.max(F.when(_blank_key("departure_date"), 1).otherwise(0)).alias("_act"))
    g = per.where(F.col("employee_id").isNotNull()).agg(
        F.sum("_dep").cast("bigint").alias("departed"), F.sum("_act").cast("bigint").alias("active"))
    return g.withColumn("turnover_pct",
                        ratio(F.col("departed"), (F.col("departed") + F.col("active")).cast("double") / 2.0) * 100.0)


def _age(birth: Column, as_of: dt.date) -> Column:
    """Age in whole years on ``as_of`` (one less before the birthday)."""
    b = birth.cast("date")
    before_birthday = (F.month(b) > as_of.month) | ((F.month(b) == as_of.month) & (F.dayofmonth(b) > as_of.day))
    return (F.lit(as_of.year) - F.year(b) - F.when(before_birthday, 1).otherwise(0)).cast("int")


def age_bands(employees: DataFrame, as_of: dt.date, width: int = 10) -> DataFrame:
    """Employees and average age per band of ``width`` years (age in whole years)."""
    e = employees.where(F.col("birth_date").isNotNull()).withColumn("age", _age(F.col("birth_date"), as_of))
    return e.groupBy((F.floor(F.col("age") / width) * width).cast("int").alias("age_band")).agg(
        F.count(F.lit(1)).alias("employees"),
        (F.sum("age").cast("double") / F.count(F.lit(1)).cast("double")).alias("avg_age"))


def average_age(employees: DataFrame, as_of: dt.date) -> DataFrame:
    """One row: employees with a birth date and their average age in whole years."""
    e = employees.where(F.col("birth_date").isNotNull()).select(_age(F.col("birth_date"), as_of).alias("age"))
    return e.agg(F.count(F.lit(1)).alias("employees"),
                 (F.sum("age").cast("double") / F.count(F.lit(1)).cast("double")).alias("average_age"))


def workforce_split(employees: DataFrame, dims: tuple[str, ...] = ("job", "gender", "department_id", "company_id")) -> DataFrame:
    """Headcount split by each of ``dims`` in one grouping-sets pass."""
    g = employees.groupingSets([[d] for d in dims], *dims).agg(
        F.count_distinct("id").alias("employees"), F.grouping_id().alias("_gid"))
    n = len(dims)
    label = None
    for i, d in enumerate(dims):
        gid = (1 << n) - 1 - (1 << (n - 1 - i))
        cond = F.col("_gid") == gid
        label = F.when(cond, F.lit(d)) if label is None else label.when(cond, F.lit(d))
    value = F.coalesce(*[F.col(d).cast("string") for d in dims])
    return g.select(label.alias("dimension"), value.alias("value"), "employees")


def absenteeism(leaves: DataFrame, employees: DataFrame, by: list[str] = ("leave_type_id",),
                days_per_month: int = WORKING_DAYS_PER_MONTH) -> DataFrame:
    """Leave days / (headcount × 22) × 100 per ``by`` group; the headcount
    counts **all** employees (filters on leaves removed), alternative 0."""
    hc = employees.agg(F.count_distinct("id")).scalar()
    g = leaves.groupBy(*by).agg(F.sum("number_of_days").alias("leave_days"))
    return g.withColumn("headcount", hc).withColumn(
        "absenteeism_pct",
        ratio(F.col("leave_days"), F.col("headcount") * days_per_month, F.lit(0.0)) * 100.0)


def leave_by_type(leaves: DataFrame, by: list[str] = ("leave_type_id",)) -> DataFrame:
    """Requests and days per leave type."""
    return leaves.groupBy(*by).agg(F.count(F.lit(1)).alias("requests"),
                                   F.sum("number_of_days").alias("leave_days"))


def leave_monthly_long(leaves: DataFrame, date_col: str = "request_date_from") -> DataFrame:
    """Leave days per month and leave type: the complete result."""
    month = F.trunc(F.col(date_col).cast("date"), "month").alias("month")
    return leaves.groupBy(month, "leave_type_id").agg(F.sum("number_of_days").cast("bigint").alias("leave_days"))


def leave_monthly(leaves: DataFrame, types: list[str], date_col: str = "request_date_from") -> DataFrame:
    """Leave days per month, one column per listed leave type and one for all others."""
    long = leave_monthly_long(leaves, date_col)
    days = lambda hit: F.coalesce(F.sum(F.when(hit, F.col("leave_days"))), F.lit(0)).cast("bigint")
    listed = F.coalesce(F.col("leave_type_id").isin(list(types)), F.lit(False))
    return long.groupBy("month").agg(*[days(F.col("leave_type_id") == t).alias(f"type_{t}") for t in types],
                                     days(~listed).alias("type_other"))


def leave_by_department(leaves: DataFrame) -> DataFrame:
    return leaves.groupBy("department_id").agg(F.sum("number_of_days").alias("leave_days"))


def latest_wage(contracts: DataFrame, employee: str = "employee_id", date_col: str = "create_date",
                wage: str = "wage") -> DataFrame:
    """Per employee: the max wage among contracts at the employee's latest date.

    ``max(struct(date, wage))`` is exact on ties (the higher wage of the
    latest date wins) and aggregates partially before the shuffle.
    """
    w = contracts.where(F.col(wage).isNotNull())
    return w.groupBy(employee).agg(F.max(F.struct(F.col(date_col).alias("d"), F.col(wage).alias("w"))).alias("_m")) \
        .select(employee, F.col("_m.d").alias("latest_date"), F.col("_m.w").alias("latest_wage"))


def avg_latest_wage(contracts: DataFrame, employee: str = "employee_id", date_col: str = "create_date",
                    wage: str = "wage") -> DataFrame:
    """Average over employees of their latest wage (exact sum, then divide)."""
    lw = latest_wage(contracts, employee, date_col, wage)
    return lw.agg(F.count(F.lit(1)).alias("employees"),
                  (F.sum("latest_wage").cast("double") / F.count(F.lit(1)).cast("double")).alias("avg_latest_wage"))


def payroll_monthly(contracts: DataFrame, start: dt.date, end: dt.date, date_col: str = "create_date",
                    end_col: str = "departure_date", wage: str = "wage") -> DataFrame:
    """Monthly payroll total and average over active contracts (ours).

    A contract counts in a month when it starts by the month's end and has
    not departed before the month's start. Each contract adds its wage at
    its start month and removes it after its departure month; the monthly
    deltas (one row per month) are summed cumulatively over the month
    calendar from ``start`` to ``end``.
    """
    first = _d(start.replace(day=1))
    s_m = F.greatest(F.trunc(F.col(date_col).cast("date"), "month"), first)
    e_m = F.add_months(F.trunc(F.col(end_col).cast("date"), "month"), 1)
    c = contracts.where(F.col(wage).isNotNull() & (F.col(date_col).cast("date") <= F.last_day(_d(end)))
                        & (F.col(end_col).isNull() | (e_m > s_m)))
    plus = c.select(s_m.alias("month"), F.col(wage).alias("dw"), F.lit(1).alias("dn"))
    minus = c.where(F.col(end_col).isNotNull()).select(
        e_m.alias("month"), (-F.col(wage)).alias("dw"), F.lit(-1).alias("dn"))
    deltas = plus.unionByName(minus).groupBy("month").agg(F.sum("dw").alias("dw"), F.sum("dn").alias("dn"))
    spark = contracts.sparkSession
    months = spark.range(1).select(F.explode(F.sequence(first, _d(end.replace(day=1)),
                                                        F.expr("interval 1 month"))).alias("month"))
    w = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    j = months.join(deltas, "month", "left")
    run = j.select("month", F.sum(F.coalesce("dw", F.lit(0))).over(w).alias("payroll"),
                   F.sum(F.coalesce("dn", F.lit(0))).over(w).alias("contracts"))
    return run.select(F.date_format("month", "yyyy-MM").alias("month"), F.year("month").alias("year"),
                      F.col("payroll").cast("double").alias("payroll_total"),
                      F.col("contracts").cast("bigint").alias("active_contracts"),
                      ratio(F.col("payroll"), F.col("contracts")).alias("payroll_avg"))


def payroll_by_year(monthly: DataFrame, years: list[int]) -> DataFrame:
    """Years overlaid: one row per month of year, one column per year.

    The pivot values are given (the calendar's years), so no job is spent
    discovering them; the input is the small monthly frame. A year that is
    not listed raises."""
    known = F.assert_true(F.col("year").isin(list(years)), F.concat(F.lit("year not listed: "), F.col("year")))
    monthly = monthly.where(known.isNull())
    return monthly.groupBy(F.substring("month", 6, 2).alias("month_of_year")).pivot("year", years) \
        .agg(F.max("payroll_total"))


def contract_share(activity: DataFrame, by: str = "contract_type_id") -> DataFrame:
    """Contracts and wages per contract type with each type's share of contracts."""
    c = activity.where(F.col("contract_id") != SENTINEL_KEY)
    g = c.groupBy(by).agg(F.count(F.lit(1)).alias("contracts"), F.sum("monthly_wage").alias("wage_total"))
    return g.select(by, "contracts", F.col("wage_total").cast("double").alias("wage_total"),
                    ratio(F.col("contracts"), F.sum("contracts").over(Window.partitionBy())).alias("share"))


def wage_by(activity: DataFrame, by: str) -> DataFrame:
    """Total and average wage per job or department."""
    c = activity.where(F.col("monthly_wage").isNotNull())
    return c.groupBy(by).agg(F.sum("monthly_wage").cast("double").alias("wage_total"),
                             (F.sum("monthly_wage").cast("double") / F.count(F.lit(1)).cast("double"))
                             .alias("wage_avg"))


def employee_roster(activity: DataFrame, employees: DataFrame, year: int | None = None, job: str | None = None,
                    employee: str | None = None, month: int | None = None, company: str | None = None,
                    department: str | None = None) -> DataFrame:
    """Roster rows (employee, entry date, department, job, wage) with up to six optional filters."""
    e = employees.select(F.col("id").alias("employee_id"), "name", "gender")
    r = activity.join(e, "employee_id", "left")
    d = F.col("contract_create_date")
    preds = []
    if year is not None:
        preds.append(F.year(d) == year)
    if month is not None:
        preds.append(F.month(d) == month)
    if job is not None:
        preds.append(F.col("job_id") == job)
    if employee is not None:
        preds.append(F.col("employee_id") == employee)
    if company is not None:
        if "company_id" not in r.columns:
            raise ValueError("the roster has no company_id to filter by")
        preds.append(F.col("company_id") == company)
    if department is not None:
        preds.append(F.col("department_id") == department)
    for p in preds:
        r = r.where(p)
    return r.select("employee_id", "name", "gender", "department_id", "job_id", "contract_id",
                    F.col("contract_create_date").alias("entry_date"),
                    F.col("monthly_wage").cast("double").alias("monthly_wage"))
