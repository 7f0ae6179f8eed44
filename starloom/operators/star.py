"""Star-schema models: staging, dimensions and facts (DataFrame plans).

Every function takes DataFrames and returns a lazy DataFrame; Catalyst picks
the join strategies. Only static or explicitly bounded frames carry a
``broadcast`` hint; everything else is left to size statistics and AQE.
"""

from __future__ import annotations

import datetime as dt
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.keys import (
    SENTINEL_KEY,
    SENTINEL_LABEL,
    date_key,
    fk,
    json_label,
    normalized_label,
)
from starloom.plans.sizing import bounded_broadcast

# Status dimensions used by the sale-order fact.
SALE_STATUS_ROWS = [("1", "draft", "Quotation"), ("2", "sale", "Sales Order")]
RBE_STATUS_ROWS = [("1", "Paid"), ("2", " PENDING")]
LOOKUP_ROWS = 10_000


def spread_key(key: Column, keep: Column, row_id: Column) -> Column:
    """Join key that is ``key`` where ``keep`` holds and otherwise unique.

    Rows a guard excludes from a left join (sentinel or NULL keys) would all
    hash to one partition; giving each a distinct key that no dimension row
    carries keeps them spread while they still miss the match.
    """
    return F.when(keep, key).otherwise(F.concat(F.lit("\u0000"), row_id.cast("string")))


# ---------------------------------------------------------------- dimensions

def dimension(df: DataFrame, key: str, attrs: dict[str, Column | str] | None = None,
              sentinel: dict[str, object] | None = None) -> DataFrame:
    """Generic dimension: one row per non-NULL key plus the sentinel row.

    ``attrs`` maps output column -> expression. When a key repeats, the
    smallest attribute tuple is kept so the result is deterministic.
    """
    attrs = attrs or {}
    exprs = [(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in attrs.items()]
    base = df.select(F.col(key).cast("string").alias("id"), *exprs).where(F.col("id").isNotNull())
    if attrs:
        names = list(attrs)
        base = base.groupBy("id").agg(F.min(F.struct(*names)).alias("_a")).select("id", "_a.*")
    else:
        base = base.distinct()
    sent = {"id": SENTINEL_KEY}
    for n in attrs:
        sent[n] = (sentinel or {}).get(n, SENTINEL_LABEL)
    row = df.sparkSession.createDataFrame([tuple(sent.values())], base.schema)
    return base.where(F.col("id") != SENTINEL_KEY).unionByName(row)


def static_dimension(spark: SparkSession, rows: list[tuple], columns: list[str],
                     sentinel: tuple | None = None) -> DataFrame:
    """A fixed lookup dimension (``VALUES`` list) with its sentinel row first."""
    rows = [sentinel or (SENTINEL_KEY,) + (SENTINEL_LABEL,) * (len(columns) - 1), *rows]
    marks = ", ".join("(" + ", ".join(f":r{i}c{j}" for j in range(len(columns))) + ")" for i in range(len(rows)))
    args = {f"r{i}c{j}": v for i, row in enumerate(rows) for j, v in enumerate(row)}
    return spark.sql(f"select * from values {marks} as t({', '.join(columns)})", args=args)


def dim_sale_status(spark: SparkSession) -> DataFrame:
    return static_dimension(spark, SALE_STATUS_ROWS, ["id", "state", "label"])


def dim_rbe_status(spark: SparkSession) -> DataFrame:
    return static_dimension(spark, RBE_STATUS_ROWS, ["id", "label"])


def custom_month_period(col: Column | str, close_day: int = 25) -> Column:
    """First day of the reporting month; days after ``close_day`` roll over.

    The month closes on the ``close_day``; the month-start encoding is ours.
    """
    d = (F.col(col) if isinstance(col, str) else col).cast("date")
    start = F.trunc(d, "month")
    return F.when(F.dayofmonth(d) > close_day, F.add_months(start, 1)).otherwise(start)


def date_bounds(*frames: DataFrame) -> tuple[Column, Column]:
    """First and last day over all columns of frames of dates, rounded to whole years, as scalar subqueries.

    A calendar built from them covers whatever the facts hold: nothing is
    read on the driver and later facts do not become orphans. Without any
    date both are NULL and the calendar has the sentinel only.
    """
    days = None
    for df in frames:
        each = [F.col(f"`{c}`").cast("date") for c in df.columns]
        # distinct days first: a plan that only groups drops the joins behind columns nobody reads
        part = df.distinct().agg(F.least(*map(F.min, each), F.lit(None).cast("date")).alias("lo"),
                      F.greatest(*map(F.max, each), F.lit(None).cast("date")).alias("hi"))
        days = part if days is None else days.unionByName(part)
    lo, hi = F.min("lo"), F.max("hi")
    year = days.agg(F.struct(F.trunc(lo, "year").alias("lo"), F.date_sub(F.add_months(F.trunc(hi, "year"), 12), 1).alias("hi"))).scalar()
    return year.getField("lo"), year.getField("hi")


def date_dimension(spark: SparkSession, start: str | dt.date | Column, end: str | dt.date | Column,
                   close_day: int = 25) -> DataFrame:
    """Calendar from ``start`` to ``end`` inclusive plus the sentinel key.

    Generated by ``sequence`` + ``explode`` from one row; its size is bounded
    by the date range (a century is about 36,500 rows).
    """
    s, e = (v if isinstance(v, Column) else F.to_date(F.lit(str(v))) for v in (start, end))
    days = spark.range(1).select(F.explode(F.sequence(s, e, F.expr("interval 1 day"))).alias("date"))
    cal = days.select(
        F.date_format("date", "yyyyMMdd").alias("id"),
        F.col("date"),
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        custom_month_period("date", close_day).alias("custom_month_period"),
    )
    sentinel = spark.range(1).select(
        F.lit(SENTINEL_KEY).alias("id"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in cal.schema.fields[1:]])
    return cal.unionByName(sentinel)


# ----------------------------------------------------------------- staging

ORDER_AMOUNTS = {
    "amount_untaxed": "decimal(18,2)", "amount_tax": "decimal(18,2)", "amount_total": "decimal(18,2)", "amount_to_invoice": "decimal(18,2)",
    "acompte_1_pourcent": "decimal(5,2)", "acompte_1": "decimal(18,2)", "acompte_1_bis": "decimal(18,2)",
    "acompte_2_pourcent": "decimal(5,2)", "acompte_2": "decimal(18,2)", "acompte_3_pourcent": "decimal(5,2)", "acompte_3": "decimal(18,2)",
}


def stg_sale_order(src: DataFrame) -> DataFrame:
    """Sale-order staging: text keys with the sentinel default, exact money, date keys.

    Values are the source's own, cast and defaulted; nothing is computed.
    """
    return src.select(
        "id", "name", *[fk(c).alias(c) for c in ("company_id", "partner_id", "user_id", "team_id", "lost_reason_id")],
        "state", "opportunity_id", "rbe_status", *[F.col(c).cast(kind).alias(c) for c, kind in ORDER_AMOUNTS.items()],
        date_key("create_date").alias("date_create_id"),
        date_key("order_date").alias("date_order_id"),
        date_key("signed_date").alias("date_signed_id"),
        date_key("validity_date").alias("date_validity_id"),
        date_key("status_signed_date").alias("date_statut_signe_id"),
    )


# ---------------------------------------------------------- sale-order fact

def last_state_change(tracking: DataFrame, message: DataFrame, field: DataFrame,
                      model: str = "sale.order", field_name: str = "state") -> DataFrame:
    """Per record of ``model``: date key of its latest tracked ``field_name`` change.

    tracking ⋈ message ⋈ field (inner). The field filter runs first as a
    semi join, and tracking rows are reduced to one latest date per message
    before the message join (``max`` is associative), so a message or a
    record holding a third of all changes is collapsed map-side instead of
    landing in one join or aggregate task.
    """
    fields = field.where(F.col("name") == field_name).select(F.col("id").alias("field_id"))
    msgs = message.where(F.col("model") == model).select(F.col("id").alias("mail_message_id"), "res_id")
    per_message = (
        tracking.select("mail_message_id", "field_id", "create_date")
        .join(fields, "field_id", "left_semi")
        .groupBy("mail_message_id").agg(F.max("create_date").alias("create_date"))
    )
    return (
        per_message.join(msgs, "mail_message_id")
        .groupBy(F.col("res_id").cast("bigint").alias("sale_order_id"))
        .agg(F.max("create_date").alias("last_change"))
        .select("sale_order_id", F.date_format("last_change", "yyyyMMdd").alias("date_last_state_change_key"))
    )


def orders_with_crm(orders: DataFrame, leads: DataFrame) -> DataFrame:
    """Orders ⟕ CRM lead on opportunity id, guarded by ``opportunity_id <> '0'``.

    Project type, payment method and RBE date live on the lead; misses take
    the sentinel.
    """
    keep = F.col("opportunity_id").isNotNull() & (F.col("opportunity_id") != SENTINEL_KEY)
    o = orders.withColumn("_opp", spread_key(F.col("opportunity_id"), keep, F.col("id")))
    crm = leads.select(
        F.col("id").alias("_opp"),
        F.col("project_type_id").alias("_crm_project_type_id"),
        F.col("payment_mode").alias("_crm_payment_mode"),
        F.col("x_studio_date_rbe").alias("_crm_date_rbe"),
    )
    return o.join(crm, "_opp", "left").select(
        *orders.columns,
        fk("_crm_project_type_id").alias("project_type_id"),
        fk("_crm_payment_mode").alias("payment_method_id"),
        date_key("_crm_date_rbe").alias("date_rbe_id"),
    )


class DimensionKeyError(ValueError):
    """A lookup dimension has a join key that is not unique (the fact would fan out)."""


def assert_unique_key(dim: DataFrame, key: Column, name: str) -> None:
    """Raise when ``key`` repeats in a lookup dimension.

    Lookup dimensions are small: their keys are read (without a job when the
    dimension is a static list). A dimension beyond ``LOOKUP_ROWS`` is grouped
    and one offending row is read."""
    keys = [r[0] for r in dim.select(key.alias("_k")).limit(LOOKUP_ROWS + 1).collect()]
    if len(keys) <= LOOKUP_ROWS:
        counts = Counter(keys)
        if counts and counts.most_common(1)[0][1] > 1:
            raise DimensionKeyError(f"{name}: key {counts.most_common(1)[0][0]!r} occurs {counts.most_common(1)[0][1]} times")
        return
    dup = dim.groupBy(key.alias("_k")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).limit(1).collect()
    if dup:
        raise DimensionKeyError(f"{name}: key {dup[0]['_k']!r} occurs {dup[0]['_n']} times")


def with_state_change(orders: DataFrame, audit: DataFrame) -> DataFrame:
    """Attach the last-state-change key (sentinel on miss)."""
    a = audit.select(F.col("sale_order_id").alias("_oid"), "date_last_state_change_key")
    return orders.withColumn("_oid", F.col("id").cast("bigint")).join(a, "_oid", "left").select(
        *orders.columns, fk("date_last_state_change_key").alias("date_last_state_update_id"))


def with_status(orders: DataFrame, status_dim: DataFrame, rbe_dim: DataFrame) -> DataFrame:
    """Resolve status and RBE keys (sentinel on miss).

    Status matches ``lower(state)`` to the dimension's state; RBE matches
    ``lower(trim(.))`` on both sides. A normalised label must be unique, else
    the fact would fan out.
    """
    assert_unique_key(status_dim, F.col("state"), "sale status dimension")
    assert_unique_key(rbe_dim, normalized_label("label"), "RBE status dimension")
    status = bounded_broadcast(status_dim.select(F.col("state").alias("_st_key"), F.col("id").alias("_st_id")))
    rbe = bounded_broadcast(rbe_dim.select(normalized_label("label").alias("_rbe_key"), F.col("id").alias("_rbe_id")))
    keyed = orders.withColumns({"_st_key": F.lower("state"), "_rbe_key": normalized_label("rbe_status")})
    return (keyed.join(status, "_st_key", "left").join(rbe, "_rbe_key", "left")
            .select(*orders.columns, fk("_st_id").alias("id_state"), fk("_rbe_id").alias("rbe_status_id")))


def orders_resolved(orders: DataFrame, audit: DataFrame, status_dim: DataFrame,
                    rbe_dim: DataFrame) -> DataFrame:
    """Last-state-change key, status and RBE keys of every order."""
    return with_status(with_state_change(orders, audit), status_dim, rbe_dim)


def reporting_period(df: DataFrame, period_start: str, key: str = "date_create_id",
                     change_key: str = "date_last_state_update_id") -> DataFrame:
    """Keep rows created from the start year on, or older rows whose state
    changed on/after ``period_start`` (``yyyyMMdd``). Text comparison as in the
    model; a NULL creation key is excluded."""
    year = period_start[:4]
    created = F.left(F.col(key), F.lit(4))
    return df.where((created >= year) | ((created < year) & (F.col(change_key) >= period_start)))


FACT_SALE_ORDER_COLUMNS = [
    ("id", "id"), ("name", "order_name"), ("user_id", "vendor_id"), ("partner_id", "client_id"),
    ("company_id", "company_id"), ("team_id", "team_id"), ("id_state", "id_state"),
    ("project_type_id", "project_type_id"), ("payment_method_id", "payment_method_id"),
    ("rbe_status_id", "rbe_status_id"), ("lost_reason_id", "lost_reason_id"),
    ("date_create_id", "date_create_id"), ("date_order_id", "date_order_id"),
    ("date_signed_id", "date_signed_id"), ("date_validity_id", "date_validity_id"),
    ("date_statut_signe_id", "date_statut_signe_id"), ("date_rbe_id", "date_rbe_id"),
    ("date_last_state_update_id", "date_last_state_update_id"),
    ("amount_untaxed", "amount_untaxed"), ("amount_tax", "amount_tax"), ("amount_total", "amount_total"),
    ("amount_to_invoice", "amount_to_invoice"), ("acompte_1_pourcent", "acompte_1_pourcent"),
    ("acompte_1", "acompte_1"), ("acompte_1_bis", "acompte_1_bis"), ("acompte_2_pourcent", "acompte_2_pourcent"),
    ("acompte_2", "acompte_2"), ("acompte_3_pourcent", "acompte_3_pourcent"), ("acompte_3", "acompte_3"),
]
MONEY_COLUMNS = [n for _, n in FACT_SALE_ORDER_COLUMNS if n.startswith(("amount", "acompte"))]


def fact_sale_order(orders: DataFrame, leads: DataFrame, audit: DataFrame, status_dim: DataFrame,
                    rbe_dim: DataFrame, period_start: str = "20250101") -> DataFrame:
    """One row per sale order in the reporting period (the commercial fact).

    ``orders`` is staged (``stg_sale_order``), ``audit`` is
    ``last_state_change(...)``. The period needs the audit key only, so it
    is cut before the leads and the status dimensions are joined.
    """
    kept = reporting_period(with_state_change(orders, audit), period_start)
    return with_status(orders_with_crm(kept, leads), status_dim, rbe_dim).select(*[F.col(s).alias(d) for s, d in FACT_SALE_ORDER_COLUMNS])


# ------------------------------------------------------------ other facts

def fact_crm(leads: DataFrame, vendors: DataFrame) -> DataFrame:
    """CRM fact: one row per lead with sentinel keys, its vendor's team and the expected revenue.

    Vendors are unique by id (a dimension); leads without a vendor take a
    key of their own, so that they do not meet in one task.
    """
    v = bounded_broadcast(vendors.select(F.col("id").alias("_vendor"), F.col("team_id").alias("_team")))
    keyed = leads.withColumn("_vendor", spread_key(F.col("user_id"), F.col("user_id").isNotNull(), F.col("id")))
    return keyed.join(v, "_vendor", "left").select(
        F.col("id"),
        F.col("type"),
        fk("user_id").alias("vendor_id"),
        fk("partner_id").alias("client_id"),
        fk("stage_id").alias("stage_id"),
        fk("won_status").alias("won_status_id"),
        fk("_team").alias("team_id"),
        date_key("create_date").alias("date_create_id"),
        F.col("create_date"),
        F.col("expected_revenue"),
    )


def fact_employee_activity(employees: DataFrame, contracts: DataFrame) -> DataFrame:
    """Employee × contract activity rows; employees without contract keep one row.

    Written as contracts ⋈ employees (inner) ∪ employees ▷ contract holders
    rather than a left outer join: AQE can split a skewed contracts
    partition of an inner join, and the anti join only sees distinct
    employee ids, so one employee with a third of all contracts costs no
    single task. Keys default to the sentinel; the wage stays exact.
    """
    e = employees.select(F.col("id").alias("employee_id"), "department_id", F.col("job").alias("job_id"), "company_id")
    c = contracts.select(
        F.col("id").alias("contract_id"), "employee_id", "contract_type_id",
        F.col("create_date").alias("contract_create_date"), "wage", "departure_date",
    )
    with_contract = c.join(e, "employee_id")
    holders = contracts.select("employee_id").distinct()
    without = e.join(holders, "employee_id", "left_anti").select(
        "employee_id", "department_id", "job_id", "company_id", *[F.lit(None).cast(f.dataType).alias(f.name)
                                                    for f in c.schema.fields if f.name != "employee_id"])
    rows = with_contract.unionByName(without)
    return rows.select(
        F.concat_ws("-", F.col("employee_id"), fk("contract_id")).alias("activity_id"),
        F.col("employee_id"),
        fk("department_id").alias("department_id"),
        fk("job_id").alias("job_id"),
        fk("company_id").alias("company_id"),
        fk("contract_id").alias("contract_id"),
        fk("contract_type_id").alias("contract_type_id"),
        date_key("contract_create_date").alias("contract_start_date_key"),
        F.col("contract_create_date"),
        F.col("wage").alias("monthly_wage"),
        date_key("departure_date").alias("departure_date"),
    )


def fact_leave(leaves: DataFrame, employees: DataFrame) -> DataFrame:
    """Leave fact: leave ⟕ employee for the department; hours = days × 8 (ours)."""
    e = employees.select(F.col("id").alias("_employee"), F.col("department_id").alias("_dept"))
    keyed = leaves.withColumn("_employee", spread_key(F.col("employee_id"), F.col("employee_id").isNotNull(), F.col("id")))
    return keyed.join(e, "_employee", "left").select(
        F.col("id").alias("leave_id"),
        fk("employee_id").alias("employee_id"),
        fk("leave_type_id").alias("leave_type_id"),
        fk("_dept").alias("department_id"),
        date_key("request_date_from").alias("request_date_from_key"),
        F.col("request_date_from"),
        F.col("number_of_days"),
        (F.col("number_of_days") * 8).alias("number_of_hours"),
    )


def label_dimension(df: DataFrame, key: str, label_col: str, out: str = "label") -> DataFrame:
    """Dimension whose label is an ERP translatable field (JSON or text)."""
    return dimension(df, key, {out: json_label(label_col)})
