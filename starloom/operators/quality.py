"""Quality gates, reports and integrity checks (group D).

Metrics for a table are computed in one aggregate pass into a one-row
frame; gate verdicts are derived from it as a small frame, so the driver
only ever reads a handful of verdict rows (``enforce``). Thresholds default
to the reference's values and are parameters.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.keys import ts_lit
from starloom.plans.sizing import bounded_broadcast

# Gate thresholds.
MAX_ROW_DIFF_PCT = 5.0
MIN_UNIQUE_ID_RATIO = 0.98
MAX_NULL_PCT_CRITICAL = 20.0
FRESHNESS_HOURS = 48

VERDICT_COLUMNS = ["table_name", "gate", "subject", "value", "threshold", "status"]


class DataQualityError(RuntimeError):
    """A blocking gate failed; the staged version must not be published."""


def _pct(num: Column, den: Column) -> Column:
    return F.try_divide(num.cast("double") * 100.0, F.nullif(den, F.lit(0)).cast("double"))


def gate_metrics(df: DataFrame, id_col: str = "id", critical: list[str] = ()) -> DataFrame:
    """One aggregate pass: rows, distinct ids and NULL counts of critical columns."""
    aggs = [F.count(F.lit(1)).alias("dw_rows"), F.count_distinct(F.col(id_col)).alias("unique_ids")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"nulls__{c}") for c in critical]
    return df.agg(*aggs)


def _verdict(table: str, gate: str, subject: str, value: Column, threshold: float, failed: Column,
             skipped: Column | None = None) -> list[Column]:
    status = F.when(failed, F.lit("FAIL")).otherwise(F.lit("PASS"))
    if skipped is not None:
        status = F.when(skipped, F.lit("SKIP")).otherwise(status)
    return [F.lit(table).alias("table_name"), F.lit(gate).alias("gate"), F.lit(subject).alias("subject"),
            value.cast("double").alias("value"), F.lit(float(threshold)).alias("threshold"), status.alias("status")]


def gate_row_count(metrics: DataFrame, source_rows: DataFrame, table: str,
                   max_diff_pct: float = MAX_ROW_DIFF_PCT) -> DataFrame:
    """Fail when ``|dw - src| / src * 100 > max_diff_pct``; skipped when the source is empty.

    ``source_rows`` is a one-row frame with column ``source_rows`` (used as
    a scalar subquery).
    """
    m = metrics.withColumn("source_rows", source_rows.select("source_rows").scalar())
    diff = _pct(F.abs(F.col("dw_rows") - F.col("source_rows")), F.col("source_rows"))
    return m.select(*_verdict(table, "row_count", "rows", F.coalesce(diff, F.lit(0.0)), max_diff_pct,
                              diff > max_diff_pct, F.col("source_rows") == 0))


def gate_unique_id(metrics: DataFrame, table: str, min_ratio: float = MIN_UNIQUE_ID_RATIO) -> DataFrame:
    """Fail when distinct ids / rows ``< min_ratio``; skipped on an empty table."""
    ratio = F.try_divide(F.col("unique_ids").cast("double"), F.nullif(F.col("dw_rows"), F.lit(0)).cast("double"))
    return metrics.select(*_verdict(table, "unique_id", "id", F.coalesce(ratio, F.lit(1.0)), min_ratio,
                                    ratio < min_ratio, F.col("dw_rows") == 0))


def _null_structs(table: str, critical: list[str], max_null_pct: float) -> list[Column]:
    out = []
    for c in critical:
        pct = F.coalesce(_pct(F.col(f"nulls__{c}"), F.col("dw_rows")), F.lit(0.0))
        out.append(F.struct(*_verdict(table, "null_pct", c, pct, max_null_pct, pct > max_null_pct)))
    return out


def gate_null_pct(metrics: DataFrame, table: str, critical: list[str],
                  max_null_pct: float = MAX_NULL_PCT_CRITICAL) -> DataFrame:
    """Per critical column: fail when NULL % ``> max_null_pct``; empty table → 0 %."""
    if not critical:
        return metrics.limit(0).select(*_verdict(table, "null_pct", "", F.lit(0.0), max_null_pct, F.lit(False)))
    return metrics.select(F.inline(F.array(*_null_structs(table, list(critical), max_null_pct))))


SKETCH_LG_K = 16
SKETCH_SIGMAS = 4


def id_sketches(df: DataFrame, part: Column, id_col: str = "id", lg_k: int = SKETCH_LG_K) -> DataFrame:
    """``part, rows, ids``: an HLL sketch of the ids of every part (a bucket, a day, a batch), kept with the table.

    Sketches of parts merge, so a load sketches only the parts it writes,
    however the ids are spread over them.
    """
    return df.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg(id_col, lg_k).alias("ids"))


def gate_unique_id_merged(sketches: DataFrame, exact: DataFrame, table: str, min_ratio: float = MIN_UNIQUE_ID_RATIO,
                          lg_k: int = SKETCH_LG_K, sigmas: float = SKETCH_SIGMAS) -> DataFrame:
    """The unique-id gate from merged sketches; ids are counted exactly only when the sketches cannot decide.

    The merged estimate has a relative standard error of 1.04 / sqrt(2^lg_k).
    When the limit lies more than ``sigmas`` of it away, the verdict is the
    exact gate's; else ``exact`` (rows with column ``id``, read only then) is
    counted. ``counted`` tells which.
    """
    merged = sketches.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("dw_rows"),
                          F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("ids")), F.lit(0)).alias("unique_ids"))
    found = merged.first()  # one row
    error = sigmas * 1.04 / (1 << lg_k) ** 0.5
    limit = min_ratio * found["dw_rows"]
    counted = found["dw_rows"] > 0 and found["unique_ids"] * (1 - error) <= limit <= found["unique_ids"] * (1 + error)
    metrics = gate_metrics(exact, "id") if counted else sketches.sparkSession.createDataFrame([found], merged.schema)
    return gate_unique_id(metrics, table, min_ratio).withColumn("counted", F.lit(bool(counted)))


def gate_freshness(watermarks: DataFrame, now: dt.datetime, max_hours: float = FRESHNESS_HOURS) -> DataFrame:
    """Warn (non-blocking) when the last successful extraction is older than ``max_hours``."""
    hours = (F.unix_micros(ts_lit(now).cast("timestamp"))
             - F.unix_micros(F.col("last_successful_extraction").cast("timestamp"))) / 3.6e9
    status = F.when(F.col("last_successful_extraction").isNull() | (hours > max_hours), F.lit("WARN")) \
        .otherwise(F.lit("PASS"))
    return watermarks.select(
        "table_name", F.lit("freshness").alias("gate"), F.lit("last_successful_extraction").alias("subject"),
        hours.cast("double").alias("value"), F.lit(float(max_hours)).alias("threshold"), status.alias("status"))


def gate_verdicts(df: DataFrame, table: str, source_rows: DataFrame | None, id_col: str = "id",
                  critical: list[str] = (), max_diff_pct: float = MAX_ROW_DIFF_PCT,
                  min_ratio: float = MIN_UNIQUE_ID_RATIO, max_null_pct: float = MAX_NULL_PCT_CRITICAL) -> DataFrame:
    """All blocking gates for one table from a single metrics pass."""
    return verdicts_of(gate_metrics(df, id_col, list(critical)), table, source_rows, list(critical), max_diff_pct, min_ratio,
                       max_null_pct)


def verdicts_of(metrics: DataFrame, table: str, source_rows: DataFrame | None, critical: list[str] = (),
                max_diff_pct: float = MAX_ROW_DIFF_PCT, min_ratio: float = MIN_UNIQUE_ID_RATIO,
                max_null_pct: float = MAX_NULL_PCT_CRITICAL) -> DataFrame:
    """All blocking gates from one row of metrics, wherever it was measured.

    The metrics row is turned into verdict rows with ``inline`` over an
    array of structs, so a table is scanned once whatever the number of
    gates. Without ``source_rows`` the row-count gate is left out.
    """
    m = metrics
    rows = []
    if source_rows is not None:
        m = m.withColumn("source_rows", source_rows.select("source_rows").scalar())
        diff = _pct(F.abs(F.col("dw_rows") - F.col("source_rows")), F.col("source_rows"))
        rows.append(F.struct(*_verdict(table, "row_count", "rows", F.coalesce(diff, F.lit(0.0)), max_diff_pct,
                                       diff > max_diff_pct, F.col("source_rows") == 0)))
    ratio = F.try_divide(F.col("unique_ids").cast("double"), F.nullif(F.col("dw_rows"), F.lit(0)).cast("double"))
    rows.append(F.struct(*_verdict(table, "unique_id", "id", F.coalesce(ratio, F.lit(1.0)), min_ratio,
                                   ratio < min_ratio, F.col("dw_rows") == 0)))
    rows += _null_structs(table, list(critical), max_null_pct)
    return m.select(F.inline(F.array(*rows)))


def enforce(verdicts: DataFrame) -> list[dict]:
    """Raise ``DataQualityError`` on the first failed gate; returns the verdict rows.

    The verdict frame is a few rows per table; reading it is the only driver
    action of the gate step.
    """
    return raise_failed([r.asDict() for r in verdicts.collect()])


def raise_failed(rows: list[dict]) -> list[dict]:
    """``rows`` of verdicts, unless one of them is a failure."""
    order = {"row_count": 0, "unique_id": 1, "null_pct": 2}
    rows = sorted(rows, key=lambda r: (order.get(r["gate"], 9), r["subject"] or ""))
    for r in rows:
        if r["status"] == "FAIL":
            raise DataQualityError(
                f"{r['table_name']}: gate {r['gate']} on {r['subject']} failed "
                f"(value {r['value']:.6g}, threshold {r['threshold']:.6g})")
    return rows


def quality_report(frames: dict[str, DataFrame | None], id_col: str = "id") -> DataFrame:
    """Non-blocking report: rows vs distinct ids per table, ``OK``/``WARN``;
    a table that does not exist (``None``) is an ``ERROR`` row."""
    spark = None
    parts = []
    missing = []
    for name, df in frames.items():
        if df is None:
            missing.append(name)
            continue
        spark = df.sparkSession
        parts.append(df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(F.col(id_col)).alias("unique_ids"))
                     .select(F.lit(name).alias("table_name"), "rows", "unique_ids"))
    spark = spark or SparkSession.active()
    out = spark.createDataFrame([(m, None, None, "ERROR") for m in missing],
                                "table_name string, rows bigint, unique_ids bigint, status string")
    for p in parts:
        out = out.unionByName(p.withColumn("status", F.when(F.col("rows") == F.col("unique_ids"), "OK").otherwise("WARN")))
    return out


def extraction_stats(log: DataFrame, now: dt.datetime, days: int = 7) -> DataFrame:
    """Per table over the last ``days``: runs, rows, average seconds, successes, success %.

    Ordered by rows descending, NULLs last.
    """
    since = ts_lit(now - dt.timedelta(days=days))
    micros = (F.unix_micros(F.col("end_time").cast("timestamp"))
              - F.unix_micros(F.col("start_time").cast("timestamp")))
    # exact integer sum, then one division: independent of summation order
    avg_secs = F.sum(micros).cast("double") / F.count(F.lit(1)).cast("double") / 1e6
    return (
        log.where(F.col("start_time") >= since)
        .groupBy("table_name")
        .agg(F.count(F.lit(1)).alias("runs"), F.sum("rows_extracted").alias("total_rows"),
             avg_secs.alias("avg_secs"), F.count_if(F.col("status") == "completed").alias("successes"))
        .withColumn("success_pct", F.col("successes").cast("double") * 100.0 / F.col("runs").cast("double"))
        .orderBy(F.desc_nulls_last("total_rows"), "table_name")
    )


def fk_orphans(fact: DataFrame, fk: str, dim: DataFrame, key: str = "id") -> DataFrame:
    """Fact rows whose ``fk`` has no dimension row (NULL counts as orphan)."""
    d = bounded_broadcast(dim.select(F.col(key).alias("_dim_key")).distinct())
    return fact.join(d, fact[fk].eqNullSafe(d["_dim_key"]), "left_anti")


def fk_coverage(fact: DataFrame, checks: dict[str, DataFrame], key: str = "id") -> DataFrame:
    """``fk, orphans``: orphan rows per foreign key; 100 % coverage means every count is 0.

    One pass over the fact: its keys are unpivoted and counted per (foreign
    key, value), which partial aggregation reduces to distinct values before
    the shuffle, so a sentinel held by a third of the rows is one row per
    task. One anti join holds them against the tagged union of all
    dimensions (a dimension shared by several keys is read once); no job
    runs beforehand. A NULL key is an orphan.
    """
    names = list(checks)
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("fk_no"), F.col(c).cast("string").alias("key")) for i, c in enumerate(names)]))
    used = fact.select(pairs.alias("_p")).groupBy("_p.fk_no", "_p.key").agg(F.count(F.lit(1)).alias("rows"))
    dims: dict[int, tuple[DataFrame, list[int]]] = {}
    for i, c in enumerate(names):
        dims.setdefault(id(checks[c]), (checks[c], []))[1].append(i)
    known = None
    for dim, numbers in dims.values():
        tagged = dim.select(F.explode(F.array(*map(F.lit, numbers))).alias("fk_no"), F.col(key).cast("string").alias("key"))
        known = tagged if known is None else known.unionByName(tagged)
    missed = used.join(known, ["fk_no", "key"], "left_anti").groupBy("fk_no").agg(F.sum("rows").alias("orphans"))
    listed = fact.sparkSession.createDataFrame(list(enumerate(names)), "fk_no int, fk string")  # one row per foreign key
    return listed.join(F.broadcast(missed), "fk_no", "left").select("fk", F.coalesce("orphans", F.lit(0)).cast("bigint").alias("orphans"))


def grain_violations(df: DataFrame, key: str | list[str]) -> DataFrame:
    """Keys that occur more than once (the fact grain must be unique)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def grain_summary(df: DataFrame, key: str, table: str) -> DataFrame:
    """One row: rows, keys occurring more than once, rows in such keys."""
    v = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return v.agg(
        F.sum("n").alias("rows"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("rows_in_duplicates"),
    ).select(F.lit(table).alias("table_name"), F.col("rows").cast("bigint"), "duplicate_keys",
             F.col("rows_in_duplicates").cast("bigint"))
