"""Filter context, row-level security, published star, clean-up and the job after the loads."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from starloom.operators import context as ctx
from starloom.operators import measures_sales as ms
from starloom.operators import quality, scope, star
from starloom.plans import buckets, control, load, post_ingestion, resume, retention, star_job
from starloom.sources import ingest

NOW = dt.datetime(2030, 1, 1)


def _store(spark):
    return control.TableStore(spark, tempfile.mkdtemp(prefix="starloom-star-"))


# ----------------------------------------------------------- filter context

LEADS = [("s1", "v1", "t1", 1), ("s1", "v1", "t2", 2), ("s1", "v2", "t1", 4), ("s2", "v1", "t1", 8), ("s2", "v2", "t1", 16),
         ("s3", "v1", "t1", 32), ("s3", None, "t1", 64)]


def _leads(spark):
    return spark.createDataFrame(LEADS, "stage string, vendor string, team string, n int")


@pytest.mark.parametrize("as_frame", [False, True])
def test_each_measure_has_its_own_denominator(spark, as_frame):
    vendors = spark.createDataFrame([("v1",), ("v1",), (None,)], "x string") if as_frame else ["v1"]
    chosen = ctx.Context({"vendor": vendors, "team": ["t1"], "stage": ["s1", "s2"], "elsewhere": ["?"]})
    n = F.col("n")
    out = ctx.evaluate(_leads(spark), chosen, [
        ctx.Measure("here", n), ctx.Measure("all_stages", n, ctx.removing("stage")), ctx.Measure("vendor_only", n, ctx.only("vendor")),
        ctx.Measure("vendor_and_stage", n, ctx.only("vendor", "stage")), ctx.Measure("whole", n, ctx.only()),
        ctx.Measure("big", n, where=n > 4)], ["stage"])
    got = {r["stage"]: tuple(r)[1:] for r in out.collect()}
    # of v1 in t1: s1 1, s2 8, s3 32; of v1 in any team: 43; of all rows: 127
    assert got == {"s1": (1, 41, 43, 3, 127, None), "s2": (8, 41, 43, 8, 127, 8)}


def test_the_fact_is_read_once(spark):
    chosen = ctx.Context({"vendor": ["v1"], "stage": ["s1"]})
    out = ctx.evaluate(_leads(spark), chosen, [ctx.Measure(f"m{i}", F.col("n"), rule) for i, rule in enumerate(
        (ctx.everything(), ctx.removing("stage"), ctx.only()))], ["stage"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1


# ------------------------------------------------------ row-level security

def test_scope_follows_all_relations(spark):
    frame = spark.createDataFrame
    tables = {
        "dim_team": frame([("1", "a"), ("2", "b")], "id string, name string"),
        "dim_vendor": frame([("10", "1", "x@e"), ("11", "2", "Y@E"), ("12", None, None)], "id string, team_id string, email string"),
        "fact_sale_order": frame([("o1", "10"), ("o2", "11"), ("o3", None), ("o4", "11")], "id string, vendor_id string"),
        "fact_crm": frame([("c1", "10"), ("c2", "12")], "id string, vendor_id string"),
        "dim_date": frame([("20240101",)], "id string"),
    }
    ids = lambda seen: {n: sorted(r[0] for r in df.select("id").collect()) for n, df in seen.items()}
    mine = ids(scope.vendor_scope_all(tables, "y@e"))
    assert mine == {"dim_team": ["1", "2"], "dim_vendor": ["11"], "fact_sale_order": ["o2", "o4"], "fact_crm": [], "dim_date": ["20240101"]}
    team = ids(scope.scoped(tables, "dim_team", F.col("name") == "a"))
    assert (team["dim_vendor"], team["fact_sale_order"], team["fact_crm"]) == (["10"], ["o1"], ["c1"])
    assert ids(scope.vendor_scope_all(tables, "nobody@e"))["fact_sale_order"] == []
    loop = [scope.Relation("dim_team", "id", "dim_vendor"), scope.Relation("dim_vendor", "team_id", "dim_team")]
    with pytest.raises(ValueError, match="cycle"):
        scope.scoped(tables, "dim_team", F.lit(True), loop)


# ------------------------------------------------------------- coverage, ranges, sketches, periods

def test_coverage_counts_rows_not_values(spark):
    fact = spark.createDataFrame([("a", "x", "1")] * 5 + [("b", None, "1")] * 3 + [("zz", "y", "2")] * 2, "k string, m string, n string")
    dim = spark.createDataFrame([("a",), ("b",), ("b",), ("x",), ("y",)], "id string")
    other = spark.createDataFrame([(1,), (2,)], "id int")
    got = {r["fk"]: r["orphans"] for r in quality.fk_coverage(fact, {"k": dim, "m": dim, "n": other}).collect()}
    assert got == {"k": 2, "m": 3, "n": 0}
    empty = quality.fk_coverage(fact.limit(0), {"k": dim})
    assert [tuple(r) for r in empty.collect()] == [("k", 0)]


def test_even_ranges_with_gaps_and_hot_ids(spark):
    ids = spark.range(0, 3000).select(F.when(F.col("id") < 1500, F.col("id")).otherwise(F.col("id") + 10**9 * 5).alias("id"))
    ranges = ingest.even_ranges(ids, "id", 8)
    rows = [r["rows"] for r in ingest.range_counts(ids, ranges).collect()]
    assert sum(rows) == 3000 and max(rows) <= 2 * 3000 / len(rows) and all(isinstance(b, int) for r in ranges for b in r)
    assert all(b[0] == a[1] + 1 for a, b in zip(ranges, ranges[1:]))
    read = [ids.where(p).count() for p in ingest.range_predicates(ranges)]
    assert sum(read) == 3000 and read[-1] == 0
    hot = spark.range(0, 900).select(F.when(F.col("id") < 600, F.lit(2**60)).otherwise(F.col("id")).alias("id"))
    assert sum(r["rows"] for r in ingest.range_counts(hot, ingest.even_ranges(hot, "id", 5)).collect()) == 900
    nulls = spark.createDataFrame([(None,), (7,)], "id long")
    assert ingest.even_ranges(nulls) == [(7, 7)] and ingest.even_ranges(nulls.where("id is null")) == []
    assert [nulls.where(p).count() for p in ingest.range_predicates([(7, 7)])] == [1, 1]


@pytest.mark.parametrize("twice, status, counted", [(0, "PASS", False), (50, "PASS", True), (48, "FAIL", True), (3, "FAIL", False)])
def test_sketched_gate_equals_the_exact_one(spark, twice, status, counted):
    ids = spark.range(40_000).select("id", (F.col("id") % 7).alias("part"))
    if twice:
        ids = ids.unionByName(ids.where(F.col("id") % twice == 0).withColumn("part", F.lit(9).cast("bigint")))
    got = quality.gate_unique_id_merged(quality.id_sketches(ids, F.col("part")), ids, "t").first()
    exact = quality.gate_unique_id(quality.gate_metrics(ids, "id"), "t").first()
    assert (got["status"], got["counted"]) == (status, counted) and exact["status"] == status
    none = quality.gate_unique_id_merged(quality.id_sketches(ids.limit(0), F.col("part")), ids.limit(0), "t").first()
    assert (none["status"], none["counted"]) == ("SKIP", False)


def test_previous_period_is_the_one_that_exists(spark):
    """No order in February and March: the month before April that exists is January."""
    rows = [("t1", "2", "20240110", 10), ("t1", "2", "20240405", 25), ("t2", "2", "20240105", 7), ("t2", "1", "20240410", 99)]
    fact = spark.createDataFrame(rows, "team_id string, id_state string, date_create_id string, amount_untaxed int")
    matrix = {r.team_id: (r.previous_value, r.current_value) for r in ms.mom_matrix(fact, ["team_id"]).collect()}
    assert matrix == {"t1": (10.0, 25.0), "t2": (7.0, 99.0)}
    delta = {r.team_id: (r.current_value, r.previous_value, r.delta) for r in ms.kpi_delta(fact, ["team_id"]).collect()}
    assert delta == {"t1": (25.0, 10.0, 15.0), "t2": (0.0, 7.0, -7.0)}


def test_staging_passes_the_source_amounts_through(spark):
    money = {c: i for i, c in enumerate(star.ORDER_AMOUNTS)}
    row = {"id": "1", "name": "S1", "company_id": None, "partner_id": "2", "user_id": None, "team_id": None, "lost_reason_id": None, "state": "Sale",
           "opportunity_id": None, "rbe_status": None, **money, "create_date": NOW, "order_date": NOW - dt.timedelta(days=1), "signed_date": None,
           "validity_date": None, "status_signed_date": NOW + dt.timedelta(days=1)}
    kinds = {c: "int" for c in money} | {c: "timestamp_ntz" for c in row if c.endswith("_date")}
    source = spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} {kinds.get(c, 'string')}" for c in row))
    out = star.stg_sale_order(source).first()
    assert [int(out[c]) for c in money] == list(money.values())
    assert (out["date_order_id"], out["date_signed_id"], out["date_statut_signe_id"]) == ("20291231", "0", "20300102")


# ------------------------------------------------------------- published star

def _star(spark, vendor="1"):
    dims = {"dim_vendor": spark.createDataFrame([("0", "Unknown"), ("1", "a")], "id string, name string")}
    fact = star_job.Fact("fact", spark.createDataFrame([("o1", vendor, 5), ("o2", "0", 6)], "id string, vendor_id string, v int"), "id",
                         {"vendor_id": "dim_vendor"})
    return dims, fact


def test_a_lost_key_or_grain_keeps_the_old_fact(spark):
    store = _store(spark)
    dims, fact = _star(spark)
    assert star_job.publish_star(store, dims, [fact])["fact"].count() == 2
    before = store.pointer("facts", "fact")["path"]
    with pytest.raises(quality.DataQualityError, match="fk_coverage on vendor_id"):
        star_job.publish_fact(store, _star(spark, "7")[1])
    twice = star_job.Fact("fact", fact.rows.unionByName(fact.rows), "id", fact.keys)
    with pytest.raises(quality.DataQualityError, match="grain on id"):
        star_job.publish_fact(store, twice)
    assert store.pointer("facts", "fact")["path"] == before and store.read("facts", "fact").count() == 2
    failed = control.read_verdicts(store, "fact").where("status = 'FAIL'").select("gate", "value").collect()
    assert sorted(map(tuple, failed)) == [("fk_coverage", 1.0), ("grain", 2.0)]
    # the vendor arrives: the same fact is published
    star_job.publish_dimension(store, dims["dim_vendor"].unionByName(spark.createDataFrame([("7", "new")], "id string, name string")), "dim_vendor")
    assert star_job.publish_fact(store, _star(spark, "7")[1]).where("vendor_id = '7'").count() == 1


def test_dimension_keys_layers_and_views(spark):
    store = _store(spark)
    bad = spark.createDataFrame([("1", "a"), ("1", "b")], "id string, name string")
    with pytest.raises(quality.DataQualityError, match="unique_key"):
        star_job.publish_dimension(store, bad, "dim_x")
    assert not store.exists("dimensions", "dim_x")
    star_job.publish_dimension(store, bad.limit(1), "dim_x", domain="rh")
    assert store.exists("dimensions_rh", "dim_x") and not store.exists("dimensions", "dim_x")
    with pytest.raises(ValueError, match="not published"):
        star_job.publish_fact(store, _star(spark)[1])
    assert star_job.stage_view(bad, "stg_x").count() == 2 and spark.catalog.tableExists("stg_x")


# ------------------------------------------------------------------ clean-up

def _exists(path):
    return os.path.exists(path.removeprefix("file:"))


def test_sweep_spares_readers_stages_and_the_live_version(spark):
    store = _store(spark)
    rows = lambda n: spark.range(n).select(F.col("id").cast("string").alias("id"), F.col("id").alias("v"))
    buckets.publish_version(store, rows(10), "raw", "t", "id", 2, run_id="one")
    reader = store.read("raw", "t")
    buckets.publish_version(store, rows(20), "raw", "t", "id", 2, run_id="two")
    buckets.apply_delta(store, rows(3).withColumn("v", F.col("v") + 1), "raw", "t", "id", run_id="three")
    _write = buckets._write
    store.stage(rows(5), "raw", "t", "failed")  # staged, never published
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert retention.sweep_table(store, "raw", "t", now) == []
    assert reader.count() == 10  # an old reader within the bound
    later = now + dt.timedelta(hours=retention.KEEP_HOURS + 1)
    gone = {os.path.basename(os.path.dirname(p)) + "/" + os.path.basename(p) for p in retention.sweep_table(store, "raw", "t", later)}
    assert gone == {"t/v=one", "t/v=failed", "_stage/v=three", "_stats/run=one"}
    assert store.read("raw", "t").count() == 20
    assert buckets.apply_delta(store, rows(1), "raw", "t", "id").rows == 20  # metrics of the live version are still there
    assert retention.sweep_table(store, "raw", "t", now) == [] and _write is buckets._write


def test_an_open_stage_and_an_open_run_are_kept(spark, monkeypatch):
    store = _store(spark)
    rows = spark.range(10).select(F.col("id").cast("string").alias("id"), F.col("id").alias("v"))
    buckets.publish_version(store, rows, "raw", "t", "id", 2)
    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(buckets, "_copy", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        buckets.apply_delta(store, rows.limit(1).withColumn("v", F.lit(77).cast("bigint")), "raw", "t", "id")
    resume.record(store, "t", "open", [resume.WHOLE_RUN], "started", NOW)
    spark.range(1).write.parquet(resume.staging(store, "raw", "t", "open"))
    spark.range(1).write.parquet(resume.staging(store, "raw", "t", "closed"))
    gone = retention.sweep_table(store, "raw", "t", NOW)
    assert [os.path.basename(p) for p in gone] == ["v=closed"]
    assert store.read("raw", "t").where("v = 77").count() == 1 and _exists(resume.staging(store, "raw", "t", "open"))


def test_logs_are_compacted_and_watermarks_survive(spark):
    store = _store(spark)
    when = lambda d: dt.datetime(2024, 1, 1) + dt.timedelta(days=d)
    for d, kind in ((0, "full"), (1, "incremental"), (40, "full"), (41, "incremental"), (80, "incremental")):
        entry = control.log_entry(spark, "t", kind, when(d), when(d), 5, 5, 0, "completed", when(d), None, d)
        store.append(entry.coalesce(1), control.META, load.RUN_LOG, "t", f"r{d}")
    before = load.read_watermarks(store, "t").collect()
    retention.clean_up(store, [("raw", "t")], when(81))
    assert sorted(r["id"] for r in load.read_log(store, "t").collect()) == [40, 41, 80]
    assert load.read_watermarks(store, "t").collect() == before
    folder = f"{store.root}/{control.META}/{load.RUN_LOG}/t"
    assert len(os.listdir(folder)) == 1
    name = os.listdir(folder)
    retention.clean_up(store, [("raw", "t")], when(81))
    assert os.listdir(folder) == name  # nothing to do: left alone
    # a crash before the old folders went: rows are there twice and are read once
    store.append(load.read_log(store, "t").where("id = 80").coalesce(1), control.META, load.RUN_LOG, "t", "again")
    assert load.read_log(store, "t").count() == 3


def test_after_ingestion_runs_every_part(spark, monkeypatch):
    store = _store(spark)
    source = spark.range(30).select("id", F.lit("n").alias("name"), F.lit("2024-01-01").cast("timestamp_ntz").alias("write_date"))
    load.load_table(store, "crm_lead", source)
    with pytest.raises(quality.DataQualityError):
        load.load_table(store, "res_partner", source.withColumn("name", F.lit(None).cast("string")))
    found = post_ingestion.after_ingestion(store, [("raw", "crm_lead"), ("raw", "res_partner")], NOW)
    assert not found.failures
    assert {r["table_name"]: r["status"] for r in found.report.collect()} == {"crm_lead": "OK", "res_partner": "ERROR"}
    assert {r["table_name"]: r["status"] for r in found.freshness.collect()} == {"crm_lead": "WARN", "res_partner": "WARN"}
    with monkeypatch.context() as m:
        m.setattr(quality, "quality_report", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        again = post_ingestion.after_ingestion(store, [("raw", "crm_lead")], NOW)
    assert list(again.failures) == ["report"] and again.stats is not None and "raw.crm_lead" in again.deleted
