"""End-to-end table loads: full, incremental, no change, gate failure."""

import datetime as dt
import tempfile
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from starloom.functions.keys import ts_lit
from starloom.operators.quality import DataQualityError
from starloom.operators.upsert import DeltaKeyError
from starloom.plans import control, load, resume
from starloom.sources import ingest
from starloom.sources.erp_fixture import ErpSources
from tests.conftest import SF_SMALL

T1 = dt.datetime(2024, 2, 1, 2, 0)
T2 = dt.datetime(2024, 2, 2, 2, 0)
T3 = dt.datetime(2024, 2, 3, 2, 0)
T4 = dt.datetime(2024, 2, 4, 2, 0)


def _source(spark):
    so = ErpSources(spark, SF_SMALL).src_sale_order.select("id", "name", "state", "amount_untaxed", "create_date")
    return so.withColumn("write_date", F.col("create_date"))


def test_load_lifecycle(spark):
    store = control.TableStore(spark, tempfile.mkdtemp(prefix="starloom-load-"))
    src = _source(spark)
    n = src.count()

    first = load.load_table(store, "sale_order", src, "write_date", critical=["name", "state"], run_ts=T1)
    assert (first["mode"], first["reason"], first["inserted"]) == ("full", "table_missing", n)
    hwm = src.agg(F.max("write_date")).first()[0]

    # ten per cent of the orders change state after the watermark, plus one new order
    bump = F.col("id").cast("bigint") % 10 == 0
    changed = src.withColumn("state", F.when(bump, F.lit("Sale")).otherwise(F.col("state"))) \
        .withColumn("write_date", F.when(bump, ts_lit(hwm) + F.expr("interval 1 day")).otherwise(F.col("write_date")))
    new = spark.createDataFrame([("999999", "S000999999", "draft", None, hwm, hwm + dt.timedelta(days=2))],
                                changed.schema)
    src2 = changed.unionByName(new)
    n_bumped = src.where(bump).count()

    second = load.load_table(store, "sale_order", src2, "write_date", critical=["name", "state"], run_ts=T2)
    assert (second["mode"], second["reason"]) == ("incremental", "incremental")
    assert (second["extracted"], second["inserted"], second["updated"]) == (n_bumped + 1, 1, n_bumped)
    cur = store.read("raw", "sale_order")
    assert cur.count() == n + 1
    assert cur.where(bump & (F.col("state") != "Sale")).count() == 0

    published = store.pointer("raw", "sale_order")["path"]
    third = load.load_table(store, "sale_order", src2, "write_date", critical=["name", "state"], run_ts=T3)
    assert (third["mode"], third["extracted"], third["inserted"]) == ("incremental", 0, 0)
    assert store.pointer("raw", "sale_order")["path"] == published  # nothing changed: nothing written

    wm = load.read_watermarks(store).first()
    assert wm["last_extracted_date"] == hwm + dt.timedelta(days=2) and wm["consecutive_failures"] == 0

    # a delta that NULLs the names of a third of the table fails the gate
    broken = src2.withColumn("name", F.when(F.col("id").cast("bigint") % 3 == 0, F.lit(None)).otherwise(F.col("name"))) \
        .withColumn("write_date", F.when(F.col("id").cast("bigint") % 3 == 0, ts_lit(T3)).otherwise(F.col("write_date")))
    before = store.pointer("raw", "sale_order")["path"]
    with pytest.raises(DataQualityError):
        load.load_table(store, "sale_order", broken, "write_date", critical=["name", "state"], run_ts=T4)
    assert store.pointer("raw", "sale_order")["path"] == before
    wm = load.read_watermarks(store).first()
    assert wm["last_extracted_date"] == hwm + dt.timedelta(days=2) and wm["consecutive_failures"] == 1
    log = load.read_log(store).orderBy("start_time").collect()
    assert [r["status"] for r in log] == ["completed", "completed", "completed", "quality_failed"]
    assert [r["extraction_type"] for r in log] == ["full", "incremental", "incremental", "incremental"]


def test_empty_source_is_skipped(spark):
    store = control.TableStore(spark, tempfile.mkdtemp(prefix="starloom-load-"))
    empty = _source(spark).limit(0)
    out = load.load_table(store, "sale_order", empty, "write_date", run_ts=T1)
    assert out["status"] == "skipped_empty" and not store.exists("raw", "sale_order")
    assert load.read_watermarks(store).count() == 0
    assert [r["status"] for r in load.read_log(store).collect()] == ["skipped_empty"]


def test_loads_of_several_tables_at_once(spark):
    store = control.TableStore(spark, tempfile.mkdtemp(prefix="starloom-load-"))
    src = _source(spark).where("cast(id as bigint) % 50 = 0")
    names = ["t1", "t2", "t3", "t4"]
    with ThreadPoolExecutor(4) as pool:
        out = list(pool.map(lambda t: load.load_table(store, t, src, "write_date", run_ts=T1), names))
    assert [o["status"] for o in out] == ["completed"] * 4
    assert sorted(r["table_name"] for r in load.read_watermarks(store).collect()) == names
    log = load.read_log(store).collect()
    assert sorted(r["table_name"] for r in log) == names
    assert len({r["id"] for r in log}) == 4 and None not in {r["id"] for r in log}


def test_crash_between_publish_and_log(spark, monkeypatch):
    store = control.TableStore(spark, tempfile.mkdtemp(prefix="starloom-load-"))
    src = _source(spark).where("cast(id as bigint) % 50 = 0")
    load.load_table(store, "t", src, "write_date", run_ts=T1)
    hwm = src.agg(F.max("write_date")).first()[0]
    late = spark.createDataFrame([("999999", "S1", "draft", None, hwm, hwm + dt.timedelta(days=1))], src.schema)

    def lost(*_):
        raise OSError("executor lost")

    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(load, "_log", lost)
        load.load_table(store, "t", src.unionByName(late), "write_date", run_ts=T2)
    assert load.read_watermarks(store).first()["last_extracted_date"] == hwm
    again = load.load_table(store, "t", src.unionByName(late), "write_date", run_ts=T3)
    assert (again["extracted"], again["inserted"], again["updated"]) == (1, 0, 1)
    assert store.read("raw", "t").count() == src.count() + 1
    assert load.read_watermarks(store).first()["last_extracted_date"] == hwm + dt.timedelta(days=1)


def test_increments_are_sanitised_cast_and_reported(spark):
    store = control.TableStore(spark, tempfile.mkdtemp(prefix="starloom-load-"))
    schema = "id string, name string, amount string, rate double, write_date timestamp_ntz"
    day = dt.datetime(2024, 1, 1)
    first = [("1", "a", "10", 1.5, day), ("2", "None", "x", float("inf"), day), ("3", "c", "7", 2.0, day)]
    types = {"amount": "integer"}
    load.load_table(store, "p", spark.createDataFrame(first, schema), "write_date", run_ts=T1, types=types)
    later = day + dt.timedelta(days=1)
    second = first[:1] + [("2", "nan", "y", float("nan"), later), ("3", "<NA>", "8", 3.0, later), ("4", "d", "z", 1.0, later)]
    out = load.load_table(store, "p", spark.createDataFrame(second, schema), "write_date", run_ts=T2, types=types)
    assert (out["inserted"], out["updated"]) == (1, 2)
    rows = store.read("raw", "p").orderBy("id").select("id", "name", "amount", "rate").collect()
    assert [tuple(r) for r in rows] == [("1", "a", 10, 1.5), ("2", None, None, None), ("3", None, 8, 3.0), ("4", "d", None, 1.0)]
    rejects = load.read_rejects(store, "p").collect()
    assert sorted((r["column"], r["rejected"]) for r in rejects) == [("amount", 1), ("amount", 2)]
    assert out["run_id"] in {r["run_id"] for r in rejects}


def _changing(spark, n=400, late=0):
    """Orders changed on distinct days; ``late`` moves the first ids to later dates."""
    day = F.when(F.col("id") < late, 5000 + F.col("id")).otherwise(F.col("id") % 97)
    return spark.range(n).select(F.col("id"), F.concat(F.lit("n"), "id").alias("name"), (F.col("id") * 2).alias("v"),
                                 (F.lit("2020-01-01").cast("timestamp_ntz") + F.make_interval(days=day.cast("int"))).alias("write_date"))


def test_killed_run_is_resumed_after_its_last_finished_batch(spark):
    store = control.TableStore(spark, tempfile.mkdtemp(prefix="starloom-load-"))
    kw = dict(date_col="write_date", critical=["name"], n_buckets=8, batch_rows=10, batches_per_job=1)
    load.load_table(store, "t", _changing(spark), run_ts=T1, **kw)
    changed = _changing(spark, 420, 45)
    read = []

    def dies(batches):
        if batches[0] == 2:
            raise OSError("killed")
        read.extend(batches)

    with pytest.raises(OSError):
        load.load_table(store, "t", changed, run_ts=T2, on_batches=dies, **kw)
    assert read == [0, 1]
    progress = resume.read_progress(store, "t")
    assert progress.schema.simpleString() == spark.createDataFrame([], control.PROGRESS_SCHEMA).schema.simpleString()
    assert sorted(r.batch_no for r in progress.where("status = 'completed'").collect()) == [0, 1]
    manifest = {r.batch_no: r for r in resume.read_manifest(store, "t").collect()}
    assert sum(r.rows for r in manifest.values()) == 45
    assert store.read("raw", "t").count() == 400  # nothing of a killed run is published

    # batches 1 and 2 cannot be read again: their rows are gone from the source
    done = (F.col("write_date") > "2033-09-09") & (F.col("id") < 20)
    again = []
    out = load.load_table(store, "t", changed.where(~done), run_ts=T3, on_batches=again.extend, **kw)
    assert again == list(range(2, len(manifest))) and out["resumed"] and out["batches"] == len(manifest) - 2
    assert (out["extracted"], out["inserted"], out["updated"]) == (45, 0, 45)
    rows = {r.id: (r.name, r.v, r.write_date) for r in store.read("raw", "t").collect()}
    want = {r.id: (r.name, r.v, r.write_date) for r in changed.where("id < 400").collect()}
    assert rows == want
    stamps = {r[0] for r in store.read("raw", "t").where("id < 45").select("_extracted_at").distinct().collect()}
    assert stamps == {T2}  # one extraction instant per run
    assert resume.open_run(store, "t") is None
    last = load.load_table(store, "t", changed, run_ts=T4, **kw)
    assert (last["extracted"], last["resumed"]) == (0, False)


def test_source_reads_do_not_grow_with_the_batches(spark):
    def reads(per_job):
        read = spark.sparkContext.accumulator(0)

        def counted(batches):
            for batch in batches:
                read.add(batch.num_rows)
                yield batch

        store = control.TableStore(spark, tempfile.mkdtemp(prefix="starloom-load-"))
        kw = dict(date_col="write_date", critical=["name"], n_buckets=4, batch_rows=10)
        load.load_table(store, "t", _changing(spark), run_ts=T1, **kw)
        changed = _changing(spark, 420, 45)
        source = changed.mapInArrow(counted, changed.schema).withColumn("v", F.lit(None))
        waves = []
        out = load.load_table(store, "t", source, run_ts=T2, batches_per_job=per_job, on_batches=waves.append, **kw)
        assert [b for w in waves for b in w] == list(range(out["batches"]))
        assert (out["extracted"], out["inserted"], out["updated"]) == (45, 0, 45)
        rows = {r.id: (r.name, r.v, r.write_date) for r in store.read("raw", "t").collect()}
        assert rows == {r.id: (r.name, r.v if r.id >= 45 else None, r.write_date) for r in changed.where("id < 400").collect()}
        return read.value, len(waves)

    (few, one), (many, five) = reads(10), reads(1)
    assert (one, five) == (1, 5) and many == few


def test_an_increment_reads_its_source_once_to_count_and_once_to_land(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    store = control.TableStore(spark, tempfile.mkdtemp(prefix="starloom-load-"))
    kw = dict(date_col="write_date", critical=["name"], n_buckets=4, batch_rows=10)
    load.load_table(store, "t", _changing(spark), run_ts=T1, **kw)
    changed = _changing(spark, 420, 45)
    out = load.load_table(store, "t", changed.mapInArrow(counted, changed.schema), run_ts=T2, batches_per_job=2, **kw)
    assert (out["mode"], out["batches"], out["updated"]) == ("incremental", 5, 45)
    assert read.value == 2 * changed.count()
    read.value = 0
    again = load.load_table(store, "t", changed.mapInArrow(counted, changed.schema), run_ts=T3, **kw)
    assert (again["extracted"], read.value) == (0, changed.count())  # nothing changed: counted, nothing landed


def test_bad_batches_are_not_resumed(spark):
    store = control.TableStore(spark, tempfile.mkdtemp(prefix="starloom-load-"))
    kw = dict(date_col="write_date", critical=["name"], n_buckets=4, batch_rows=20)
    load.load_table(store, "t", _changing(spark), run_ts=T1, **kw)
    broken = _changing(spark, 400, 200).withColumn("name", F.when(F.col("id") >= 200, F.col("name")))
    with pytest.raises(DataQualityError):
        load.load_table(store, "t", broken, run_ts=T2, **kw)
    assert resume.open_run(store, "t") is None
    out = load.load_table(store, "t", _changing(spark, 400, 200), run_ts=T3, **kw)
    assert (out["resumed"], out["updated"]) == (False, 200)
    history = control.read_verdicts(store, "t").where("gate = 'null_pct'").orderBy("checked_at").collect()
    assert [r["status"] for r in history] == ["PASS", "FAIL", "PASS"]


def test_batches_never_cut_equal_keys_and_types_survive(spark):
    source = spark.range(100).select((F.col("id") % 9 - 4).alias("id"), F.lit("x").alias("name"),
                                     F.make_timestamp_ntz(F.lit(2020), F.lit(1), (1 + F.col("id") % 2).cast("int"), F.lit(0), F.lit(0),
                                                          F.lit(0.25)).alias("write_date"))
    manifest = ingest.keyset_manifest(source, "write_date", "id", 4).collect()
    assert sum(r.rows for r in manifest) == 100
    parts = [source.where(ingest.in_batch(source, r.asDict(), "write_date")).count() for r in manifest]
    assert parts == [r.rows for r in manifest] and len(manifest) == 5


def test_null_keys_fail_before_anything_is_staged(spark):
    store = control.TableStore(spark, tempfile.mkdtemp(prefix="starloom-load-"))
    load.load_table(store, "t", _changing(spark), "write_date", run_ts=T1)
    bad = _changing(spark, 400, 30).withColumn("id", F.when(F.col("id") != 3, F.col("id")))
    with pytest.raises(DeltaKeyError, match="1 delta rows"):
        load.load_table(store, "t", bad, "write_date", run_ts=T2)
    assert resume.read_manifest(store, "t").count() == 0


def test_configuration_by_table(spark):
    store = control.TableStore(spark, tempfile.mkdtemp(prefix="starloom-load-"))
    message = _changing(spark, 50).withColumnRenamed("write_date", "date")
    assert load.load_table(store, "mail_message", message, run_ts=T1)["max_date"] == message.agg(F.max("date")).first()[0]
    partner = _changing(spark, 50).withColumn("name", F.lit(None).cast("string"))
    with pytest.raises(DataQualityError, match="null_pct on name"):  # res_partner.name is critical
        load.load_table(store, "res_partner", partner, run_ts=T1)
    with pytest.raises(ValueError, match="no tracking column"):
        load.load_table(store, "unknown", partner, run_ts=T1)
