"""Bucketed tables: only touched buckets change; crashes, gates and recovery; scans of a staged version."""

import datetime as dt
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from starloom.operators import quality
from starloom.operators.upsert import latest_per_key, merge, upsert
from starloom.plans import buckets, control

DAY = dt.datetime(2024, 1, 1)
SCHEMA = "id string, name string, v long, d timestamp_ntz"


def _store(spark):
    return control.TableStore(spark, tempfile.mkdtemp(prefix="starloom-buckets-"))


def _frame(spark, rows):
    return spark.createDataFrame([(i, n, v, DAY + dt.timedelta(days=d)) for i, n, v, d in rows], SCHEMA)


def _files(root):
    return {os.path.join(folder, f): os.stat(os.path.join(folder, f)).st_mtime_ns
            for folder, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def _rows(df):
    return sorted((r["id"] or "", r["name"] or "", r["v"] or 0) for r in df.collect())


def _base(spark, store, n=500, buckets_=16, critical=("name",)):
    change, _ = buckets.publish_version(store, _frame(spark, [(str(i), f"n{i}", i, 0) for i in range(n)]), "raw", "t", "id", buckets_,
                                        critical=list(critical), date_col="d", sort_within=["d"])
    return change


def test_untouched_files_stay_and_touched_buckets_change(spark):
    store = _store(spark)
    assert _base(spark, store).rows == 500
    path = store.pointer("raw", "t")["path"]
    before = _files(path)
    change = buckets.apply_delta(store, _frame(spark, [("3", "new", 1, 5), ("3", "old", 0, 2), ("900", "ins", 2, 4)]), "raw", "t", "id", "d",
                                 critical=["name"], date_col="d", sort_within=["d"])
    after = _files(path)
    assert (change.inserts, change.updates, change.rows, change.max_date) == (1, 1, 501, DAY + dt.timedelta(days=5))
    touched = {r[0] for r in spark.createDataFrame([("3",), ("900",)], "id string").select(buckets.bucket_of("id", 16)).collect()}
    assert change.touched == len(touched) <= 2
    part_of = lambda f: int(f.split("_bucket=")[1].split("/")[0])
    kept = {f: t for f, t in before.items() if part_of(f) not in touched}
    assert kept and all(after[f] == t for f, t in kept.items())
    assert not any(f in after for f in before if part_of(f) in touched)
    want = [(str(i), f"n{i}", i) for i in range(500) if i != 3] + [("3", "new", 1), ("900", "ins", 2)]
    assert _rows(store.read("raw", "t")) == sorted(want)


def test_random_changes_equal_a_plain_dict(spark):
    rng, store, table = random.Random(2), _store(spark), {}
    _base(spark, store, 100, 5)
    table = {str(i): (f"n{i}", i) for i in range(100)}
    for step in range(4):
        delta = [(str(rng.randrange(150)), f"s{step}", rng.randrange(1000), 10 * step + rng.randrange(10)) for _ in range(40)]
        buckets.apply_delta(store, _frame(spark, delta), "raw", "t", "id", "d", critical=["name"], date_col="d")
        for i in {r[0] for r in delta}:
            table[i] = max(((r[3], r[1], r[2]) for r in delta if r[0] == i))[1:]
        assert _rows(store.read("raw", "t")) == sorted((i, *row) for i, row in table.items())
    stats = buckets.bucket_stats(store, "raw", "t").agg(F.sum("rows"), F.sum("unique_ids")).first()
    assert tuple(stats) == (len(table), len(table))


def test_new_columns_and_rows_without_key(spark):
    store = _store(spark)
    base = _frame(spark, [(None if i % 3 == 0 else str(i), f"n{i}", i, 0) for i in range(60)])
    buckets.publish_version(store, base, "raw", "t", "id", 8, date_col="d", min_ratio=0.0)
    per_bucket = store.read_buckets(store.pointer("raw", "t")).where("id is null").groupBy("_bucket").count().count()
    assert per_bucket > 3  # rows without a key are spread
    delta = _frame(spark, [("1", "x", 0, 3), ("77", "y", 1, 3)]).withColumn("extra", F.lit(9))
    buckets.apply_delta(store, delta, "raw", "t", "id", "d", date_col="d", min_ratio=0.0)
    got = store.read("raw", "t")
    assert got.count() == 61 and got.where("id is null").count() == 20
    assert {r["id"]: r["extra"] for r in got.where("extra is not null").collect()} == {"1": 9, "77": 9}


def test_failed_gate_leaves_everything(spark):
    store = _store(spark)
    _base(spark, store)
    before, pointer = _files(store.pointer("raw", "t")["path"]), store.pointer("raw", "t")
    bad = _frame(spark, [(str(i), None, 0, 9) for i in range(250)])
    with pytest.raises(quality.DataQualityError):
        buckets.apply_delta(store, bad, "raw", "t", "id", "d", critical=["name"], run_id="bad", date_col="d")
    assert store.pointer("raw", "t") == pointer and _files(pointer["path"]) == before
    assert [r["status"] for r in control.read_verdicts(store, "t").where("run_id = 'bad' and gate = 'null_pct'").collect()] == ["FAIL"]
    good = buckets.apply_delta(store, _frame(spark, [("1", "ok", 0, 9)]), "raw", "t", "id", "d", critical=["name"], date_col="d")
    assert good.rows == 500  # the failed run's metrics do not count


def test_crash_while_copying_is_finished_by_the_next_writer(spark, monkeypatch):
    store = _store(spark)
    _base(spark, store)
    write = buckets._write

    def dies(df, path, sort_within, dynamic=False):
        if dynamic:
            raise OSError("lost")
        write(df, path, sort_within, dynamic)

    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(buckets, "_write", dies)
        buckets.apply_delta(store, _frame(spark, [("3", "new", 1, 5), ("900", "ins", 2, 4)]), "raw", "t", "id", "d", date_col="d")
    want = sorted([(str(i), f"n{i}", i) for i in range(500) if i != 3] + [("3", "new", 1), ("900", "ins", 2)])
    assert _rows(store.read("raw", "t")) == want  # published: readers take the touched buckets from the stage
    assert buckets.recover(store, "raw", "t") and not buckets.recover(store, "raw", "t")
    assert store.pointer("raw", "t")["stage"] is None and _rows(store.read("raw", "t")) == want
    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(buckets, "_write", dies)
        buckets.apply_delta(store, _frame(spark, [("4", "newer", 1, 6)]), "raw", "t", "id", "d", date_col="d")
    buckets.apply_delta(store, _frame(spark, [("5", "newest", 1, 7)]), "raw", "t", "id", "d", date_col="d")
    got = {r["id"]: r["name"] for r in store.read("raw", "t").collect()}
    assert (got["3"], got["4"], got["5"], len(got)) == ("new", "newer", "newest", 501)


def test_gates_of_untouched_buckets_count(spark):
    """A fifth of the names is NULL in buckets the delta does not touch; one more and the table fails."""
    store = _store(spark)
    rows = [(str(i), None if i % 5 == 0 else "n", i, 0) for i in range(100)]
    buckets.publish_version(store, _frame(spark, rows), "raw", "t", "id", 16, critical=["name"], date_col="d")
    buckets.apply_delta(store, _frame(spark, [("1", "same", 1, 1)]), "raw", "t", "id", "d", critical=["name"], date_col="d")
    with pytest.raises(quality.DataQualityError):
        buckets.apply_delta(store, _frame(spark, [("1", None, 1, 2)]), "raw", "t", "id", "d", critical=["name"], date_col="d")
    with pytest.raises(quality.DataQualityError):  # a column no earlier run has counted
        buckets.apply_delta(store, _frame(spark, [("2", "x", None, 2)]).withColumn("v", F.lit(None).cast("long")), "raw", "t", "id", "d",
                            critical=["name", "v"], date_col="d", source_rows=spark.createDataFrame([(10,)], "source_rows bigint"))


def test_gated_publish_scans_the_stage_for_ids_only(spark, monkeypatch):
    store, plans = _store(spark), []
    source = spark.createDataFrame([(500,)], "source_rows bigint")
    verdicts_of = quality.verdicts_of

    def record(metrics, *args, **kw):
        plans.append(metrics._jdf.queryExecution().executedPlan().toString())
        return verdicts_of(metrics, *args, **kw)

    monkeypatch.setattr(quality, "verdicts_of", record)
    published, verdicts = control.gated_publish(store, _frame(spark, [(str(i), "n", i, 0) for i in range(500)]), "raw", "t", source, ["name", "d"])
    assert published.count() == 500 and {v["status"] for v in verdicts} == {"PASS"}
    scans = [line for line in plans[0].splitlines() if "FileScan" in line]
    assert len(plans) == 1 and len(scans) == 1 and "ReadSchema: struct<id:string>" in scans[0]


@pytest.mark.parametrize("limit", [0, 1 << 40])
def test_both_upsert_plans_agree(spark, limit):
    target = _frame(spark, [(None, "a", 1, 0), (None, "a", 1, 0), ("1", "b", 2, 0), ("2", "c", 3, 0)])
    delta = _frame(spark, [("2", "x", 5, 1), ("2", "y", 6, 2), ("3", "z", 7, 1)]).drop("v").withColumn("w", F.lit(1))
    out = upsert(target, delta, "id", "d", broadcast_bytes=limit)
    assert sorted(map(str, (tuple(r) for r in out.select("id", "name", "v", "w").collect()))) == sorted(
        map(str, [(None, "a", 1, None)] * 2 + [("1", "b", 2, None), ("2", "y", 3, 1), ("3", "z", None, 1)]))
    with pytest.raises(Exception, match="duplicate keys"):
        upsert(target, delta, "id", broadcast_bytes=limit).collect()
    ops = {r["id"]: r["_op"] for r in merge(target.where("id is not null"), latest_per_key(delta, "id", "d")).collect()}
    assert ops == {"1": None, "2": "update", "3": "insert"}
