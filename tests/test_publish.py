"""Failure injection for gated publish and idempotence of the stream upsert."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from starloom.operators import quality
from starloom.plans import control
from starloom.streaming.stream_upsert import stream_upsert


def _store(spark):
    return control.TableStore(spark, tempfile.mkdtemp(prefix="starloom-store-"))


def test_failed_gate_keeps_published_version(spark):
    store = _store(spark)
    good = spark.createDataFrame([(str(i), "n") for i in range(10)], "id string, name string")
    src = spark.createDataFrame([(10,)], "source_rows bigint")
    pub, _ = control.gated_publish(store, good, "raw", "t", src, critical=["name"], run_id="r1")
    assert pub.count() == 10
    bad = spark.createDataFrame([(str(i), None) for i in range(10)], "id string, name string")
    with pytest.raises(quality.DataQualityError):
        control.gated_publish(store, bad, "raw", "t", src, critical=["name"], run_id="r2")
    cur = store.read("raw", "t")
    assert cur.where(F.col("name").isNull()).count() == 0 and cur.count() == 10
    assert store.pointer("raw", "t")["path"].endswith("v=r1")


def test_stream_upsert_second_run_reads_nothing(spark):
    store = _store(spark)
    landing = os.path.join(store.root, "landing")
    a = spark.createDataFrame([(str(i), i) for i in range(5)], "id string, v long")
    a.write.parquet(os.path.join(landing, "x=1"))
    applied = stream_upsert(spark, os.path.join(landing, "*"), a.schema, store, "raw", "s", key="id")
    assert len(applied) == 1 and store.read("raw", "s").count() == 5
    again = stream_upsert(spark, os.path.join(landing, "*"), a.schema, store, "raw", "s", key="id")
    assert again == []
    b = spark.createDataFrame([("4", 40), ("9", 9)], "id string, v long")
    b.write.parquet(os.path.join(landing, "x=2"))
    stream_upsert(spark, os.path.join(landing, "*"), a.schema, store, "raw", "s", key="id")
    got = {r.id: r.v for r in store.read("raw", "s").collect()}
    assert len(got) == 6 and got["4"] == 40
