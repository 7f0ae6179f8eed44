import os

import duckdb
import pytest

from starloom.llm.queries import ORACLES, QUERIES

DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for f in os.listdir(DIR):
        if f.endswith(".parquet"):
            con.execute(f"create view {f[:-8]} as select * from read_parquet('{DIR}/{f}')")
    rel = con.sql(ORACLES[name])
    df = QUERIES[name](spark, DIR).select(*rel.columns)
    assert sorted(map(tuple, df.collect())) == sorted(rel.fetchall())


def test_every_operator_is_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
