"""Every registered query against its DuckDB oracle (small scale)."""

import hashlib
import math

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

ORACLES = entry.oracle_sql()


def _norm(v):
    if v is None:
        return "\x00"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def con(duck):
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(rows, df.columns) == _digest(orows, ocols)


def test_rows_only_queries_run(spark):
    for name in sorted(set(entry.queries()) - set(ORACLES)):
        assert entry.queries()[name](spark, SF_SMALL).count() >= 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 297
    assert df.schema == entry.entry(spark).schema


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
                 "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "smallint": "SMALLINT"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_types_match_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    duck = {r[0]: r[1] for r in con.execute(f"DESCRIBE {ORACLES[name]}").fetchall()}
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        assert SPARK_TO_DUCK.get(t, t) == duck[f.name], (f.name, t, duck[f.name])
