"""Every registered query against its DuckDB oracle at sf0.01 (the driver's check)."""

import math

import duckdb
import pytest

import __spark_entry__ as E

from data_dirs import SF01

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
# the operators of the optional subpackage have tests of their own
QUERIES = {k: f for k, f in E.queries().items() if f.__module__.startswith("sonara.plans")}
ORACLE = {k: q for k, q in E.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF01}/{t}.parquet')")
    return c


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "FLOAT": "float", "VARCHAR": "string",
         "STRING": "string", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "NUMBER": "double"}
ROWS_ONLY = set()


def test_every_query_has_an_oracle_or_is_declared():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["song_id", "band", "timeseries", "db"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF01)
    rows = [tuple(norm(v) for v in r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    cols = [c[0] for c in res.description]
    assert sorted(cols) == sorted(df.columns)
    types = {c: TYPES.get(str(t).split("(")[0], str(t)) for c, t in zip(cols, [d[1] for d in res.description])}
    assert {f.name: f.dataType.simpleString() for f in df.schema.fields} == types
    idx = [cols.index(c) for c in df.columns]
    orows = [tuple(norm(r[i]) for i in idx) for r in res.fetchall()]
    assert sorted(rows, key=repr) == sorted(orows, key=repr)
