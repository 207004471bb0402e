"""Every registered query against its DuckDB oracle on the smallest tables
(the driver repeats this at sf0.01); rows-only queries must run."""

import json
import math

import duckdb
import pytest

from quill.plans.registry import load_all
from quill.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
REG = load_all()
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "float": "FLOAT"}


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return [_norm(x) for x in v]
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(REG))
def test_query(spark, duck, name):
    q = REG[name]
    df = q.build(spark, SF)
    cols = sorted(df.columns)
    rows = sorted(json.dumps([_norm(r[c]) for c in cols], default=str) for r in df.collect())
    if q.sql is None:
        assert len(df.columns) > 0
        return
    types = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {q.sql}").fetchall()}
    for f in df.schema.fields:          # same column types in both engines
        assert SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) == types.get(f.name), f.name
    rel = duck.execute(q.sql)
    dcols = [d[0] for d in rel.description]
    assert cols == sorted(dcols)
    order = sorted(range(len(dcols)), key=lambda i: dcols[i])
    drows = sorted(json.dumps([_norm(r[i]) for i in order], default=str) for r in rel.fetchall())
    assert rows == drows
