"""Every registered query with an SQL twin, compared with DuckDB on sf0.001."""

import glob
import math

import duckdb
import pytest

from voxloom.plans import registry

DATA = "/root/testdata/sf0.001"


def canon(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    fix = lambda v: round(v, 4) + 0.0 if isinstance(v, float) and not math.isnan(v) else v
    return sorted([tuple(fix(r[i]) for i in order) for r in rows], key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {f.split('/')[-1].split('.')[0]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, DATA)
    got = canon([tuple(r) for r in df.collect()], df.columns)
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    ran = duck.execute(sql)
    names = [d[0] for d in ran.description]
    assert sorted(names) == sorted(df.columns)
    want = canon(ran.fetchall(), names)
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g == w
