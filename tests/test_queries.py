"""Every registered query of the core library against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

from tidewatch.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: "null" if v is None else round(float(v), 6) + 0.0 if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted(columns), sorted((tuple(plain(r[i]) for i in order) for r in values), key=str)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_same_as_sql(spark, db, name):
    df = registry.QUERIES[name](spark, SF)
    got = rows(df.columns, df.collect())
    found = db.execute(registry.ORACLE_SQL[name])
    assert got == rows([d[0] for d in found.description], found.fetchall())
