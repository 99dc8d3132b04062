"""Every query with SQL gives the same rows in both engines."""

from __future__ import annotations

import os

import duckdb
import pytest

from lumenkg.plans.fixtures import TABLES
from lumenkg.plans.oracles import ORACLES
from lumenkg.plans.registry import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v) -> str:
    if v is None:
        return "null"
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    return str(v)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    ours = sorted("|".join(plain(r[c]) for c in columns) for r in df.collect())
    relation = duck.sql(ORACLES[name])
    assert sorted(relation.columns) == columns
    theirs = sorted("|".join(plain(r[relation.columns.index(c)]) for c in columns) for r in relation.fetchall())
    assert ours == theirs
