"""Every query against its SQL on the smallest tables, and the entry contract."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        path = f"{sf_dir}/{name}" + ("/*.parquet" if os.path.isdir(f"{sf_dir}/{name}") else "")
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{path}'")
    return con


def plain(v):
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v + 0.0, 5)
    return v if isinstance(v, (int, str, type(None))) else round(float(v), 5)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    found = duck.execute(SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(names)
    columns = sorted(names)
    mine = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    assert mine == sorted(repr([plain(r[names.index(c)]) for c in columns]) for r in found.fetchall())


@pytest.mark.parametrize("name", ["jets_ee_genkt", "jets_substructure", "thrust"])
def test_kernels_give_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)
