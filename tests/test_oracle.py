"""Every registered query against its DuckDB SQL twin (same parquet tables).

Runs on sf0.001 by default; ``FEEDLENS_ORACLE_SF=/root/testdata/sf0.1`` picks another data folder.
"""

from __future__ import annotations

import math
import os

import pytest

import __spark_entry__ as E
from feedlens.plans import catalog

from .conftest import SF_SMALL

SF_DIR = os.environ.get("FEEDLENS_ORACLE_SF", SF_SMALL)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_DIR}/{t}.parquet')")
    return con


SPARK_TO_DUCKDB = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return repr(v)


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(E.queries()) and set(catalog.oracle_sql()) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_DIR)
    cols = sorted(df.columns)
    got = sorted(tuple(norm(x) for x in r) for r in df.select(*cols).collect())
    rel = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in rel.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    want = sorted(tuple(norm(r[i]) for i in idx) for r in rel.fetchall())
    assert got == want
    types = {f.name: SPARK_TO_DUCKDB.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    duck_types = {r[0]: r[1] for r in duck.execute(f"describe {E.oracle_sql()[name]}").fetchall()}
    assert types == duck_types


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["category", "top10_tags"]
    assert df.count() >= 0
