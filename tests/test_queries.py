"""Every registered query against its SQL on the small tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from __spark_entry__ import entry
from seqlab.catalog import ORACLE, QUERIES

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert __spark_entry__.queries().items() >= QUERIES.items() and __spark_entry__.oracle_sql().items() >= ORACLE.items()


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, str(FOLDER))
    columns = sorted(df.columns)
    got = sorted(map(repr, (tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect())))
    listed = ", ".join(f'"{c}"' for c in columns)
    want = sorted(map(repr, con.execute(f"SELECT {listed} FROM ({ORACLE[name]})").fetchall()))
    assert got == want
