"""Every registered query against its SQL twin."""

import importlib.util
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

_spec = importlib.util.spec_from_file_location(
    "spark_entry", Path(__file__).resolve().parents[1] / "__spark_entry__.py"
)
entry = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(entry)
# queries of the optional part have tests of their own
QUERIES, ORACLES = entry.registered.queries(), entry.oracle.oracles()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 150


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    order = sorted(columns)
    expected = sorted(
        (tuple(row[columns.index(c)] for c in order) for row in cursor.fetchall()), key=repr
    )
    got = sorted((tuple(row[c] for c in order) for row in df.collect()), key=repr)
    assert got == expected
