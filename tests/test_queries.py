"""Every registered query against its SQL on the given tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from layercake.catalog.oracles import ORACLES
from layercake.catalog.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def _types(frame):
    return {f.name: f.dataType.simpleString() for f in frame.schema.fields}


DUCK_TYPES = {"BIGINT": "bigint", "VARCHAR": "string", "BOOLEAN": "boolean"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    assert sorted(columns) == sorted(frame.columns)
    assert expected
    assert _rows(frame.collect(), frame.columns) == _rows(expected, columns)
    described = duck.execute(f"DESCRIBE {ORACLES[name]}").fetchall()
    assert {c[0]: DUCK_TYPES[c[1]] for c in described} == _types(frame)


def test_every_query_is_registered_and_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLES) <= set(entry_module.oracle_sql())


def test_entry(spark):
    frame = entry_module.entry(spark)
    assert frame.count() > 0


@pytest.mark.parametrize("name", ["gold_tracks_refresh", "gold_playlists_refresh"])
def test_refresh_writes_no_table_that_is_read_once(spark, monkeypatch, name):
    from layercake.catalog import queries

    names = []
    real = queries.stage
    monkeypatch.setattr(queries, "stage", lambda s, df, n: names.append(n) or real(s, df, n))
    QUERIES[name](spark, SF_DIR)
    assert len(names) == len(set(names))
