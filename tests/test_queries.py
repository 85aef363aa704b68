"""Every registered query against its SQL twin, on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
TABLES = [f[:-8] for f in os.listdir(SF_DIR)] if os.path.isdir(SF_DIR) else []
pytestmark = pytest.mark.skipif(not TABLES, reason="driver tables are not here")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def _sorted(rows):
    def clean(v):
        return None if isinstance(v, float) and math.isnan(v) else (0.0 if v == 0.0 and isinstance(v, float) else v)

    return sorted((tuple(clean(v) for v in r) for r in rows), key=repr)


def test_only_models_and_sketches_have_no_twin():
    without = set(entry.queries()) - set(entry.oracle_sql())
    assert all(name == "pipeline" or name.startswith("op") for name in without)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, oracle, name):
    df = entry.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    cursor = oracle.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    expected = _sorted([r[i] for i in places] for r in cursor.fetchall())
    assert _sorted(df.select(*columns).collect()) == expected


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_message_books_are_built_for_every_instrument(spark):
    found = entry.queries()["message_books"](spark, SF_DIR).select("base_asset").distinct().collect()
    assert sorted(r[0] for r in found) == [f"C{i}" for i in range(10)]
