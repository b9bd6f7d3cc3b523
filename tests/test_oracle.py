"""Every registered query next to its SQL on the smallest data set, and the shape of some plans."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from keyflow.plans import catalog, oracle

DATA = Path("/root/testdata/sf0.001")
# The library's own queries; those of the optional subpackage have their tests beside them.
QUERIES, SQL = catalog.QUERIES, oracle.oracle_sql()

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test data not present")


@pytest.fixture(scope="module")
def db():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in sorted(DATA.glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([row[i] for i in order]) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, db, name):
    df = QUERIES[name](spark, str(DATA))
    cursor = db.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    want = comparable(columns, cursor.fetchall())
    assert sorted(columns) == sorted(df.columns)
    assert comparable(df.columns, df.collect()) == want


def test_entry(spark):
    assert entry.entry(spark).count() == 12


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {n for n in QUERIES if n.endswith("_stream") or n.startswith("run_stream")}))
def test_no_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, str(DATA)))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scans_read_only_what_is_needed(spark):
    text = plan(QUERIES["throttle_tumbling"](spark, str(DATA)))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>" in text
    text = plan(QUERIES["key_fanout"](spark, str(DATA)))
    assert "props" not in text.split("ReadSchema")[1]


def test_filters_reach_the_scan(spark):
    text = plan(QUERIES["insert_if_absent"](spark, str(DATA)))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in text


def test_rules_stay_in_one_stage(spark):
    text = plan(QUERIES["process_rules"](spark, str(DATA)))
    assert "Exchange" not in text and "Python" not in text
