"""Every registered query against its SQL in DuckDB, plus plan checks on the shared steps."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, queries
from logharbor.catalog import ORACLES, QUERIES
from tools.check import rows_of

SQL = ORACLES


@pytest.fixture(scope="module")
def con(sf_dir):
    db = duckdb.connect()
    for name in os.listdir(sf_dir):
        if name.endswith(".parquet"):
            db.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{sf_dir}/{name}'")
    return db


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf_dir, con, name):
    df = queries()[name](spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    result = con.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert not [d for d in result.description if "HUGEINT" in str(d[1]).upper()]
    assert got == rows_of(columns, result.fetchall())
    assert got


def test_every_query_has_sql():
    assert sorted(QUERIES) == sorted(ORACLES)


def test_no_event_is_lost(spark, sf_dir):
    """The rendered log keeps every event; its gaps are skipped numbers."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    assert queries()["ts_errors"](spark, sf_dir).first().lines == events
    assert spark.read.parquet(f"{sf_dir}/events.parquet").filter("event_id % 101 = 0").count() > 0
    assert queries()["gap_counts"](spark, sf_dir).agg({"gaps": "sum"}).first()[0] > 0


def test_entry(spark):
    assert entry(spark).columns == ["topic", "partition", "ts_source", "label", "lines"]


def test_decode_query_needs_no_shuffle(spark, sf_dir):
    plan = queries()["timestamp_source"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,props:string>" in plan
