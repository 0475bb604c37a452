"""Every registered query against its SQL counterpart in DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__
from rillmark.plans import all_queries
from tests.conftest import SF_TINY

QUERIES = __spark_entry__.queries()
ORACLES = __spark_entry__.oracle_sql()

# scans over logs that become heavy when a task may hold only a few rows
SCANS = [
    "sink_batches", "zip_positional", "concat_sources", "merge_preferred", "auth_join", "chat_recipients",
    "agg_signed_counter", "scan_running", "stack_state", "gap_timeout", "priority_order", "err_restart_state",
    "err_policy_wordcount", "err_all_for_one", "session_idle", "snapshot_recover", "vote_validate", "account_guard",
    "fsm_replay", "hold_until_open", "membership_state", "udaf_fold",
]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for file in os.listdir(SF_TINY):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF_TINY}/{file}'")
    yield connection
    connection.close()


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def _check(spark, duck, name):
    frame = QUERIES[name](spark, SF_TINY)
    got = _table(frame.columns, frame.collect())
    answer = duck.execute(ORACLES[name])
    columns = [d[0] for d in answer.description]
    assert got == _table(columns, answer.fetchall())


def test_every_query_has_an_oracle():
    assert {name for name, query in all_queries().items() if query.sql} == set(all_queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    _check(spark, duck, name)


@pytest.mark.parametrize("name", SCANS)
def test_query_on_heavy_logs(spark, duck, name):
    spark.conf.set("spark.rillmark.scan.smallBytes", "0")
    spark.conf.set("spark.rillmark.scan.taskRows", "30")
    try:
        _check(spark, duck, name)
    finally:
        spark.conf.unset("spark.rillmark.scan.smallBytes")
        spark.conf.unset("spark.rillmark.scan.taskRows")
