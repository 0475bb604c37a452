"""The queries that SQL can express, against DuckDB."""

import os

import duckdb
import pytest

from rillmark.llm.queries import QUERIES
from rillmark.llm.sql import ORACLE_SQL
from tests.conftest import SF_TINY


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, name):
    duck = duckdb.connect()
    for file in os.listdir(SF_TINY):
        duck.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF_TINY}/{file}'")
    answer = duck.execute(ORACLE_SQL[name])
    columns = [d[0] for d in answer.description]
    frame = QUERIES[name](spark, SF_TINY).select(*columns)
    assert sorted(map(tuple, frame.collect()), key=repr) == sorted(answer.fetchall(), key=repr)
