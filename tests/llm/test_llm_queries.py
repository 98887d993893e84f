"""Queries that SQL can express, against DuckDB on whole small tables."""

import duckdb
import pytest
from conftest import SMALL

from shelfwise.llm.oracles import ORACLES
from shelfwise.llm.queries import QUERIES

TABLES = ("documents", "embeddings", "pages", "conversations")


def plain(rows):
    return sorted(map(repr, rows))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    with duckdb.connect() as db:
        for table in TABLES:
            db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
        wanted = db.sql(ORACLES[name])
        names = sorted(wanted.columns)
        wanted = wanted.select(*(f'"{n}"' for n in names)).fetchall()
    found = QUERIES[name](spark, SMALL)
    assert sorted(found.columns) == names
    assert plain(map(tuple, found.select(*names).collect())) == plain(wanted)
