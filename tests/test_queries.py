"""Every registered query against its SQL, and rules every plan keeps."""

import pytest
from conftest import SMALL
from oracle import connection, spark_rows, sql_rows

from shelfwise.plans.oracles import ORACLES
from shelfwise.plans.registry import QUERIES, flagship


@pytest.fixture(scope="module")
def db():
    return connection(SMALL)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    names, rows = spark_rows(QUERIES[name](spark, SMALL))
    sql_names, expected = sql_rows(db, ORACLES[name])
    assert names == sql_names
    assert rows == expected


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_cross_join_and_no_row_udf(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "PythonUDF"):
        assert node not in plan


def test_flagship_is_complete(spark):
    rows = flagship(spark, SMALL).collect()
    lists = {}
    for row in rows:
        assert row.product_id is not None
        lists.setdefault(row.user_id, {})[row["rank"]] = row.score
    assert len(lists) == 150
    for scores in lists.values():
        assert sorted(scores) == list(range(1, 11))
        ordered = [scores[r] for r in sorted(scores)]
        assert ordered == sorted(ordered, reverse=True)
