"""Queries with lists rank by blocks of matrices, without Spark's own recommender."""

import pytest
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import functions as F

from shelfwise.plans import registry


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """30 customers, 40 parts; each customer has an order of 12 lines."""
    path = str(tmp_path_factory.mktemp("tables"))
    orders = spark.range(30).select(
        F.col("id").alias("o_orderkey"), (F.col("id") + 1).alias("o_custkey"),
        F.lit(2.5).alias("o_totalprice"), F.lit("2024-01-01").cast("timestamp").alias("o_orderdate"))
    lines = spark.range(360).select(
        (F.col("id") % 30).alias("l_orderkey"), (F.col("id") * 7 % 40 + 1).alias("l_partkey"),
        F.lit(1).cast("long").alias("l_suppkey"), (F.col("id") % 33 + 8).cast("double").alias("l_quantity"),
        F.lit("N").alias("l_returnflag"))
    events = spark.range(20).select(F.col("id").alias("event_id"), F.col("id").alias("user_id"))
    for name, rows in (("orders", orders), ("lineitem", lines), ("events", events)):
        rows.write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.fixture
def no_builtin(monkeypatch):
    def fail(*_):
        raise AssertionError("Spark's recommender compares all pairs one by one")

    for name in ("recommendForAllUsers", "recommendForUserSubset"):
        monkeypatch.setattr(ALSModel, name, fail)


@pytest.mark.parametrize("name, entries", [
    ("recs_all_shape", False), ("recs_long", True), ("recs_decoded", True),
    ("recs_json_roundtrip", False), ("recs_export_lengths", False)])
def test_lists_of_all_users(spark, folder, no_builtin, name, entries):
    model = registry.model(spark, folder, 0.8)
    n_users, n_items = model.userFactors.count(), model.itemFactors.count()
    rows = registry.QUERIES[name](spark, folder).collect()
    assert len(rows) == n_users * (min(10, n_items) if entries else 1)
    if name == "recs_export_lengths":
        assert {tuple(r)[1:] for r in rows} == {(min(20, n_items),) * 4}


@pytest.mark.parametrize("name", ["recs_subset_shape", "serve_batch", "answer_documents"])
def test_lists_of_requested_users(spark, folder, no_builtin, name):
    rows = registry.QUERIES[name](spark, folder).collect()
    known = {r.user_id_int for r in registry.id_map(spark, folder, "user_id").collect()}
    wanted = [(i, i * 20, i % 7) for i in range(20)]
    lists = {i: n for i, user, n in wanted if user in known and n > 0}
    assert lists
    if name == "recs_subset_shape":
        assert {r.user_id_int for r in rows} == {u for _, u, _ in wanted if u in known}
    else:
        assert {r.request_id for r in rows} == set(range(20))
        assert all(r.n_items == lists[r.request_id] for r in rows if r.request_id in lists)


@pytest.mark.parametrize("name", ["serve_stream", "serve_stream_repeats"])
def test_streamed_lists(spark, folder, no_builtin, name):
    rows = {r.request_id: r for r in registry.QUERIES[name](spark, folder).collect()}
    assert rows.keys() == set(range(20))
    assert {i: rows[i].n_items for i in rows if rows[i].source == "model"} == {1: 1}


@pytest.mark.parametrize("name, expected", [
    ("serve_log", {(20, 1, 1)}),
    ("serve_two_streams", {(i * 20, 2, 2 * (i == 1)) for i in range(20)}),
    ("serve_stream_versions", {(i, 1 + i % 2) for i in range(20)})])
def test_logged_lists(spark, folder, no_builtin, name, expected):
    """Of the requests only the second is for a user of the model and for a list."""
    assert {tuple(r) for r in registry.QUERIES[name](spark, folder).collect()} == expected


def test_stored_lists_beside_those_of_the_model(spark, folder, no_builtin):
    rows = registry.QUERIES["serve_fallback"](spark, folder).collect()
    assert [(r.request_id, r.user_id) for r in rows] == [(3, 60)]


def test_builtin_lists_are_dealt_to_tasks(spark, folder, monkeypatch):
    """Small factor tables are not broadcast, and the session's settings stay as they are."""
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before, seen = spark.conf.get(threshold), []
    builtin = ALSModel.recommendForAllUsers
    monkeypatch.setattr(ALSModel, "recommendForAllUsers", lambda model, k: seen.append(
        (model.getBlockSize(), spark.conf.get(threshold))) or builtin(model, k))
    rows = registry.QUERIES["recs_match_builtin"](spark, folder).collect()
    model = registry.model(spark, folder, 0.8)
    assert len(rows) == model.userFactors.count() * min(10, model.itemFactors.count())
    assert all(r.same_score for r in rows)
    assert seen == [(registry.BUILTIN_BLOCK, "-1")]
    assert model.getBlockSize() == 4096 and spark.conf.get(threshold) == before
