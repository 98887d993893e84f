"""The table of first answers, indices that grow, and retrains that keep ids."""

import os
import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from shelfwise.operators import encode, first_answers, serve
from shelfwise.operators.first_answers import FirstAnswers
from shelfwise.plans import jobs, publish, registry
from shelfwise.operators.factorize import AlsSettings
from shelfwise.schemas import STORED_ANSWERS
from shelfwise.session import materialize


def answers(spark, rows):
    """Rows of user, time, product."""
    return spark.createDataFrame(
        [(user, [(product, 0.5)], time) for user, time, product in rows], STORED_ANSWERS)


def content(df):
    return {r.user_id: (r.stored.timestamp, r.stored.recommendations[0].product_id)
            for r in df.collect()}


def size(df, part=""):
    return sum(os.path.getsize(name.replace("file://", "")) for name in df.inputFiles()
               if part in name)


def lookup_bytes(table, users):
    """What a lookup of one user reads: files of the one folder its plan asks for."""
    pointer = table.pointer()
    (row,) = users.select(first_answers._slot(pointer.slots)).collect()
    plan = table.of(users, 1)._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: \[.*?\]", re.sub(r"#\d+", "", plan))
    assert any(f"slot = {row.slot})" in found for found in filters), filters  # not in empty parts
    assert "EqualTo(user_id,7)" in plan
    return sum(size(part, f"/slot={row.slot}/") for part in table.tables(pointer))


def test_earliest_answer_whatever_the_batch(spark, tmp_path):
    table = FirstAnswers(spark, str(tmp_path / "t")).start(slots=4)
    table.add("b1", answers(spark, [(1, "2024-02", 5), (1, "2024-02", 4), (2, "2024-03", 1)]))
    table.add("b2", answers(spark, [(1, "2024-01", 9), (2, "2024-04", 1), (3, "2024-05", 7)]))
    wanted = {1: ("2024-01", 9), 2: ("2024-03", 1), 3: ("2024-05", 7)}
    assert content(table.all()) == wanted
    users = spark.createDataFrame([(1,), (3,), (8,)], "user_id long")
    assert content(table.of(users, 3)) == {1: wanted[1], 3: wanted[3]}
    table.fold()
    assert content(table.all()) == wanted
    # Folded once, written again with other rows: nothing is lost, nothing is taken twice.
    table.add("b2", answers(spark, [(4, "2024-06", 2)]))
    wanted[4] = ("2024-06", 2)
    assert content(table.all()) == wanted
    table.fold()
    table.fold()
    assert content(table.all()) == wanted
    assert len(os.listdir(tmp_path / "t" / "base")) == 2


def test_a_repeated_batch_replaces_its_delta(spark, tmp_path):
    table = FirstAnswers(spark, str(tmp_path / "t")).start(slots=2)
    table.add("b1", answers(spark, [(1, "2024-02", 5), (2, "2024-02", 5)]))
    table.add("b1", answers(spark, [(1, "2024-03", 6)]))
    assert content(table.all()) == {1: ("2024-03", 6)}
    assert content(FirstAnswers(spark, table.root, "b1").all()) == {}


def test_unfinished_deltas_are_left_alone(spark, tmp_path):
    table = FirstAnswers(spark, str(tmp_path / "t")).start(slots=2)
    table.add("b1", answers(spark, [(1, "2024-02", 5)]))
    os.remove(tmp_path / "t" / "delta" / "b1" / "_SUCCESS")
    assert content(table.all()) == {}


def test_lookups_read_no_more_after_ten_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(first_answers, "FOLD_AFTER", 3)
    log, model = str(tmp_path / "log"), registry.model(spark, SMALL, 1)
    requests = spark.createDataFrame(
        [(i, i % 50, 3) for i in range(200)], "request_id long, user_id long, n int")
    users = spark.createDataFrame([(7,)], "user_id long")
    FirstAnswers(spark, f"{log}-first").start(slots=8)
    read = []
    for number in range(10):
        serve.serve(requests, model, str(tmp_path / "answers"), log, f"b{number}")
        read.append(lookup_bytes(serve.first_answers(spark, log), users))
    assert read[-1] == read[0] > 0
    assert serve.read_log(spark, log).count() == 10 * 200
    table = serve.first_answers(spark, log)
    assert content(table.all()) == content(first_answers.earliest(serve.read_log(spark, log)))
    whole = sum(size(part) for part in table.tables(table.pointer()))
    assert 0 < read[-1] < whole / 4  # one folder of eight


def test_table_is_made_of_an_older_log(spark, tmp_path):
    log = str(tmp_path / "log")
    answers(spark, [(1, "2024-02", 5), (1, "2024-01", 6)]).withColumn(
        "served_date", F.lit("2024-01-01").cast("date")).write.partitionBy("served_date").parquet(
        f"{log}/batch=old")
    assert content(serve.first_answers(spark, log).all()) == {1: ("2024-01", 6)}


def test_extended_index(spark):
    known = spark.createDataFrame([("b", 0, 9), ("a", 1, 3)], "user_id string, user_id_int int, n long")
    rows = spark.createDataFrame([("c",), ("d",), ("d",), ("a",), (None,)], "user_id string")
    found = {tuple(r) for r in encode.extend_index(known, rows, "user_id").collect()}
    assert found == {("b", 0, 0), ("a", 1, 1), ("d", 2, 2), ("c", 3, 1)}
    fresh = encode.extend_index(known.limit(0), rows, "user_id")
    assert {r.user_id: r.user_id_int for r in fresh.collect()} == {"d": 0, "a": 1, "c": 2}
    again = encode.extend_index(known, rows.limit(0), "user_id")
    assert {tuple(r) for r in again.collect()} == {("b", 0, 0), ("a", 1, 0)}


def test_retrain_keeps_ids(spark, tmp_path):
    root, few = str(tmp_path / "models"), AlsSettings(max_iter=1)
    ratings = registry.ratings(spark, SMALL)
    early = materialize(ratings.where("product_id < 'P000000120'"), "early")
    for number, rows in enumerate((early, ratings)):
        rows.write.parquet(f"{tmp_path}/r{number}")
        jobs.train_job(spark, f"{tmp_path}/r{number}", root, settings=few, keep_ids=True)
    first, second = (publish.load_published(spark, root, v) for v in (1, 2))
    for name, column in (("user_map", "user_id"), ("product_map", "product_id")):
        before = {r[0]: r[1] for r in getattr(first, name).collect()}
        after = {r[0]: r[1] for r in getattr(second, name).collect()}
        assert {k: after[k] for k in before} == before
        assert sorted(after.values()) == list(range(len(after)))
        assert len(after) == ratings.select(column).distinct().count()
    assert len(before) < len(after)


@pytest.mark.parametrize("fixed", [True, False])
def test_a_model_is_loaded_once_a_version(spark, tmp_path, fixed):
    root, model = str(tmp_path / "models"), registry.model(spark, SMALL, 1)
    maps = [registry.id_map(spark, SMALL, name) for name in ("user_id", "product_id")]
    publish.publish(spark, root, model, *maps)
    current = publish.CurrentModel(spark, root)
    held = current.now()
    if not fixed:
        publish.publish(spark, root, model, *maps)
    assert (current.now() is held) == fixed
    assert current.now()[0] == (1 if fixed else 2)
