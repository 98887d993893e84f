import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from shelfwise.operators import serve
from shelfwise.plans import registry
from shelfwise.schemas import REQUESTS, STORED_ANSWERS
from shelfwise.streaming.requests import read_answers, request_stream, serve_stream


@pytest.fixture(scope="module")
def model(spark):
    return registry.model(spark, SMALL, 1)


def requests(spark, rows):
    return spark.createDataFrame(rows, REQUESTS)


def stored(spark):
    return spark.createDataFrame([
        (7_000_000, [(1, 0.5)], "2024-01-02T00:00:00.000000"),
        (7_000_000, [(2, 0.5), (3, 0.25)], "2024-01-01T00:00:00.000000"),
        (5, [(9, 1.5)], "2024-01-01T00:00:00.000000"),
    ], STORED_ANSWERS)


def by_request(df):
    return {r.request_id: r for r in df.collect()}


def test_order_of_sources(spark, model):
    out = by_request(serve.answer(requests(spark, [
        (1, 3, 5), (2, 7_000_000, 1), (3, 8_000_000, 5), (4, 5, 0), (5, 5, -1), (6, 3, None),
        (7, 3, 10_000), (8, 2**40, 5), (9, None, 5), (10, 3, 2), (11, -4, 5), (12, 4, 0),
    ]), model, stored(spark)))
    assert len(out) == 12
    sources = {i: r.source for i, r in out.items()}
    assert sources == {
        1: "model", 2: "stored", 3: "none", 4: "stored", 5: "stored", 6: "model", 7: "model",
        8: "none", 9: "none", 10: "model", 11: "none", 12: "none",
    }
    sizes = {i: len(r.recommendations) for i, r in out.items()}
    assert (sizes[1], sizes[2], sizes[3], sizes[6], sizes[10]) == (5, 2, 0, 5, 2)
    assert sizes[7] == model.itemFactors.count()
    assert [i.product_id for i in out[2].recommendations] == [2, 3]
    assert out[2].timestamp == "2024-01-01T00:00:00.000000"
    assert out[3].message and out[3].timestamp is None and out[1].message is None
    assert out[1].recommendations[:2] == out[10].recommendations


def test_scores_are_widened_floats(spark, model):
    row = serve.answer(requests(spark, [(1, 3, 3)]), model).first()
    want = model.recommendForUserSubset(spark.createDataFrame([(3,)], ["user_id_int"]), 3).first()
    for ours, theirs in zip(row.recommendations, want.recommendations):
        assert ours.product_id == theirs.product_id_int
        assert ours.score == pytest.approx(theirs.rating, abs=2e-5)


def test_very_frequent_user(spark, model):
    rows = spark.range(6000).select(
        F.col("id").alias("request_id"),
        F.when(F.col("id") % 3 == 0, 3).otherwise(F.col("id") % 200).alias("user_id"),
        (F.col("id") % 6).cast("int").alias("n"),
    )
    plain = serve.answer(rows, model, stored(spark), F.lit(0).cast("timestamp"))
    spread = serve.answer(
        rows, model, stored(spark), F.lit(0).cast("timestamp"), slots=50, rows=20
    )
    assert plain.count() == 6000
    assert plain.exceptAll(spread).isEmpty() and spread.exceptAll(plain).isEmpty()


def test_many_askers_take_the_other_way(spark, model, monkeypatch):
    rows = requests(spark, [(1, 3, 5), (2, 7_000_000, 1), (3, 8_000_000, 5)])
    few = serve.answer(rows, model, stored(spark), F.lit(0).cast("timestamp")).collect()
    monkeypatch.setattr(serve, "BROADCAST_USERS", 0)
    many = serve.answer(rows, model, stored(spark), F.lit(0).cast("timestamp")).collect()
    assert sorted(few) == sorted(many)


def test_equal_times_go_by_content(spark):
    when = "2024-01-01T00:00:00.000000"
    df = spark.createDataFrame([(1, [(8, 1.0)], when), (1, [(2, 1.0)], when)], STORED_ANSWERS)
    assert serve.first_stored(df).first().stored.recommendations[0].product_id == 2


def test_only_model_answers_are_logged_once_and_served_later(spark, model, tmp_path):
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    assert serve.read_log(spark, log) is None
    batch = requests(spark, [(1, 3, 5), (2, 9_000_000, 5), (3, 4, 2)])
    for _ in range(2):
        answers = by_request(serve.serve(batch, model, out, log, "b1"))
    assert {i: r.source for i, r in answers.items()} == {1: "model", 2: "none", 3: "model"}
    logged = serve.read_log(spark, log).collect()
    assert sorted(r.user_id for r in logged) == [3, 4]
    later = by_request(serve.serve(requests(spark, [(9, 3, 0)]), model, out, log, "b2"))
    assert later[9].source == "stored"
    assert later[9].recommendations == answers[1].recommendations
    assert later[9].timestamp == answers[1].timestamp
    assert serve.read_log(spark, log).count() == 2
    assert serve.read_log(spark, log, but_batch="b1").count() == 0


def test_timestamps_are_iso_text(spark, model):
    row = serve.answer(
        requests(spark, [(1, 3, 1)]), model,
        served_at=F.lit("2024-05-06 07:08:09.000010").cast("timestamp"),
    ).first()
    assert row.timestamp == "2024-05-06T07:08:09.000010"


def test_stream_answers_each_request_once(spark, model, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("in", "out", "log", "state")}
    batch = requests(spark, [(i, i * 10, 3) for i in range(40)])
    batch.repartition(3).write.parquet(paths["in"])

    def run():
        serve_stream(
            request_stream(spark, paths["in"], 1), model, paths["out"], paths["log"],
            paths["state"],
        ).awaitTermination()
        return read_answers(spark, paths["out"])

    first = run()
    assert sorted(r.request_id for r in first.collect()) == list(range(40))
    requests(spark, [(100, 3, 2), (101, 3, 0)]).write.mode("append").parquet(paths["in"])
    rows = by_request(run())
    assert len(rows) == 42 and rows[100].source == "model"
    known = {r.request_id for r in rows.values() if r.source == "model"}
    assert serve.read_log(spark, paths["log"]).count() == len(known)


def test_one_request(spark, model):
    row = serve.answer(serve.one_request(spark, 3), model).first()
    assert (row.user_id, row.n, len(row.recommendations), row.source) == (3, 5, 5, "model")
    assert serve.answer(serve.one_request(spark, 3, 0), model).first().source == "none"


def test_store_is_left_alone_if_nobody_needs_it(spark, model):
    broken = stored(spark).withColumn("user_id", F.raise_error(F.lit("read")).cast("bigint"))
    rows = serve.answer(requests(spark, [(1, 3, 5), (2, 4, 2)]), model, broken).collect()
    assert {r.source for r in rows} == {"model"}
    with pytest.raises(Exception, match="read"):
        serve.answer(requests(spark, [(1, 3, 0)]), model, broken).collect()
