"""Tasks that fail half way and run again must not change any result."""

import pytest
from conftest import SMALL
from pyspark import TaskContext

from shelfwise.operators import clean, encode, serve, topk
from shelfwise.plans import fixture, registry
from shelfwise.session import materialize


def flaky(df):
    """``df``, but every other task loses its first attempt after its first batch."""

    def lose_first_attempt(batches):
        task = TaskContext.get()
        for batch in batches:
            yield batch
            if task.attemptNumber() == 0 and task.partitionId() % 2 == 0:
                raise RuntimeError("lost on purpose")

    return df.mapInArrow(lose_first_attempt, df.schema)


@pytest.fixture(scope="module")
def ratings(spark):
    return materialize(registry.ratings(spark, SMALL).repartition(6), "ratings")


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_attempts_do_fail(spark, ratings):
    failed = []
    flaky(ratings).write.format("noop").mode("overwrite").save()
    status = spark.sparkContext.statusTracker()
    for job in status.getJobIdsForGroup(None):
        for stage in status.getJobInfo(job).stageIds:
            info = status.getStageInfo(stage)
            failed.append(info.numFailedTasks if info else 0)
    assert sum(failed) > 0


def test_cleaning(spark):
    raw = materialize(fixture.reviews(spark, SMALL).repartition(5), "raw")
    assert same(clean.clean_reviews(flaky(raw)), clean.clean_reviews(raw))
    assert clean.cleaning_audit(flaky(raw)).first() == clean.cleaning_audit(raw).first()


def test_positions_and_encoding(spark, ratings):
    users = encode.index_by_frequency(flaky(ratings), "user_id")
    assert same(users, encode.index_by_frequency(ratings, "user_id"))
    products = encode.index_by_frequency(ratings, "product_id")
    limits = {"fitted_on_df": True, "slots": 50, "rows": 20}
    assert same(
        encode.encode(flaky(ratings), users, products, **limits),
        encode.encode(ratings, users, products),
    )


def test_ranking(spark):
    model = registry.model(spark, SMALL, 0.8)
    whole = topk.top_k(model.userFactors, model.itemFactors, 10)
    blocks = topk.top_k(flaky(model.userFactors), model.itemFactors, 10, pairs=900)
    assert same(blocks, whole)


def test_answers(spark):
    model = registry.model(spark, SMALL, 1)
    requests = materialize(fixture.requests(spark, SMALL).repartition(4), "requests")
    stored = fixture.stored_answers(spark, SMALL)
    columns = ["request_id", "user_id", "n", "recommendations", "message", "source"]
    lost = serve.answer(flaky(requests), model, flaky(stored), slots=50, rows=5)
    assert same(lost.select(columns), serve.answer(requests, model, stored).select(columns))
