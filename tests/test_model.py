"""Fit, predict, figures and ranking, against Spark's own evaluator and recommender."""

import numpy as np
import pytest
from conftest import SMALL
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from shelfwise.operators import evaluate, split, topk
from shelfwise.operators.factorize import (
    AlsSettings, fit, load_model, predict, settings_report,
)
from shelfwise.plans import registry
from shelfwise.session import materialize


@pytest.fixture(scope="module")
def model(spark):
    return registry.model(spark, SMALL, 0.8)


@pytest.fixture(scope="module")
def held_out(spark):
    return split.hashed_halves(registry.encoded(spark, SMALL))[1]


def lists(df):
    return {r.user_id_int: [(i.product_id_int, i.rating) for i in r.recommendations]
            for r in df.collect()}


def same_lists(ours, theirs):
    assert ours.keys() == theirs.keys()
    for user, items in ours.items():
        other = theirs[user]
        assert [i for i, _ in items] == [i for i, _ in other]
        assert np.allclose([s for _, s in items], [s for _, s in other], atol=2e-5)


def test_settings_and_blocks():
    settings = AlsSettings()
    assert (settings.rank, settings.max_iter, settings.reg_param) == (10, 10, 0.1)
    assert settings.blocks(6_700_000) == 10
    assert settings.blocks(100_000_000) == 50
    with pytest.raises(ValueError, match="max_blocks"):
        settings.blocks(10**12)
    assert AlsSettings(n_blocks=40).blocks(10**12) == 40


def test_report_names_every_setting(spark):
    report = settings_report(AlsSettings(), 1000)
    assert report["rank"] == "10" and report["coldStartStrategy"] == "drop"
    assert report["implicitPrefs"] == "False" and report["nonnegative"] == "False"


def test_same_factors_as_a_plain_fit(spark, model):
    from pyspark.ml.recommendation import ALS
    train = split.hashed_halves(registry.encoded(spark, SMALL))[0]
    plain = ALS(
        userCol="user_id_int", itemCol="product_id_int", ratingCol="rating", rank=10, maxIter=10,
        regParam=0.1, coldStartStrategy="drop",
    ).fit(train)
    ours = {r.id: r.features for r in model.userFactors.collect()}
    for r in plain.userFactors.collect():
        assert np.allclose(ours[r.id], r.features, atol=1e-4)


def test_rmse_equals_the_evaluator(spark, model, held_out):
    predictions = predict(model, held_out)
    expected = RegressionEvaluator(
        metricName="rmse", labelCol="rating", predictionCol="prediction"
    ).evaluate(predictions)
    row = evaluate.rmse(predictions).first()
    assert row.n == predictions.count() and row.rmse == pytest.approx(expected, rel=1e-9)


def test_nothing_predicted_gives_null(spark, model, held_out):
    row = evaluate.rmse(predict(model, held_out.limit(0))).first()
    assert (row.n, row.rmse) == (0, None)
    row = evaluate.evaluation(predict(model, held_out.limit(0), "nan")).first()
    assert (row.test_rows, row.predicted_rows, row.percent, row.rmse) == (0, 0, None, None)


def test_cold_start(spark, model):
    rows = spark.createDataFrame(
        [("a", "b", 3.0, 0, 0), ("a", "x", 3.0, 0, 10**6), ("y", "b", 3.0, 10**6, 0)],
        "user_id string, product_id string, rating double, user_id_int int, product_id_int int",
    )
    assert predict(model, rows).count() == 1
    kept = predict(model, rows, "nan")
    assert kept.filter(F.isnan("prediction")).count() == 2
    assert evaluate.drop_unpredicted(kept).count() == 1
    assert tuple(evaluate.coverage(kept).first()) == (1, 3, 33.3)
    assert model.getColdStartStrategy() == "drop"


def test_summary_equals_describe(spark, model, held_out):
    predictions = predict(model, held_out)
    text = {r["summary"]: r for r in predictions.select("rating", "prediction").describe().collect()}
    for r in evaluate.summary(predictions, "rating", "prediction").collect():
        name = r.column_name
        assert r.n == int(text["count"][name])
        assert r.mean == pytest.approx(float(text["mean"][name]))
        assert r.stddev == pytest.approx(float(text["stddev"][name]))
        assert r["min"] == pytest.approx(float(text["min"][name]), rel=1e-6)
        assert r["max"] == pytest.approx(float(text["max"][name]), rel=1e-6)


def test_lists_equal_the_built_in(spark, model):
    same_lists(lists(topk.recommend_all(model)), lists(model.recommendForAllUsers(10)))


def test_more_than_all_products(spark, model):
    ours, theirs = topk.recommend_all(model, 500), model.recommendForAllUsers(500)
    assert {u: sorted(i for i, _ in v) for u, v in lists(ours).items()} == {
        u: sorted(i for i, _ in v) for u, v in lists(theirs).items()}


def test_requested_users(spark, model):
    wanted = spark.createDataFrame([(3, 4), (5, 500), (999999, 5), (2**40, 5)], "user_id bigint, k int")
    ours = lists(topk.recommend_for(model, wanted))
    theirs = lists(model.recommendForUserSubset(
        wanted.filter("user_id < 10").selectExpr("cast(user_id as int) user_id_int"), 500))
    assert ours.keys() == {3, 5}
    assert [i for i, _ in ours[3]] == [i for i, _ in theirs[3]][:4]
    assert len(ours[5]) == len(theirs[5])


def test_no_list_for_no_length(model):
    with pytest.raises(ValueError):
        topk.recommend_all(model, 0)


def brute_force(users, items, k):
    out = {}
    for u, f in enumerate(users):
        scores = [(-sum(float(a) * float(b) for a, b in zip(f, g)), i) for i, g in enumerate(items)]
        out[u] = [i for _, i in sorted(scores)[:k]]
    return out


def vectors(spark, matrix):
    return spark.createDataFrame(
        [(i, [float(x) for x in row]) for i, row in enumerate(matrix)],
        "id int, features array<float>",
    )


def ranked(rows):
    out = {}
    for r in rows.orderBy("id", "rank").collect():
        out.setdefault(r.id, []).append(r.item)
    return out


@pytest.mark.parametrize("pairs", [topk.PAIRS, 700])
def test_equal_scores_go_by_id(spark, pairs):
    """A third of the items is one vector, some are zero; small blocks make many tasks."""
    rng = np.random.default_rng(3)
    items = rng.integers(-2, 3, size=(150, 3)).astype(np.float32)
    items[::3] = [1, 1, 0]
    items[1::10] = 0
    users = rng.integers(-2, 3, size=(40, 3)).astype(np.float32)
    got = topk.top_k(vectors(spark, users), vectors(spark, items), 20, pairs=pairs)
    assert ranked(got) == brute_force(users, items, 20)


@pytest.mark.parametrize("scale", [1e-25, 1e-20, 1, 1e15, 1e30])
def test_very_small_and_very_large_vectors(spark, scale):
    """Scores beyond the range of single precision, of lengths that differ by orders."""
    rng = np.random.default_rng(5)
    items = (rng.normal(size=(60, 4)) * np.logspace(3, -6, 60)[:, None] * scale).astype(np.float32)
    users = (rng.normal(size=(9, 4)) * scale).astype(np.float32)
    got = topk.top_k(vectors(spark, users), vectors(spark, items), 5)
    assert ranked(got) == brute_force(users, items, 5)


def test_equal_scores_of_a_model_go_by_product(spark, model, tmp_path):
    """A model in which many products have the factors of product 0."""
    path = str(tmp_path / "model")
    model.write().save(path)
    first = model.itemFactors.where("id = 0").first().features
    items = model.itemFactors.where("id < 12").select("id", F.when(
        F.col("id") < 9, F.array(*map(F.lit, first))).otherwise(
        F.col("features")).cast("array<float>").alias("features"))
    items = spark.createDataFrame(items.collect(), model.itemFactors.schema)
    items.write.mode("overwrite").parquet(f"{path}/itemFactors")
    for found in lists(topk.recommend_all(load_model(spark, path), 5)).values():
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))
        same = [i for i, score in found if i < 9]
        assert same == list(range(len(same)))


def test_no_items_no_lists(spark):
    none = vectors(spark, np.ones((1, 2))).limit(0)
    assert topk.top_k(vectors(spark, np.ones((2, 2))), none, 3).count() == 0


def test_fit_checkpoints_in_the_shared_folder(spark):
    assert spark.sparkContext.getCheckpointDir()
    tiny = spark.createDataFrame(
        [(i % 5, i % 7, float(i % 5 + 1)) for i in range(35)],
        "user_id_int int, product_id_int int, rating double",
    )
    assert fit(tiny, AlsSettings(max_iter=3)).rank == 10


def test_skewed_ids_are_split_in_prediction_joins(spark, model):
    """A third of the rows has one user, a third one product; both joins split them."""
    i = F.col("id")
    rows = spark.range(300_000).select(
        F.when(i % 3 == 0, 7).otherwise(i % 150).cast("int").alias("user_id_int"),
        F.when(i % 3 == 1, 11).otherwise(i % 190).cast("int").alias("product_id_int"),
        (i % 5 + F.rand(1)).alias("rating"),
    )
    rows = materialize(rows.repartition(16), "rows")
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "60KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k) for k in small}
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        predicted = predict(model, rows, "nan").select("rating", "prediction")
        assert len(predicted.collect()) == 300_000
        plan = predicted._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert plan.split("== Initial Plan")[0].count("SortMergeJoin(skew=true)") == 2
