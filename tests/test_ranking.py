"""Lists by blocks of matrices against plain comparisons of all pairs."""

from types import SimpleNamespace

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import Window, functions as F

from shelfwise.operators import topk
from shelfwise.operators.factorize import load_model
from shelfwise.plans import registry


def test_any_number_of_equal_scores_goes_by_product(spark, tmp_path):
    """Sixty products with the factors of one: more than a few entries beyond a list's end."""
    model = registry.model(spark, SMALL, 0.8)
    path = str(tmp_path / "model")
    model.write().save(path)
    first = model.itemFactors.where("id = 0").first().features
    rows = [(i, first) for i in reversed(range(60))]
    items = spark.createDataFrame(rows, model.itemFactors.schema).repartition(7)
    items.write.mode("overwrite").parquet(f"{path}/itemFactors")
    for row in topk.recommend_all(load_model(spark, path), 5).collect():
        assert [x.product_id_int for x in row.recommendations] == [0, 1, 2, 3, 4]


def test_null_and_repeated_vectors(spark):
    """Nulls, values that are no numbers, other lengths and ids that repeat, as a plain join has
    them."""
    rng = np.random.default_rng(1)
    rows = [(i % 50, [float(x) for x in rng.normal(size=3)]) for i in range(70)]
    rows += [(60, None), (61, [1.0, None, 2.0]), (62, [float("nan"), 0.0, 1.0]), (63, [1.0, 2.0]),
             (64, [float("inf"), 1.0, 1.0]), (None, [1.0, 2.0, 3.0])]
    vectors = spark.createDataFrame(rows, "id bigint, features array<float>")
    items = spark.createDataFrame(rows, "item bigint, other array<float>")
    scores = vectors.crossJoin(items).select(
        "id", "item", topk.dot("features", "other").alias("score"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "item"))
    expected = scores.withColumn("rank", rank).where("rank <= 6")
    columns = ["id", "rank", "item", "score"]
    found = topk.top_k(vectors, vectors, 6, pairs=500).select(columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.select(columns).collect()))


def test_long_lists_and_many_items(spark):
    """More items than one product of matrices has, users far from and near to the origin."""
    rng = np.random.default_rng(2)
    items = np.round(rng.normal(size=(9000, 4)) + 1, 1).astype(np.float32)
    users = (rng.normal(size=(30, 4)) * np.logspace(-6, 3, 30)[:, None]).astype(np.float32)
    users[3] = 0

    def table(matrix):
        return spark.createDataFrame(
            [(i, [float(x) for x in row]) for i, row in enumerate(matrix)],
            "id int, features array<float>")

    found = {}
    for row in topk.top_k(table(users), table(items), 40, pairs=20_000).orderBy("rank").collect():
        found.setdefault(row.id, []).append(row.item)
    for i, user in enumerate(users):
        scores = np.zeros(len(items))
        for d in range(4):
            scores += user[d].astype(np.float64) * items[:, d].astype(np.float64)
        assert found[i] == np.lexsort((np.arange(len(items)), -scores))[:40].tolist()


@pytest.mark.parametrize("most, users", [(10**6, 0), (12, 2), (0, 301)])
def test_what_users_have_seen_is_hidden_or_taken_out(spark, monkeypatch, most, users):
    """Only those who have seen very much get long lists. Some have seen all products, some none;
    pairs come twice, have nulls or ids of neither users nor products."""
    rng = np.random.default_rng(3)
    n = 70
    vectors = rng.normal(size=(300 + n, 3)).astype(np.float32)
    wide = "id int, features array<float>"
    of_users = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors[:300])], wide)
    of_items = spark.createDataFrame(
        [(3 * i, v.tolist()) for i, v in enumerate(vectors[300:])], wide)
    model = SimpleNamespace(userFactors=of_users.repartition(3), itemFactors=of_items, rank=3)
    seen = {(i, 3 * j) for i in range(2, 300) for j in rng.integers(0, n, 9).tolist()}
    seen |= {(0, 3 * j) for j in range(n)} | {(1, 3 * j) for j in range(4, n)}
    rows = [*seen, *list(seen)[:50], (7, 1), (900, 3), (None, 3), (5, None)]
    asked = []
    for_some = topk.recommend_for
    monkeypatch.setattr(topk, "recommend_for", lambda model, wanted: asked.append(
        wanted.count()) or for_some(model, wanted))
    monkeypatch.setattr(topk, "MOST_SEEN", most)
    found = {}
    for r in topk.recommend_unseen(model, spark.createDataFrame(
            rows, "user_id_int int, product_id_int int"), 6).orderBy("rank").collect():
        assert r.rank == len(found.setdefault(r.user_id_int, [])) + 1
        found[r.user_id_int].append(r.product_id_int)
    assert sum(asked) == users
    for i in range(300):
        left = [j for j in range(n) if (i, 3 * j) not in seen]
        scores = (vectors[i].astype(np.float64) * vectors[300:].astype(np.float64)).sum(1)
        scores = scores.astype(np.float32)
        order = sorted(left, key=lambda j: (-scores[j], j))[:6]
        assert [scores[j // 3] for j in found.get(i, [])] == pytest.approx(
            [scores[j] for j in order], abs=1e-6), i
        assert not {(i, j) for j in found.get(i, [])} & seen
