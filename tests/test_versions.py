"""Leases, exports that appear together, answers decoded by their version, unseen products."""

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from shelfwise.operators import topk
from shelfwise.plans import decoded, exports, publish, registry
from shelfwise.schemas import STORED_ANSWERS


def publish_one(spark, root):
    maps = [registry.id_map(spark, SMALL, name) for name in ("user_id", "product_id")]
    return publish.publish(spark, root, registry.model(spark, SMALL, 0.8), *maps)


def test_a_version_that_is_held_is_not_retired(spark, tmp_path):
    root = str(tmp_path / "models")
    publish_one(spark, root)
    with publish.held(spark, root) as first:
        publish_one(spark, root)
        publish_one(spark, root)
        assert publish.kept_versions(spark, root) == [1, 2, 3]
        assert first.version == 1 and first.model.itemFactors.count() > 0
    publish_one(spark, root)
    assert publish.kept_versions(spark, root) == [3, 4]
    publish.lease(spark, root, 3, -1)  # one that has ended
    assert not publish.is_held(spark, root, 3)
    assert publish.read_maps(spark, root, 1)[0].count() > 0  # maps stay


def test_a_model_that_answers_is_held(spark, tmp_path):
    root = str(tmp_path / "models")
    publish_one(spark, root)
    current = publish.CurrentModel(spark, root)
    current.now()
    publish_one(spark, root)
    publish_one(spark, root)
    assert publish.kept_versions(spark, root) == [1, 2, 3]
    assert current.now()[0] == 3


def test_a_failed_writer_leaves_the_run_before(spark, tmp_path):
    root = str(tmp_path / "out")

    def writer(n):
        def write(path):
            spark.range(n).write.parquet(path)
            return n

        return write

    def fails(path):
        spark.range(3).write.parquet(path)
        raise RuntimeError("on purpose")

    with pytest.raises(FileNotFoundError):
        exports.exported(spark, root)
    assert exports.export(spark, root, {"a": writer(5), "b": writer(6), "c": writer(7)}) == 1
    with pytest.raises(RuntimeError, match="on purpose"):
        exports.export(spark, root, {"a": writer(50), "b": writer(60), "c": fails})
    last = exports.exported(spark, root)
    assert last.rows == {"a": 5, "b": 6, "c": 7}
    for name, rows in last.rows.items():
        assert spark.read.parquet(f"{last.path}/{name}").count() == rows
    assert exports.export(spark, root, {"a": writer(1)}) == 3
    assert exports.runs(spark, root) == [1, 3]
    names = sorted(p.name.split("-")[0] for p in (tmp_path / "out").iterdir() if "run=" in p.name)
    assert names == ["run=1", "run=3"]  # what the failed run left is gone


def test_answers_older_than_all_versions_are_not_decoded(spark, tmp_path):
    root = str(tmp_path / "models")
    publish_one(spark, root)
    rows = spark.createDataFrame([
        (3, [(1, 0.5), (10**6, 0.25)], "2999-01-01T00:00:00.000000"),
        (3, [(1, 0.5)], "1999-01-01T00:00:00.000000"), (4, [], "2999-01-01T00:00:00.000000"),
    ], STORED_ANSWERS).withColumn("id", F.monotonically_increasing_id())
    found = {(r.user_id, r.version): r.recommendations for r in decoded.decoded_answers(
        spark, root, rows, "id").collect()}
    user = {r.user_id_int: r.user_id for r in registry.id_map(spark, SMALL, "user_id").collect()}
    product = {r.product_id_int: r.product_id
               for r in registry.id_map(spark, SMALL, "product_id").collect()}
    assert {key: value and [x.product_id for x in value] for key, value in found.items()} == {
        (user[3], 1): [product[1], None], (None, None): [None], (user[4], 1): None}


def test_unseen_products_equal_brute_force(spark):
    model = registry.model(spark, SMALL, 0.8)
    train, _ = registry.halves(spark, SMALL)
    found = {}
    for r in topk.recommend_unseen(model, train, 7).orderBy("rank").collect():
        found.setdefault(r.user_id_int, []).append(round(r.score, 4))
    items = [(r.id, np.array(r.features, np.float32)) for r in model.itemFactors.collect()]
    seen = {}
    for r in train.collect():
        seen.setdefault(r.user_id_int, set()).add(r.product_id_int)
    for r in model.userFactors.collect():
        scores = sorted((float(np.array(r.features, np.float32) @ v) for i, v in items
                         if i not in seen.get(r.id, ())), reverse=True)[:7]
        assert found[r.id] == pytest.approx(scores, abs=2e-4)
