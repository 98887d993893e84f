import hashlib

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import split


def rows(spark, n=5000):
    return spark.range(n).select(
        (F.col("id") % 71).cast("string").alias("user_id"),
        F.col("id").cast("string").alias("product_id"), F.lit(3.0).alias("rating"),
    )


def test_bounds():
    assert split.hash_bound(0.8) == "33333333"
    assert split.hash_bound(1 / 32) == "f8000000"
    for share in (0, 1, -1):
        with pytest.raises(ValueError):
            split.hash_bound(share)


def test_hashed_halves_do_not_depend_on_the_layout(spark):
    train, test = split.hashed_halves(rows(spark))
    again, _ = split.hashed_halves(rows(spark).repartition(5))
    assert train.count() + test.count() == 5000
    assert train.exceptAll(again).isEmpty() and again.exceptAll(train).isEmpty()
    assert 0.17 < test.count() / 5000 < 0.23
    for r in test.limit(20).collect():
        digest = hashlib.md5(f"{r.user_id}|{r.product_id}".encode()).hexdigest()
        assert digest[:8] < "33333333"


def test_random_halves_cover_the_input_once(spark):
    df = rows(spark)
    train, test = split.random_halves(df)
    both = train.unionAll(test)
    assert both.exceptAll(df).isEmpty() and df.exceptAll(both).isEmpty()
    assert 0.75 < train.count() / 5000 < 0.85
    assert split.random_halves(df)[0].exceptAll(train).isEmpty()
