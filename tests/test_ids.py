"""Indexing, encoding, decoding and the lookup they share."""

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from shelfwise.operators import encode, lookup
from shelfwise.session import materialize


def ratings(spark, rows):
    return spark.createDataFrame(rows, "user_id string, product_id string, rating double")


def test_frequency_then_text_and_no_null(spark):
    df = ratings(spark, [(u, "p", 1.0) for u in ["b", "a", "c", "c", None]])
    index = {r.user_id: r.user_id_int for r in encode.index_by_frequency(df, "user_id").collect()}
    assert index == {"c": 0, "a": 1, "b": 2}


def test_unseen_and_null_get_the_number_of_ids(spark):
    users = encode.index_by_frequency(ratings(spark, [(u, "p", 1.0) for u in "bacc"]), "user_id")
    df = ratings(spark, [("c", "p", 1.0), ("zz", "p", 1.0), (None, "p", 1.0)])
    out = {r.user_id: r.user_id_int for r in encode.encode_column(df, users, "user_id").collect()}
    assert out == {"c": 0, "zz": 3, None: 3}


def test_existing_output_column_is_replaced(spark):
    df = ratings(spark, [("a", "p", 1.0)]).withColumn("user_id_int", F.lit(99))
    users = encode.index_by_frequency(df, "user_id")
    assert encode.encode_column(df, users, "user_id").first().user_id_int == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("abcdé中 '\",", min_size=1, max_size=3), min_size=1, max_size=60))
def test_same_numbers_as_the_indexer(spark, ids):
    df = ratings(spark, [(u, "p", 1.0) for u in ids])
    indexed = StringIndexer(inputCol="user_id", outputCol="i", handleInvalid="keep").fit(df)
    theirs = {r.user_id: int(r.i) for r in indexed.transform(df).collect()}
    ours = {r.user_id: r.user_id_int for r in encode.index_by_frequency(df, "user_id").collect()}
    assert ours == theirs


def test_positions_over_many_partitions(spark):
    df = spark.range(50_000).select(F.xxhash64("id").alias("x"), "id").repartition(13)
    rows = encode.with_positions(df, "position", F.desc("x"), "id").orderBy("position").collect()
    assert [r.position for r in rows] == list(range(50_000))
    assert [r.x for r in rows] == sorted((r.x for r in rows), reverse=True)


def skewed(spark, rows=30_000):
    """A third of the rows has one user, another tenth none; products are skewed alike."""
    i = F.col("id")
    return materialize(spark.range(rows).select(
        F.when(i % 3 == 0, "hot").when(i % 10 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("u"), (i % 997).cast("string"))).alias("user_id"),
        F.when(i % 3 == 1, "best").otherwise(F.concat(F.lit("p"), i.cast("string")))
        .alias("product_id"),
        (i / rows).alias("rating"),
    ), "skewed")


LIMITS = {"slots": 50, "rows": 100}


def test_hot_keys_are_few_and_spread(spark):
    df = skewed(spark)
    counts = lookup.key_counts(df, "user_id")
    hot = lookup.hot_keys(counts, "user_id", 30_000, **LIMITS)
    assert hot.dtypes == [("_hot", "bigint"), ("_parts", "int")]
    parts = {r._hot: r._parts for r in hot.collect()}
    names = spark.createDataFrame([("hot",), (None,)], "user_id string")
    of_hot, of_null = [r[0] for r in names.select(F.xxhash64("user_id")).collect()]
    assert parts[of_hot] == 17 and of_null in parts and len(parts) < 50
    assert lookup.hot_keys(counts, "user_id", 30_000) is None


def test_spread_lookup_equals_plain_join_and_balances(spark):
    df = skewed(spark)
    users = materialize(encode.index_by_frequency(df, "user_id"), "users")
    plain = df.join(users.select("user_id", "user_id_int"), "user_id", "left")
    spread = lookup.balanced_lookup(
        df, users.select("user_id", "user_id_int"), "user_id", ["product_id", "rating"], **LIMITS
    )
    columns = ["user_id", "product_id", "rating", "user_id_int"]
    assert spread.select(columns).exceptAll(plain.select(columns)).isEmpty()
    assert plain.select(columns).exceptAll(spread.select(columns)).isEmpty()
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        sizes = [
            r["count"] for r in lookup.balanced_lookup(
                df, users.select("user_id", "user_id_int"), "user_id",
                ["product_id", "rating"], **LIMITS
            ).groupBy(F.spark_partition_id()).count().collect()
        ]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 30_000
    assert max(sizes) < 2 * 30_000 / 8


@pytest.mark.parametrize("fitted", [True, False])
def test_encode_and_decode_skewed_ids(spark, fitted):
    df = skewed(spark).dropna()
    users = materialize(encode.index_by_frequency(df, "user_id"), "users")
    products = materialize(encode.index_by_frequency(df, "product_id"), "products")
    df = materialize(df, "rows")
    encoded = materialize(
        encode.encode(df, users, products, fitted_on_df=fitted, **LIMITS), "encoded"
    )
    assert encoded.count() == df.count()
    bare = encoded.drop("user_id", "product_id")
    named = encode.decode_column(bare, users, "user_id", ["rating"], **LIMITS)
    named = materialize(named, "named")
    back = encode.decode_column(named, products, "product_id", ["rating"], **LIMITS)
    back = back.select("user_id", "product_id", "rating")
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()


def test_decoding_an_unknown_index_gives_null(spark):
    users = encode.index_by_frequency(ratings(spark, [("a", "p", 1.0)]), "user_id")
    df = spark.createDataFrame([(0, 1.0), (7, 2.0)], "user_id_int int, rating double")
    out = {r.rating: r.user_id for r in encode.decode_column(df, users, "user_id", ["rating"]).collect()}
    assert out == {1.0: "a", 2.0: None}
