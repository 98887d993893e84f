"""Stored answers in the text ids of the version that made them.

The same integer may stand for another product in another version, so an answer is decoded by
the maps of its own version: the one it names, else the one that was current when it was given.
Maps stay when a version is retired.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfwise.functions.recommendations import iso_timestamp
from shelfwise.operators.lookup import balanced_lookup
from shelfwise.plans.publish import read_maps, versions
from shelfwise.session import materialize


def version_at(spark: SparkSession, root: str, timestamp: Column) -> Column:
    """The version that was current at an ISO time; null before the first one. There is one
    small row a version, and they become one array."""
    rows = versions(spark, root).select(
        iso_timestamp("published_at").alias("at"), "version").orderBy("at", "version").collect()
    if not rows:
        return F.lit(None).cast("int")
    known = F.array(*(F.struct(F.lit(row["at"]).alias("at"), F.lit(row.version).alias("version"))
                      for row in rows))
    return F.try_element_at(F.filter(known, lambda v: v["at"] <= timestamp), F.lit(-1))["version"]


def _maps(spark: SparkSession, root: str, numbers: list[int], which: int, column: str):
    """The maps of several versions, a row a version and index."""
    maps = [
        read_maps(spark, root, number)[which].select(
            F.struct(F.lit(number).alias("version"), F.col(f"{column}_int").alias("index")).alias(
                "key"), column)
        for number in numbers
    ]
    return reduce(DataFrame.unionByName, maps)


def decoded_answers(spark: SparkSession, root: str, answers: DataFrame, id: str, **limits):
    """``id`` (which tells answers apart), ``version``, ``user_id`` as text and
    ``recommendations`` with text ids, in their order. Ids that the version's maps lack, or answers
    older than all versions, are null."""
    if "version" not in answers.columns:
        answers = answers.withColumn("version", F.lit(None).cast("int"))
    own = F.coalesce("version", version_at(spark, root, F.col("timestamp")))
    rows = materialize(answers.select(
        id, own.alias("version"), F.col("user_id").cast("long").alias("user"), "recommendations"),
        "answers")
    numbers = [row.version for row in rows.select("version").distinct().collect()
               if row.version is not None]  # a row a version
    if not numbers:
        numbers = [row.version for row in versions(spark, root).limit(1).collect()]

    def key(index):
        return F.struct("version", F.col(index).cast("int").alias("index")).alias("key")

    entries = materialize(rows.select(
        id, "version", F.posexplode("recommendations").alias("at", "item")).select(
        id, "at", key("item.product_id"), F.col("item.score").alias("score")), "entries")
    products = _maps(spark, root, numbers, 1, "product_id")
    items = F.array_sort(F.collect_list(F.struct("at", "product_id", "score")))
    lists = balanced_lookup(entries, products, "key", [id, "at"], **limits).groupBy(id).agg(
        F.transform(items, lambda x: F.struct(x["product_id"], x["score"])).alias(
            "recommendations"))
    askers = materialize(rows.select(id, "version", key("user")), "askers")
    users = balanced_lookup(
        askers, _maps(spark, root, numbers, 0, "user_id"), "key", [id], **limits)
    return users.join(lists, id, "left").select(id, "version", "user_id", "recommendations")
