"""Connected components of a distributed list of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.session import materialize


def components(links: DataFrame, first: str, second: str) -> DataFrame:
    """``id`` and ``component`` (the smallest id reachable) of every id that has a link.

    Links are turned into stars around ever smaller ids: every id hands the ids above it to the
    smallest one it knows, first all ids above it, then all below it, until nothing changes. The
    smallest neighbour is an aggregate that tasks make beforehand, and links reach it by a join
    that adaptive execution splits, so an id with very many links needs no group of its own. Each
    round is written to the shared folder.
    """
    pairs = links.select(
        F.greatest(first, second).alias("u"), F.least(first, second).alias("v")).where("u <> v")
    pairs = materialize(pairs.distinct(), "links")
    state = _state(pairs)
    while True:
        pairs = materialize(_small_star(_large_star(pairs)), "stars")
        state, before = _state(pairs), state
        if state == before:
            break
    stars = pairs.select(F.col("u").alias("id"), F.col("v").alias("component"))
    centres = stars.select(F.col("component").alias("id"), "component").distinct()
    return stars.unionByName(centres)


def _state(pairs):
    row = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(pairs):
    """Hand each neighbour above an id to the smallest of its neighbourhood."""
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(
        F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(pairs):
    """Hand each id, and its neighbours below it, to the smallest of those."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    below = pairs.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return below.unionByName(own).where("u <> v").distinct()
