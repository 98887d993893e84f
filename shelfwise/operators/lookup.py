"""Left lookup joins that stay balanced when one key holds a large share of the rows."""

from pyspark.sql import DataFrame, functions as F

HOT_SLOTS = 100_000
HOT_ROWS = 1_000_000


def key_counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n"))


def _hashed(key: str):
    return F.xxhash64(F.col(key).cast("string"))


def hot_keys(counts: DataFrame, key: str, total: int, *, slots=HOT_SLOTS, rows=HOT_ROWS):
    """Keys with more than ``share`` of ``total`` rows, and into how many parts to split each.

    ``share`` is at least ``total / slots``, so there are fewer than ``slots`` such keys
    whatever the data. Each is told by a hash, so that the result has twelve bytes a row and
    may be broadcast; a key that happens to have the same hash is split as well, which does no
    harm. None if no key can have that many rows.
    """
    share = max(-(-total // slots), rows)
    if total <= share:
        return None
    parts = F.ceil(F.col("n") / share).cast("int")
    return (
        counts.filter(F.col("n") > share).groupBy(_hashed(key).alias("_hot"))
        .agg(F.max(parts).alias("_parts"))
    )


def spread_lookup(left: DataFrame, right: DataFrame, key: str, hot, spread_on) -> DataFrame:
    """``left`` left-joined to ``right``, which has each key at most once.

    Rows of a hot key go to one of its parts by a hash of ``spread_on`` (columns that tell
    its rows apart, and that a re-run task computes alike); the matching right row is
    repeated once a part, fewer than ``2 * slots`` copies in all. NULL keys are spread too.
    Without hot keys this is a plain join, and Spark picks the strategy by the sizes.
    """
    if hot is None:
        return left.join(right, key, "left")
    parts = F.coalesce(F.col("_parts"), F.lit(1))

    def with_parts(df):
        return df.join(F.broadcast(hot), _hashed(key) == F.col("_hot"), "left")

    spread = (
        with_parts(left)
        .withColumn("_part", F.pmod(F.xxhash64(*spread_on), parts).cast("int"))
        .drop("_hot", "_parts")
    )
    repeated = (
        with_parts(right)
        .withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
        .drop("_hot", "_parts")
    )
    return spread.join(repeated, [key, "_part"], "left").drop("_part")


def balanced_lookup(left: DataFrame, right: DataFrame, key: str, spread_on, **limits):
    """:func:`spread_lookup` with the hot keys counted on ``left``, which should be a written
    table: it is read once to count rows, once to count keys and once to join."""
    hot = hot_keys(key_counts(left, key), key, left.count(), **limits)
    return spread_lookup(left, right, key, hot, spread_on)
