"""Train and test halves."""

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.schemas import SPLIT_SEED, TRAIN_SHARE


def random_halves(df: DataFrame, train_share=TRAIN_SHARE, seed=SPLIT_SEED):
    """Bernoulli halves. Give it a written table: the rows of a half depend on the partitions
    of its input, which are only sure to be the same for both halves if read from files."""
    return df.randomSplit([train_share, 1 - train_share], seed=seed)


def pair_hash() -> Column:
    """First eight hex digits of the key's MD5: the same in any engine and any layout."""
    key = F.concat(F.col("user_id"), F.lit("|"), F.col("product_id"))
    return F.substring(F.md5(key.cast("binary")), 1, 8)


def hash_bound(train_share: float) -> str:
    """The hash below which a key is in the test half, e.g. ``33333333`` for a share of 0.8."""
    if not 0 < train_share < 1:
        raise ValueError("train_share lies between 0 and 1")
    return format(round((1 - train_share) * 2**32), "08x")


def hashed_halves(df: DataFrame, train_share=TRAIN_SHARE):
    """Halves by key: all ratings of one pair fall in the same half, in every run."""
    in_test = pair_hash() < hash_bound(train_share)
    return df.filter(~in_test), df.filter(in_test)
