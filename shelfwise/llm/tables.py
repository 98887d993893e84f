"""Reading of the given tables, and the text rules several operators share."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\f\r"
WORD_GAP = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words(text):
    """The words of a text, split at blanks; none if it is null or has none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, WORD_GAP))


def line_key(line):
    """A line without blanks at its ends and with A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, UPPER.lower())


def fingerprint(text):
    """128 bits that tell texts apart; null and empty texts count as equal."""
    text = F.coalesce(text, F.lit(""))
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))
