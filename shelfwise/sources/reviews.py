"""Readers for raw reviews and cleaned ratings. Paths may be any URI Spark can read."""

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from shelfwise.schemas import NA_TOKENS, RATINGS
from shelfwise.sources.csv_records import (
    CORRUPT, QUOTE, read_csv, with_corrupt, without_malformed,
)


def blank_to_null(df: DataFrame, na_tokens=NA_TOKENS) -> DataFrame:
    """Turn the missing-value texts of every string column into NULL."""
    texts = [name for name, kind in df.dtypes if kind == "string"]
    return df.withColumns(
        {c: F.when(~F.col(c).isin(*na_tokens), F.col(c)) for c in texts}
    )


def read_raw_reviews(
    spark: SparkSession, path: str, *, na_tokens=NA_TOKENS, multi_line: bool = True,
    whole_files: bool = False, on_malformed: str = "fail", dropped: Observation | None = None,
) -> DataFrame:
    """Raw review CSV with a header; every column is text, so ids keep leading zeros.

    Large files are read in parts, also where quoted texts hold line breaks
    (:mod:`shelfwise.sources.csv_records`), which takes a second pass over the lines; without
    such breaks ``multi_line=False`` saves it. Files with stray quotes in texts that are not
    quoted need ``whole_files``, which makes a file the unit of parallelism.

    Records with too few or too many fields fail the read, unless ``on_malformed`` is
    ``"drop"``; an ``Observation`` in ``dropped`` then counts them as ``malformed_rows`` in the
    pass that reads them (a stage that runs again for a lost executor may count some twice).
    All columns are parsed, since otherwise such records go unnoticed.
    """
    header = spark.read.csv(path, header=True, escape=QUOTE, multiLine=multi_line)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in header.columns])
    if multi_line and not whole_files:
        raw = read_csv(spark, path, schema, on_malformed, dropped)
    else:
        drop = on_malformed == "drop"
        raw = (
            spark.read.schema(with_corrupt(schema) if drop else schema)
            .option("columnPruning", False)
            .csv(path, header=True, enforceSchema=False, escape=QUOTE, multiLine=multi_line,
                 mode="PERMISSIVE" if drop else "FAILFAST", columnNameOfCorruptRecord=CORRUPT)
        )
        raw = without_malformed(raw, dropped) if drop else raw
    return blank_to_null(raw, na_tokens)


def read_ratings_csv(
    spark: SparkSession, path: str, *, multi_line: bool = True, whole_files: bool = False,
) -> DataFrame:
    """Cleaned rating CSV as written by :func:`shelfwise.sources.sinks.write_csv`; line breaks in
    ids as in :func:`read_raw_reviews`."""
    if multi_line and not whole_files:
        return read_csv(spark, path, RATINGS)
    return spark.read.schema(RATINGS).csv(
        path, header=True, enforceSchema=False, escape=QUOTE, mode="FAILFAST",
        multiLine=multi_line)


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned rating table in Parquet."""
    return spark.read.schema(RATINGS).parquet(path)
