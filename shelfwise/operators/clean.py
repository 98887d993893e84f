"""From raw reviews to the rating table."""

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.schemas import RATING_KEY, RATING_MAX, RATING_MIN, RAW_NAMES


def rename_raw(df: DataFrame) -> DataFrame:
    """Original column names become ours; a table that has ours already is left alone."""
    return df.withColumnsRenamed(RAW_NAMES) if "reviewerID" in df.columns else df


def keep_rating_columns(df: DataFrame) -> DataFrame:
    """The three columns in use; an absent one is an error."""
    return rename_raw(df).select(*RATING_KEY)


# Texts Java reads as numbers and Python does not: a type suffix, and hexadecimal.
JAVA_NUMBER = r"(\d\.?[dDfF]|^\s*[+-]?0[xX].*)\s*$"


def _number(text: Column, on_bad_rating: str) -> Column:
    """A text as a double, with or without the ANSI mode of the session."""
    number = F.when(~text.rlike(JAVA_NUMBER), text.try_cast("double"))
    if on_bad_rating == "drop":
        return number
    failure = F.raise_error(F.concat(text, F.lit(" is no number")))
    return F.when(text.isNull() | number.isNotNull(), number).otherwise(failure)


def typed(df: DataFrame, on_bad_rating: str = "fail") -> DataFrame:
    """Text ids and a double rating. A rating that is no number fails the run, or is dropped."""
    if on_bad_rating not in ("fail", "drop"):
        raise ValueError("on_bad_rating is 'fail' or 'drop'")
    rating = F.col("rating")
    is_text = dict(df.dtypes)["rating"] == "string"
    return df.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("product_id").cast("string").alias("product_id"),
        (_number(rating, on_bad_rating) if is_text else rating.cast("double")).alias("rating"),
    )


def _is_complete(df: DataFrame) -> Column:
    """No NULL and no NaN in any column. Unlike ``dropna``, its parts reach a Parquet scan."""
    complete = F.lit(True)
    for name, kind in df.dtypes:
        complete &= F.col(name).isNotNull()
        if kind in ("double", "float"):
            complete &= ~F.isnan(name)
    return complete


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows with a NULL or NaN in any column."""
    return df.filter(_is_complete(df))


def drop_copies(df: DataFrame) -> DataFrame:
    """Keep one of equal rows. Copies meet in the map-side hash table, so a group of copies
    that holds a large share of the rows sends one row a task through the shuffle."""
    return df.dropDuplicates()


def valid_ratings(df: DataFrame) -> DataFrame:
    return df.filter(F.col("rating").between(RATING_MIN, RATING_MAX))


def clean_reviews(raw: DataFrame, on_bad_rating: str = "fail") -> DataFrame:
    """Rename, project, drop incomplete rows, type, keep the valid range, drop copies.

    Rows are dropped before the cast, so a bad rating beside a missing id is no error. The
    range filter commutes with the copy rule and goes first, to shrink the shuffle.
    """
    complete = drop_incomplete(keep_rating_columns(raw))
    return drop_copies(valid_ratings(drop_incomplete(typed(complete, on_bad_rating))))


def count_copies(raw: DataFrame, on_bad_rating: str = "fail") -> DataFrame:
    """Distinct triples with their number of ``copies``, from one scan and one shuffle.

    All incomplete rows become one group of NULLs, so they leave each task as a single row.
    """
    named = keep_rating_columns(raw)
    complete = _is_complete(named)
    blanked = named.select(*[F.when(complete, F.col(c)).alias(c) for c in RATING_KEY])
    rows = typed(blanked, on_bad_rating)
    present = _is_complete(rows)
    return rows.select(
        *[F.when(present, F.col(c)).alias(c) for c in RATING_KEY]
    ).groupBy(*RATING_KEY).agg(F.count("*").alias("copies"))


def ratings_of(groups: DataFrame) -> DataFrame:
    """The cleaned ratings, from counted copies."""
    return valid_ratings(groups.select(*RATING_KEY))


def audit_of(groups: DataFrame) -> DataFrame:
    """One row of counts: raw, after each rule, and the figure a run reports as removed.

    ``removed_rows`` counts incomplete rows and copies, not the range rule.
    """
    complete = F.col("rating").isNotNull()
    valid = complete & F.col("rating").between(RATING_MIN, RATING_MAX)
    zero = F.lit(0).cast("long")
    return groups.agg(
        F.coalesce(F.sum("copies"), zero).alias("raw_rows"),
        F.coalesce(F.sum(F.when(complete, F.col("copies"))), zero).alias("complete_rows"),
        F.count_if(complete).alias("distinct_rows"),
        F.count_if(valid).alias("final_rows"),
    ).withColumn("removed_rows", F.col("raw_rows") - F.col("distinct_rows"))


def cleaning_audit(raw: DataFrame, on_bad_rating: str = "fail") -> DataFrame:
    return audit_of(count_copies(raw, on_bad_rating))
