"""Input tables of the registered queries, derived from the given tables by Spark."""

from pyspark.sql import DataFrame, SparkSession, functions as F


# Keys of large tables are folded into the range of the integer ids.
INTS = 2**31 - 1


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Raw reviews in the original layout: one a line item, with NULL ids and ratings, ratings
    beyond the valid range, repeated triples and a column nobody needs."""
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.when(
            F.col("l_partkey") % 101 != 0,
            F.concat(F.lit("U"), F.col("o_custkey").cast("string")),
        ).alias("reviewerID"),
        F.concat(F.lit("P"), F.lpad(F.col("l_partkey").cast("string"), 9, "0")).alias("asin"),
        F.when(F.col("l_suppkey") % 53 != 0, F.col("l_quantity") / 8).alias("overall"),
        F.col("l_returnflag").alias("reviewText"),
    )


def raw_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The reviews as CSV lines under a header, their text quoted and with quotes and commas in
    it. Of 97 products one has records that lack the last fields, one has a field too many and
    one has lines that are no record at all."""
    names = ["reviewerID", "asin", "overall"]
    fields = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in names]
    text = F.concat(F.lit('"so, ""'), "reviewText", F.lit('"""'))
    kind = F.substring("asin", 2, 9).cast("bigint") % 97
    line = (
        F.when(kind == 1, F.concat_ws(",", *fields[:2]))
        .when(kind == 2, F.concat_ws(",", *fields, text, F.lit("more")))
        .when(kind == 3, F.lit("oops")).otherwise(F.concat_ws(",", *fields, text))
    )
    return reviews(spark, folder).select(line.alias(",".join([*names, "reviewText"])))


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """One request an event. Ids are stretched, so that about half are unknown to the model;
    ``n`` runs from 0, which is no valid length, to 6."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("request_id"),
        (F.col("user_id") * 20).alias("user_id"),
        (F.col("event_id") % 7).cast("int").alias("n"),
    )


def stored_answers(spark: SparkSession, folder: str) -> DataFrame:
    """One stored answer an order, several a user, some at the same time. Ids are stretched
    by three, so that requested users are found, or not, whether or not the model knows them."""
    return table(spark, folder, "orders").select(
        (F.col("o_custkey") * 3).alias("user_id"),
        F.array(F.struct(
            (F.col("o_orderkey") % INTS).cast("int").alias("product_id"),
            F.col("o_totalprice").alias("score"),
        )).alias("recommendations"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
    )


def printed_lists(spark: SparkSession, folder: str) -> DataFrame:
    """One printed list an event: twelve entries, their ratings with a sign, an exponent or
    neither in turn."""
    whole = F.col("value").cast("int").cast("string")

    def entry(i):
        number = F.when(i % 3 == 0, F.concat(F.lit("-"), whole, F.lit(".5")))
        number = number.when(i % 3 == 1, F.concat(whole, F.lit(".25e-05")))
        number = number.otherwise(F.concat(whole, F.lit(".75")))
        product = ((F.col("user_id") * 100 + i) % INTS).cast("string")
        return F.concat(
            F.lit("Row(product_id_int="), product, F.lit(", rating="), number, F.lit(")")
        )

    entries = F.transform(F.sequence(F.lit(0), F.lit(11)), entry)
    return table(spark, folder, "events").select(
        (F.col("event_id") % INTS).cast("int").alias("user_id_int"),
        F.concat(F.lit("["), F.array_join(entries, ", "), F.lit("]")).alias("recommendations"),
    )
