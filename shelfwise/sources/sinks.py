"""Writers. Every one writes from the executors; nothing passes through the driver."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.functions.recommendations import export_items, printed_items
from shelfwise.schemas import EXPORT, EXPORT_ITEMS, RECOMMENDATIONS


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV that keeps blanks at the ends of a text, which may tell ids apart."""
    df.write.mode("overwrite").csv(
        path, header=True, escape='"', ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def preview(df: DataFrame, *order: str, rows: int = 5) -> DataFrame:
    """The first rows in a given order, found by a bounded top-n in each task."""
    return df.orderBy(*order).limit(rows)


def column_types(df: DataFrame) -> list[tuple[str, str]]:
    return df.dtypes


def export_table(recs: DataFrame) -> DataFrame:
    """Recommendation lists with the field names and types of the exports."""
    return recs.select("user_id_int", export_items("recommendations").alias("recommendations"))


def write_recs_json(recs: DataFrame, path: str) -> None:
    """One JSON record a user."""
    export_table(recs).write.mode("overwrite").json(path)


def write_recs_csv(recs: DataFrame, path: str) -> None:
    """One CSV row a user, the list as JSON text in the second column."""
    write_csv(
        export_table(recs).select(
            "user_id_int", F.to_json("recommendations").alias("recommendations_str")
        ),
        path,
    )


def answer_documents(answers: DataFrame) -> DataFrame:
    """One JSON text a request, in the form a caller of the service gets: a list and its time,
    or an empty list and a message. Fields without a value are left out."""
    body = F.struct("user_id", "recommendations", "timestamp", "message")
    return answers.select("request_id", F.to_json(body).alias("document"))


def read_recs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RECOMMENDATIONS).parquet(path)


def read_recs_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EXPORT).json(path, mode="FAILFAST")


def read_recs_csv(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.schema("user_id_int int, recommendations_str string").csv(
        path, header=True, enforceSchema=False, escape='"', mode="FAILFAST"
    )
    return text.select(
        "user_id_int", F.from_json("recommendations_str", EXPORT_ITEMS).alias("recommendations")
    )


def read_printed_recs(spark: SparkSession, path: str) -> DataFrame:
    """Lists of an older export, whose CSV holds them as printed rows."""
    text = spark.read.schema("user_id_int int, recommendations string").csv(
        path, header=True, enforceSchema=False, escape='"'
    )
    return text.select("user_id_int", printed_items("recommendations").alias("recommendations"))


def write_map(id_map: DataFrame, path: str) -> None:
    """An id map as Parquet, CSV and JSON records below ``path``."""
    pairs = id_map.drop("n")
    write_parquet(id_map, f"{path}/parquet")
    write_csv(pairs, f"{path}/csv")
    pairs.write.mode("overwrite").json(f"{path}/json")
