"""Answer requests as their files arrive."""

from collections.abc import Callable
from uuid import uuid4

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.operators.serve import serve
from shelfwise.plans.publish import CurrentModel
from shelfwise.schemas import REQUESTS
from shelfwise.session import job_folder, scratch_path, sized_shuffles


def request_stream(
    spark: SparkSession, path: str, files_per_batch: int = 1000, repeats_within: str | None = None,
) -> DataFrame:
    """Requests as their files arrive. With ``repeats_within`` (say ``"1 hour"``) a request id that
    arrives again within that time of its first file is not answered again: the ids seen are kept
    in the stream's state until the watermark has passed them."""
    files = spark.readStream.schema(REQUESTS).option("maxFilesPerTrigger", files_per_batch)
    requests = files.parquet(path)
    if repeats_within is None:
        return requests
    arrived = requests.select("*", F.col("_metadata.file_modification_time").alias("arrived"))
    return arrived.withWatermark("arrived", repeats_within).dropDuplicatesWithinWatermark(
        ["request_id"]).drop("arrived")


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream with this checkpoint; made when it starts for the first time."""
    path = f"{checkpoint}/serving"
    spark.createDataFrame([(uuid4().hex,)], "id string").write.mode("ignore").parquet(path)
    return spark.read.parquet(path).first().id


def serve_stream(
    requests: DataFrame, model: ALSModel | CurrentModel, answers_path: str, log_path: str,
    checkpoint: str, stored: Callable[[], DataFrame | None] | None = None, trigger=None,
):
    """Start answering; the default trigger takes all files present and stops.

    A batch that is repeated after a failure has the same name and replaces its own
    folders, so every request has one answer and the log one entry for it. The name has the
    stream's own id, which is kept with its checkpoint, so streams and batch jobs may share
    folders. A ``CurrentModel``
    is asked before each batch, so a version that is published while the stream runs answers
    from the next batch on; its answers carry its number. Shuffles are sized by the batch.
    """

    spark = requests.sparkSession
    name = stream_id(spark, checkpoint)
    fixed = None if isinstance(model, CurrentModel) else (None, model)

    def answer_batch(batch: DataFrame, number: int) -> None:
        # The session of a micro-batch has adaptive execution off, so go on from a file.
        version, fitted = fixed or model.now()
        with job_folder(spark):
            path = scratch_path(spark, "requests")
            batch.write.parquet(path)
            table = spark.read.schema(REQUESTS).parquet(path)
            with sized_shuffles(spark, path):
                serve(
                    table, fitted, answers_path, log_path, f"stream-{name}-{number}", stored,
                    version=version,
                )

    return (
        requests.writeStream.foreachBatch(answer_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_answers(spark: SparkSession, answers_path: str) -> DataFrame:
    return spark.read.parquet(answers_path).drop("batch")
