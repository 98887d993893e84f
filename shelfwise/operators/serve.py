"""Answers to requests: the model's list, else an earlier stored answer, else an empty one."""

from collections.abc import Callable

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfwise.functions.recommendations import answer_items, iso_timestamp
from shelfwise.operators.first_answers import CONTENT, FirstAnswers, earliest
from shelfwise.operators.lookup import hot_keys, spread_lookup
from shelfwise.operators.topk import recommend_for
from shelfwise.schemas import DEFAULT_N, EMPTY_MESSAGE, REQUESTS
from shelfwise.session import job_folder, materialize, path_exists

INT_MAX = 2**31 - 1

# A broadcast of that many user ids takes a few megabytes.
BROADCAST_USERS = 500_000


def first_stored(stored: DataFrame | FirstAnswers, users: DataFrame | None = None, n_users: int = 0):
    """The earliest stored answer of each user, equal times by content.

    A bounded number of wanted ``users`` is broadcast, so that the store is only scanned for
    them. With more, the store is aggregated in each task first, which also takes care of
    users with very many answers, and the caller's join picks the wanted ones. A table of
    first answers is only asked for those users.
    """
    if isinstance(stored, FirstAnswers):
        return stored.of(users, n_users)
    if users is not None and n_users <= BROADCAST_USERS:
        stored = stored.join(F.broadcast(users.select("user_id")), "user_id", "left_semi")
    return earliest(stored)


def _askers(requests: DataFrame) -> DataFrame:
    """Each requested user once: number of requests, the longest list asked for, if any, and
    whether a request asks for no list: an id the model cannot hold, or ``n`` below 1."""
    listable = (F.col("n") > 0) & F.col("user_id").between(0, INT_MAX)
    return requests.groupBy("user_id").agg(
        F.count("*").alias("n"), F.max(F.when(listable, F.col("n"))).alias("k"),
        F.coalesce(F.bool_or(~listable), F.lit(True)).alias("unlisted"),
    )


def _with_stored(known: DataFrame, stored: DataFrame | FirstAnswers | None) -> DataFrame:
    """Add the stored answer of the users who need one; the store is left alone if none does."""
    needy = known.filter(F.col("unlisted") | F.col("recommendations").isNull())
    n_needy = needy.count() if stored is not None else 0
    if n_needy:
        return known.join(first_stored(stored, needy, n_needy), "user_id", "left")
    return known.withColumn("stored", F.lit(None).cast(CONTENT))


def one_request(spark: SparkSession, user_id: int, n: int = DEFAULT_N) -> DataFrame:
    """A single request as a table."""
    return spark.createDataFrame([(0, user_id, n)], REQUESTS)


def with_default_n(requests: DataFrame) -> DataFrame:
    return requests.withColumn("n", F.coalesce("n", F.lit(DEFAULT_N)))


def answer(
    requests: DataFrame, model: ALSModel, stored: DataFrame | FirstAnswers | None = None,
    served_at: Column | None = None, **limits,
) -> DataFrame:
    """One row a request: ``(request_id, user_id, n, recommendations, timestamp, message,
    source)`` with ``source`` one of ``model``, ``stored`` and ``none``.

    Each user is scored once, for the longest list any of their requests asks for. Both kinds
    of answer are put beside the user first, so the requests are shuffled once, with the
    requests of very frequent users spread over several tasks. The store is read only for
    users the model does not know or who have a request it cannot answer.
    """
    requests = with_default_n(requests)
    askers = materialize(_askers(requests), "askers")
    total = askers.agg(F.sum("n")).first()[0] or 0
    wanted = askers.filter(F.col("k").isNotNull()).select("user_id", "k")
    lists = recommend_for(model, wanted)
    known = materialize(
        askers.select("user_id", "unlisted").join(
            lists.withColumnRenamed("user_id_int", "user_id"), "user_id", "left"
        ),
        "known",
    )
    known = _with_stored(known, stored).drop("unlisted")
    found = spread_lookup(
        requests, known, "user_id", hot_keys(askers, "user_id", total, **limits), ["request_id"]
    )
    ranked = F.when(
        F.col("n") > 0, answer_items(F.slice("recommendations", 1, F.greatest("n", F.lit(1))))
    )
    by_model = F.coalesce(F.size(ranked), F.lit(0)) > 0
    by_store = F.col("stored").isNotNull()
    now = iso_timestamp(F.current_timestamp() if served_at is None else served_at)
    return found.select(
        "request_id", "user_id", "n",
        F.when(by_model, ranked).when(by_store, F.col("stored.recommendations"))
        .otherwise(F.array().cast("array<struct<product_id:int,score:double>>"))
        .alias("recommendations"),
        F.when(by_model, now).when(by_store, F.col("stored.timestamp")).alias("timestamp"),
        F.when(~by_model & ~by_store, F.lit(EMPTY_MESSAGE)).alias("message"),
        F.when(by_model, "model").when(by_store, "stored").otherwise("none").alias("source"),
    )


def log_answers(answers: DataFrame, log_path: str, batch: str) -> None:
    """Add the model's answers to the log, and the first ones of their users to the table
    beside it. A batch owns its folders, so that a repeated one replaces what it wrote before
    in place of adding it again."""
    spark = answers.sparkSession
    logged = answers.filter(F.col("source") == "model").select(
        "user_id", "recommendations", "timestamp",
        (F.col("version") if "version" in answers.columns else F.lit(None)).cast("int").alias(
            "version"),
        F.to_date(F.substring("timestamp", 1, 10)).alias("served_date"),
    )
    first = first_answers(spark, log_path, batch)
    logged.write.mode("overwrite").partitionBy("served_date").parquet(
        f"{log_path}/batch={batch}"
    )
    with job_folder(spark):
        first.add(batch, spark.read.schema(LOG).parquet(f"{log_path}/batch={batch}"))


LOG = (
    "user_id bigint, recommendations array<struct<product_id:int,score:double>>, "
    "timestamp string, version int, batch string, served_date date"
)


def read_log(spark: SparkSession, log_path: str, *, but_batch: str | None = None):
    """The stored answers, without those of the batch that is being answered; None if the
    log has not been started."""
    if not path_exists(spark, log_path):
        return None
    log = spark.read.schema(LOG).parquet(log_path)
    return log.filter(F.col("batch") != but_batch) if but_batch else log


def first_answers(spark: SparkSession, log_path: str, but_batch: str | None = None):
    """The table of first answers beside a log, made of the log if there is none yet."""
    return FirstAnswers(spark, f"{log_path}-first", but_batch).start(
        lambda: read_log(spark, log_path, but_batch=but_batch))


def serve(
    requests: DataFrame, model: ALSModel, answers_path: str, log_path: str, batch: str,
    stored: Callable[[], DataFrame | None] | None = None, version: int | None = None, **limits,
) -> DataFrame:
    """Answer a batch: write all answers, log the model's, return the written answers. With the
    ``version`` of the model, answers and log carry it."""
    spark = requests.sparkSession
    earlier = stored() if stored else first_answers(spark, log_path, batch)
    with job_folder(spark):
        answers = answer(requests, model, earlier, **limits)
        if version is not None:
            answers = answers.withColumn("version", F.lit(version))
        answers = materialize(answers, "answers", f"{answers_path}/batch={batch}")
    log_answers(answers, log_path, batch)
    return answers
