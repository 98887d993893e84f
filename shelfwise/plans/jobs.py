"""The jobs a scheduler calls, each from paths to paths."""

from uuid import uuid4

from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F

from shelfwise.operators.clean import audit_of, count_copies, ratings_of
from shelfwise.operators.encode import encode, index_columns
from shelfwise.operators.evaluate import evaluation
from shelfwise.operators.factorize import AlsSettings, fit_and_store, predict, settings_report
from shelfwise.operators.lookup import hot_keys, key_counts, spread_lookup
from shelfwise.operators.serve import one_request, serve
from shelfwise.operators.split import hashed_halves, random_halves
from shelfwise.operators.topk import long_form, recommend_all
from shelfwise.plans import exports
from shelfwise.plans.publish import current_version, held, load_published, publish
from shelfwise.schemas import DEFAULT_N, LIST_LENGTH
from shelfwise.session import job_folder, materialize, sized_shuffles, together
from shelfwise.sources import sinks
from shelfwise.sources.reviews import (
    blank_to_null, read_ratings, read_ratings_csv, read_raw_reviews,
)

SPLITS = {"random": random_halves, "hashed": hashed_halves}


def read_reviews(spark: SparkSession, path: str, file_format: str = "csv", **options):
    """Raw reviews from CSV or from Parquet, to which large CSV files are best converted."""
    if file_format == "csv":
        return read_raw_reviews(spark, path, **options)
    return blank_to_null(spark.read.parquet(path))


def convert_job(spark: SparkSession, csv_path: str, parquet_path: str, **options) -> None:
    """Raw CSV to raw Parquet, once, so that later runs prune columns and split files."""
    sinks.write_parquet(read_raw_reviews(spark, csv_path, **options), parquet_path)


def clean_job(
    spark: SparkSession, raw_path: str, out_path: str, *, file_format: str = "csv",
    on_bad_rating: str = "fail", csv_path: str | None = None, multi_line: bool = True,
    on_malformed: str = "fail", whole_files: bool = False,
) -> Row:
    """Clean ratings to Parquet, and to CSV if asked for; returns the audit, which has
    ``malformed_rows`` beside the counts of the rules: records dropped for their form.

    The raw files are parsed once: ratings and audit both come from the counted triples.
    """
    with job_folder(spark), sized_shuffles(spark, raw_path):
        counted = Observation() if file_format == "csv" and on_malformed == "drop" else None
        raw = read_reviews(
            spark, raw_path, file_format, multi_line=multi_line, whole_files=whole_files,
            on_malformed=on_malformed, dropped=counted,
        )
        groups = materialize(count_copies(raw, on_bad_rating), "groups")
        sinks.write_parquet(ratings_of(groups), out_path)
        if csv_path:
            sinks.write_csv(read_ratings(spark, out_path), csv_path)
        malformed = counted.get["malformed_rows"] if counted else 0
        return audit_of(groups).withColumn("malformed_rows", F.lit(malformed)).first()


def train_job(
    spark: SparkSession, ratings_path: str, root: str, *, file_format: str = "parquet",
    settings: AlsSettings = AlsSettings(), split: str = "random", top: int | None = None,
    multi_line: bool = True, keep_ids: bool = False,
) -> Row:
    """Index, encode, split, fit, evaluate and publish; with ``top``, all lists as well. With
    ``keep_ids`` the ids of the current version keep their integers and new ones go on."""
    with job_folder(spark), sized_shuffles(spark, ratings_path):
        if file_format == "csv":
            ratings = materialize(read_ratings_csv(
                spark, ratings_path, multi_line=multi_line), "ratings")
        else:
            ratings = read_ratings(spark, ratings_path)
        known = None
        if keep_ids and current_version(spark, root):
            before = load_published(spark, root)
            known = {"user_id": before.user_map, "product_id": before.product_map}
        users, products = index_columns(ratings, "user_id", "product_id", known=known)
        encoded = materialize(encode(ratings, users, products, fitted_on_df=True), "encoded")
        train, test = SPLITS[split](encoded)
        train = materialize(train, "train")
        train_rows = train.count()
        # Spark's solver keeps all ratings of one id in one block: say how large the largest are.
        heaviest = {f"largest_{name}_rows": id_map.agg(F.max("n")).first()[0] or 0
                    for name, id_map in (("user", users), ("product", products))}
        model = fit_and_store(train, settings)
        figures = evaluation(predict(model, test, "nan")).first()
        version = publish(
            spark, root, model, users, products,
            recs=recommend_all(model, top) if top else None,
            settings=settings_report(settings, train_rows) | {
                name: str(rows) for name, rows in heaviest.items()},
            rmse=figures.rmse,
            test_rows=figures.test_rows, predicted_rows=figures.predicted_rows,
        )
        return Row(
            version=version, train_rows=train_rows, test_rows=figures.test_rows,
            predicted_rows=figures.predicted_rows, rmse=figures.rmse,
            users=users.count(), products=products.count(), **heaviest,
        )


def decoded_lists(recs: DataFrame, user_map: DataFrame, product_map: DataFrame) -> DataFrame:
    """``(user_id, rank, product_id, score)`` in text ids. Lists should be a written table.

    The user's id is looked up once a list, before the entries become rows; products that
    stand in very many lists are spread over several tasks.
    """
    counts = key_counts(long_form(recs), "product_id_int")
    total = recs.agg(F.sum(F.size("recommendations"))).first()[0] or 0
    named = recs.join(user_map.select("user_id_int", "user_id"), "user_id_int", "left")
    found = spread_lookup(
        long_form(named, "user_id"),
        product_map.select("product_id_int", "product_id"),
        "product_id_int",
        hot_keys(counts, "product_id_int", total),
        ["user_id", "rank"],
    )

    def named_id(column):
        unknown = F.raise_error(F.lit(f"a list has an index without a {column} in the map"))
        return F.coalesce(column, unknown.cast("string")).alias(column)

    return found.select(named_id("user_id"), "rank", named_id("product_id"), "score")


def recommend_all_job(spark: SparkSession, root: str, out_path: str, k: int = LIST_LENGTH) -> int:
    """Lists of all users of the current version, as Parquet, JSON, CSV and decoded rows,
    and both id maps; returns the number of users."""
    published = load_published(spark, root)
    lists = f"{out_path}/recommendations"
    with job_folder(spark), sized_shuffles(spark, f"{root}/version={published.version}"):
        recs = materialize(recommend_all(published.model, k), "recommendations", lists)
    users, products = published.user_map, published.product_map
    with sized_shuffles(spark, lists):
        together(
            spark,
            lambda: sinks.write_recs_json(recs, f"{out_path}/recommendations_json"),
            lambda: sinks.write_recs_csv(recs, f"{out_path}/recommendations_csv"),
            lambda: sinks.write_parquet(
                decoded_lists(recs, users, products), f"{out_path}/decoded"),
            lambda: sinks.write_map(users, f"{out_path}/user_map"),
            lambda: sinks.write_map(products, f"{out_path}/product_map"),
        )
    return recs.count()


def export_job(spark: SparkSession, root: str, out_path: str, k: int = LIST_LENGTH) -> int:
    """The tables of :func:`recommend_all_job` as one run of an export, which readers see whole
    or not at all; returns the number of the run."""
    with held(spark, root) as published, job_folder(spark):
        with sized_shuffles(spark, f"{root}/version={published.version}"):
            recs = materialize(recommend_all(published.model, k), "recommendations")
        decoded = decoded_lists(recs, published.user_map, published.product_map)

        def counted(write, rows):
            def run(path):
                write(rows, path)
                return rows.count()

            return run

        return exports.export(spark, out_path, {
            "recommendations": counted(sinks.write_parquet, recs),
            "recommendations_json": counted(sinks.write_recs_json, recs),
            "recommendations_csv": counted(sinks.write_recs_csv, recs),
            "decoded": counted(sinks.write_parquet, decoded),
            "user_map": counted(sinks.write_map, published.user_map),
            "product_map": counted(sinks.write_map, published.product_map),
        })


def retrain(
    spark: SparkSession, raw_path: str, root: str, *, file_format: str = "csv",
    settings: AlsSettings = AlsSettings(), split: str = "random", top: int | None = None,
    on_bad_rating: str = "fail", multi_line: bool = True, whole_files: bool = False,
    on_malformed: str = "fail", keep_ids: bool = False,
) -> tuple[Row, Row]:
    """Clean, train, publish. Serving jobs started later pick up the new version."""
    with job_folder(spark) as folder:
        ratings_path = f"{folder}/ratings"
        audit = clean_job(
            spark, raw_path, ratings_path, file_format=file_format, on_bad_rating=on_bad_rating,
            multi_line=multi_line, whole_files=whole_files, on_malformed=on_malformed,
        )
        return audit, train_job(
            spark, ratings_path, root, settings=settings, split=split, top=top, keep_ids=keep_ids
        )


def serve_job(
    spark: SparkSession, requests_path: str, root: str, answers_path: str, log_path: str,
    batch: str,
) -> DataFrame:
    """Answer a table of requests with the current version. Names of batches have a prefix of
    their own, so none is that of a stream's batch."""
    requests = spark.read.parquet(requests_path)
    with held(spark, root) as published, sized_shuffles(spark, requests_path):
        return serve(requests, published.model, answers_path, log_path, f"job-{batch}",
                     version=published.version)


def answer_job(
    spark: SparkSession, root: str, answers_path: str, log_path: str, user_id: int,
    n: int = DEFAULT_N,
) -> str:
    """Answer one user with the current version: the JSON document a caller gets."""
    with held(spark, root) as published:
        answers = serve(one_request(spark, user_id, n), published.model, answers_path, log_path,
                        f"one-{uuid4().hex}", version=published.version)
    return sinks.answer_documents(answers).first().document
