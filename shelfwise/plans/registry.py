"""The registered queries: each takes a session and a folder of tables, returns a DataFrame.

All read the whole given tables. Lists are exploded and scores of the model left out, so
that results are plain columns another engine can check.
"""

from functools import wraps

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.operators import clean, encode, evaluate, serve, split, topk
from shelfwise.operators.first_answers import FirstAnswers
from shelfwise.operators.factorize import (
    AlsSettings, fit_and_store, load_model, predict, save_model, settings_report,
)
from shelfwise.functions.recommendations import iso_timestamp
from shelfwise.plans import decoded, exports, fixture, jobs, publish
from shelfwise.schemas import DEFAULT_N, LIST_LENGTH, RATING_KEY
from shelfwise.session import materialize, scratch_path
from shelfwise.sources import reviews as review_files, sinks
from shelfwise.streaming import requests as streaming

# A train share small enough that many ids of the test half are unknown.
SPARSE_SHARE = 1 / 32

# Vectors that Spark's recommender compares at once; larger blocks are no faster.
BUILTIN_BLOCK = 16_384

QUERIES = {}
_SHARED: dict[tuple, object] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def shared(function):
    """Compute a written table or a fitted model once a session and folder."""

    @wraps(function)
    def once(spark: SparkSession, folder: str, *args):
        key = (spark.sparkContext.applicationId, folder, function.__name__, *args)
        if key not in _SHARED:
            _SHARED[key] = function(spark, folder, *args)
        return _SHARED[key]

    return once


@shared
def ratings(spark, folder) -> DataFrame:
    return materialize(clean.clean_reviews(fixture.reviews(spark, folder)), "ratings")


@shared
def id_map(spark, folder, column) -> DataFrame:
    return materialize(encode.index_by_frequency(ratings(spark, folder), column), column)


@shared
def encoded(spark, folder) -> DataFrame:
    return materialize(
        encode.encode(
            ratings(spark, folder), id_map(spark, folder, "user_id"),
            id_map(spark, folder, "product_id"), fitted_on_df=True,
        ),
        "encoded",
    )


def halves(spark, folder, share=0.8):
    return split.hashed_halves(encoded(spark, folder), share)


@shared
def model(spark, folder, share):
    """A model of the train half, or of all ratings for a share of 1."""
    rows = encoded(spark, folder)
    train = rows if share == 1 else split.hashed_halves(rows, share)[0]
    return fit_and_store(train)


@shared
def all_lists(spark, folder) -> DataFrame:
    return materialize(topk.recommend_all(model(spark, folder, 0.8)), "lists")


# --- cleaning -----------------------------------------------------------------------------


@query
def clean_reviews(spark, folder):
    return clean.clean_reviews(fixture.reviews(spark, folder))


@query
def clean_reviews_csv(spark, folder):
    """The same by way of a raw CSV file with a header and the original names."""
    path = scratch_path(spark, "raw_csv")
    sinks.write_csv(fixture.reviews(spark, folder), path)
    return clean.clean_reviews(review_files.read_raw_reviews(spark, path))


@query
def clean_drop_nulls(spark, folder):
    named = clean.keep_rating_columns(fixture.reviews(spark, folder))
    return clean.drop_incomplete(clean.typed(named))


@query
def clean_dedup(spark, folder):
    return clean.drop_copies(clean_drop_nulls(spark, folder))


@query
def clean_valid_ratings(spark, folder):
    named = clean.keep_rating_columns(fixture.reviews(spark, folder))
    return clean.valid_ratings(clean.typed(named))


@query
def cleaning_audit(spark, folder):
    return clean.cleaning_audit(fixture.reviews(spark, folder))


@query
def cleaning_audit_malformed(spark, folder):
    """The audit of a CSV file with short, long and broken records, which are dropped."""
    path = scratch_path(spark, "raw_lines")
    # A field separator and a quote that are not in the lines: they are written as they are.
    fixture.raw_lines(spark, folder).write.csv(path, header=True, sep="\x01", quote="\x02")
    audit = jobs.clean_job(spark, path, scratch_path(spark, "cleaned"), on_malformed="drop")
    return spark.createDataFrame([audit])


@query
def ratings_csv_awkward(spark, folder):
    """Ids with blanks at their ends and line breaks, by way of CSV."""
    odd = F.when(F.col("user_id").endswith("7"), F.lit("\n\"x")).otherwise(" ")
    rows = ratings(spark, folder).withColumn("user_id", F.concat(F.lit(" "), "user_id", odd))
    path = scratch_path(spark, "ratings_csv")
    sinks.write_csv(rows, path)
    return review_files.read_ratings_csv(spark, path)


@query
def ratings_csv_roundtrip(spark, folder):
    path = scratch_path(spark, "ratings_csv")
    sinks.write_csv(ratings(spark, folder), path)
    return review_files.read_ratings_csv(spark, path)


@query
def raw_shape(spark, folder):
    """Rows and columns of the raw table."""
    raw = fixture.reviews(spark, folder)
    return raw.agg(
        F.count("*").alias("rows"), F.lit(len(sinks.column_types(raw))).alias("columns")
    )


@query
def first_ratings(spark, folder):
    return sinks.preview(ratings(spark, folder), *RATING_KEY)


# --- ids ----------------------------------------------------------------------------------


@query
def user_index(spark, folder):
    return encode.index_by_frequency(ratings(spark, folder), "user_id")


@query
def product_index(spark, folder):
    return encode.index_by_frequency(ratings(spark, folder), "product_id")


@query
def encoded_ratings(spark, folder):
    users = encode.index_by_frequency(ratings(spark, folder), "user_id")
    products = encode.index_by_frequency(ratings(spark, folder), "product_id")
    return encode.encode(ratings(spark, folder), users, products, fitted_on_df=True)


@query
def index_extended(spark, folder):
    """Numbers of all ids when those of a first half of the ratings keep theirs."""
    first, _ = split.hashed_halves(ratings(spark, folder), 0.5)
    maps = []
    for column in ("user_id", "product_id"):
        known = materialize(encode.index_by_frequency(first, column), "known")
        extended = encode.extend_index(known, ratings(spark, folder), column)
        maps.append(extended.toDF("id", "index", "n").withColumn("map", F.lit(column)))
    return maps[0].unionByName(maps[1])


@query
def encode_unseen(spark, folder):
    """Maps fitted on a small train half, applied to all ratings."""
    train, _ = split.hashed_halves(ratings(spark, folder), SPARSE_SHARE)
    users = materialize(encode.index_by_frequency(train, "user_id"), "users")
    products = materialize(encode.index_by_frequency(train, "product_id"), "products")
    return encode.encode(ratings(spark, folder), users, products)


@query
def user_mapping(spark, folder):
    return encode.mapping_of(halves(spark, folder)[0], "user_id")


@query
def product_mapping(spark, folder):
    return encode.mapping_of(halves(spark, folder)[0], "product_id")


@query
def decode_ratings(spark, folder):
    indices = encoded(spark, folder).drop("user_id", "product_id")
    users, products = id_map(spark, folder, "user_id"), id_map(spark, folder, "product_id")
    rest = ["rating", "product_id_int"]
    named = encode.decode_column(indices, users, "user_id", rest)
    return encode.decode_column(named, products, "product_id", ["user_id", "rating"]).select(
        *RATING_KEY
    )


@query
def map_exports(spark, folder):
    """Both id maps by way of their CSV and JSON files."""
    rows = []
    for column in ("user_id", "product_id"):
        path = scratch_path(spark, "map")
        sinks.write_map(id_map(spark, folder, column), path)
        schema = f"{column} string, {column}_int int"
        csv = spark.read.schema(schema).csv(f"{path}/csv", header=True, escape='"')
        json = spark.read.schema(schema).json(f"{path}/json")
        for kind, back in (("csv", csv), ("json", json)):
            rows.append(back.select(
                F.lit(column).alias("map"), F.lit(kind).alias("format"),
                F.col(column).alias("id"), F.col(f"{column}_int").alias("index"),
            ))
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


# --- split --------------------------------------------------------------------------------


@query
def split_counts(spark, folder):
    train = split.pair_hash() >= split.hash_bound(0.8)
    half = F.when(train, "train").otherwise("test")
    return ratings(spark, folder).groupBy(half.alias("half")).agg(F.count("*").alias("n"))


@query
def random_split_total(spark, folder):
    """Every rating is in exactly one of the random halves."""
    train, test = split.random_halves(ratings(spark, folder))
    return train.unionAll(test).groupBy(*RATING_KEY).agg(F.count("*").alias("n"))


# --- figures ------------------------------------------------------------------------------


@query
def rating_summary(spark, folder):
    figures = evaluate.summary(ratings(spark, folder), "rating")
    return figures.select(
        "column_name", "n", F.round("mean", 6).alias("mean"),
        F.round("stddev", 6).alias("stddev"), "min", "max",
    )


@query
def rmse_baseline(spark, folder):
    """The evaluator on a prediction SQL can make: the mean train rating of the product."""
    train, test = split.hashed_halves(ratings(spark, folder))
    means = train.groupBy("product_id").agg(F.avg("rating").alias("prediction"))
    figures = evaluate.rmse(test.join(means, "product_id", "left"))
    return figures.select("n", F.round("rmse", 6).alias("rmse"))


def _survivors(spark, folder, share):
    _, test = halves(spark, folder, share)
    predicted = evaluate.drop_unpredicted(predict(model(spark, folder, share), test))
    return predicted.select(*RATING_KEY)


@query
def coldstart_survivors(spark, folder):
    return _survivors(spark, folder, 0.8)


@query
def coldstart_survivors_sparse(spark, folder):
    return _survivors(spark, folder, SPARSE_SHARE)


@query
def prediction_coverage(spark, folder):
    _, test = halves(spark, folder)
    return evaluate.coverage(predict(model(spark, folder, 0.8), test, "nan"))


@query
def prediction_coverage_sparse(spark, folder):
    _, test = halves(spark, folder, SPARSE_SHARE)
    return evaluate.coverage(predict(model(spark, folder, SPARSE_SHARE), test, "nan"))


@query
def evaluation_report(spark, folder):
    """All figures of a run in one pass; the RMSE beside that of Spark's evaluator."""
    _, test = halves(spark, folder)
    fitted = model(spark, folder, 0.8)
    theirs = RegressionEvaluator(
        metricName="rmse", labelCol="rating", predictionCol="prediction"
    ).evaluate(predict(fitted, test))
    figures = evaluate.evaluation(predict(fitted, test, "nan"))
    return figures.select(
        "test_rows", "predicted_rows", "percent",
        (F.abs(F.col("rmse") - theirs) < 1e-9).alias("rmse_agrees"),
    )


@query
def model_roundtrip(spark, folder):
    """Predictions of a model and of the same model saved and loaded, side by side."""
    _, test = halves(spark, folder)
    first, path = model(spark, folder, 0.8), scratch_path(spark, "model_again")
    save_model(first, path)
    before = predict(first, test).withColumnRenamed("prediction", "before")
    after = predict(load_model(spark, path), test).withColumnRenamed("prediction", "after")
    pairs = before.join(after.select(*RATING_KEY, "after"), RATING_KEY)
    return pairs.select(*RATING_KEY, (F.col("before") == F.col("after")).alias("same"))


# --- lists --------------------------------------------------------------------------------


@query
def recs_all_shape(spark, folder):
    lists = topk.recommend_all(model(spark, folder, 0.8))
    return lists.select("user_id_int", F.size("recommendations").alias("n_items"))


@query
def recs_subset_shape(spark, folder):
    """Lists of the requested users only; unknown ids have none, repeated ids have one."""
    wanted = fixture.requests(spark, folder).select("user_id").distinct()
    lists = topk.recommend_for(
        model(spark, folder, 0.8), wanted.withColumn("k", F.lit(DEFAULT_N))
    )
    return lists.select("user_id_int", F.size("recommendations").alias("n_items"))


@query
def recs_long(spark, folder):
    rows = topk.long_form(all_lists(spark, folder), length=LIST_LENGTH)
    return rows.select("user_id_int", "rank")


@query
def recs_unseen(spark, folder):
    """Lists without the products a user has rated in the train half."""
    train, _ = halves(spark, folder)
    lists = topk.recommend_unseen(model(spark, folder, 0.8), train)
    rated = train.select("user_id_int", "product_id_int").distinct().withColumn(
        "rated", F.lit(True))
    return lists.join(rated, ["user_id_int", "product_id_int"], "left").select(
        "user_id_int", "rank", F.coalesce("rated", F.lit(False)).alias("rated"))


@query
def recs_decoded(spark, folder):
    rows = jobs.decoded_lists(
        all_lists(spark, folder), id_map(spark, folder, "user_id"),
        id_map(spark, folder, "product_id"),
    )
    return rows.filter(F.col("product_id").isNotNull()).select("user_id", "rank")


@query
def recs_json_roundtrip(spark, folder):
    """Every list by way of its JSON and its CSV export."""
    lists = sinks.export_table(all_lists(spark, folder))
    json, csv = scratch_path(spark, "recs_json"), scratch_path(spark, "recs_csv")
    sinks.write_recs_json(all_lists(spark, folder), json)
    sinks.write_recs_csv(all_lists(spark, folder), csv)
    original = F.col("recommendations")
    return (
        lists
        .join(sinks.read_recs_json(spark, json).toDF("user_id_int", "from_json"), "user_id_int")
        .join(sinks.read_recs_csv(spark, csv).toDF("user_id_int", "from_csv"), "user_id_int")
        .select(
            "user_id_int", F.size(original).alias("n_items"),
            (original == F.col("from_json")).alias("json_same"),
            (original == F.col("from_csv")).alias("csv_same"),
        )
    )


@query
def legacy_recs_parse(spark, folder):
    """Printed lists in a CSV file, read back as typed entries."""
    path = scratch_path(spark, "printed")
    sinks.write_csv(fixture.printed_lists(spark, folder), path)
    lists = sinks.read_printed_recs(spark, path)
    return lists.select(
        "user_id_int", F.posexplode("recommendations").alias("pos", "item")
    ).select(
        "user_id_int", (F.col("pos") + 1).alias("rank"), "item.product_id",
        "item.predicted_rating",
    )


@query
def topk_dot_product(spark, folder):
    """The ranking step on given vectors: the five best of all others and itself for each."""
    vectors = fixture.table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("features")
    )
    return topk.top_k(vectors, vectors, 5).select(
        F.col("id").alias("user_vec"), "rank", F.col("item").alias("item_vec"),
        F.round("score", 6).alias("score"),
    )


# --- serving ------------------------------------------------------------------------------


def _answer_shape(answers):
    return answers.select(
        "request_id", "user_id", "n", "source", F.size("recommendations").alias("n_items")
    )


@query
def serve_batch(spark, folder):
    return _answer_shape(serve.answer(
        fixture.requests(spark, folder), model(spark, folder, 1),
        fixture.stored_answers(spark, folder),
    ))


@shared
def first_answers(spark, folder) -> FirstAnswers:
    """The stored answers as a table of first ones, from four batches, the second one repeated
    and the first two folded."""
    table = FirstAnswers(spark, scratch_path(spark, "first")).start(slots=8)
    rows = fixture.stored_answers(spark, folder)
    for number in (0, 1, 1, None, 2, 3):
        if number is None:
            table.fold()
        else:
            table.add(f"b{number}", rows.where(F.crc32("timestamp") % 4 == number))
    return table


@query
def first_answers_table(spark, folder):
    """The first stored answer of every user."""
    return first_answers(spark, folder).all().select(
        "user_id", "stored.timestamp", F.inline("stored.recommendations"))


@query
def serve_fallback(spark, folder):
    """The answers that came from the table of first ones, in full."""
    answers = serve.answer(
        fixture.requests(spark, folder), model(spark, folder, 1), first_answers(spark, folder))
    return answers.filter(F.col("source") == "stored").select(
        "request_id", "user_id", "timestamp", F.inline("recommendations")
    )


@query
def answer_documents(spark, folder):
    """The answers as JSON documents, and what a caller finds in them."""
    answers = serve.answer(
        fixture.requests(spark, folder), model(spark, folder, 1),
        fixture.stored_answers(spark, folder),
    )
    found = F.get_json_object("document", "$.recommendations")
    return sinks.answer_documents(answers).select(
        "request_id",
        F.get_json_object("document", "$.user_id").cast("bigint").alias("user_id"),
        F.json_array_length(found).alias("n_items"),
        F.get_json_object("document", "$.timestamp").isNotNull().alias("has_time"),
        F.get_json_object("document", "$.message").alias("message"),
    )


@query
def serve_log(spark, folder):
    """What a batch adds to the log, also if it is answered twice."""
    answers, log = scratch_path(spark, "answers"), scratch_path(spark, "log")
    for _ in range(2):
        serve.serve(
            fixture.requests(spark, folder), model(spark, folder, 1), answers, log, "b1"
        )
    logged = serve.read_log(spark, log)
    length = F.size("recommendations").alias("n_items")
    return logged.groupBy("user_id", length).agg(F.count("*").alias("n"))


@query
def serve_stream(spark, folder):
    """The requests as a stream of files, answered in several batches."""
    paths = {name: scratch_path(spark, name) for name in ("requests", "out", "log", "state")}
    fixture.requests(spark, folder).repartition(4, "request_id").write.parquet(paths["requests"])
    run = streaming.serve_stream(
        streaming.request_stream(spark, paths["requests"], files_per_batch=2),
        model(spark, folder, 1), paths["out"], paths["log"], paths["state"],
        stored=lambda: fixture.stored_answers(spark, folder),
    )
    run.awaitTermination()
    return _answer_shape(streaming.read_answers(spark, paths["out"]))


@query
def serve_stream_repeats(spark, folder):
    """Every request is in two files of a stream that answers repeated ones once."""
    paths = {name: scratch_path(spark, name) for name in ("requests", "out", "log", "state")}
    for _ in range(2):
        fixture.requests(spark, folder).repartition(2, "request_id").write.mode(
            "append").parquet(paths["requests"])
    streaming.serve_stream(
        streaming.request_stream(
            spark, paths["requests"], files_per_batch=2, repeats_within="1 hour"),
        model(spark, folder, 1), paths["out"], paths["log"], paths["state"],
        stored=lambda: fixture.stored_answers(spark, folder),
    ).awaitTermination()
    return _answer_shape(streaming.read_answers(spark, paths["out"]))


@query
def serve_stream_versions(spark, folder):
    """A version is published while a stream runs: which one answered each request?"""
    root, state = scratch_path(spark, "published"), scratch_path(spark, "state")
    paths = {name: scratch_path(spark, name) for name in ("requests", "out", "log")}
    users, products = id_map(spark, folder, "user_id"), id_map(spark, folder, "product_id")
    rows = fixture.requests(spark, folder)
    rows.limit(0).write.parquet(paths["requests"])
    publish.publish(spark, root, model(spark, folder, 1), users, products)
    run = streaming.serve_stream(
        streaming.request_stream(spark, paths["requests"]), publish.CurrentModel(spark, root),
        paths["out"], paths["log"], state, trigger={"processingTime": "0 seconds"},
    )
    for half in (0, 1):
        if half:
            publish.publish(spark, root, model(spark, folder, 1), users, products)
        rows.where(F.col("request_id") % 2 == half).coalesce(1).write.mode("append").parquet(
            paths["requests"])
        run.processAllAvailable()
    run.stop()
    return streaming.read_answers(spark, paths["out"]).select("request_id", "version")


@query
def serve_two_streams(spark, folder):
    """Two streams with checkpoints of their own into the same folders, the first one started
    again: every request is answered once by each."""
    paths = {name: scratch_path(spark, name) for name in ("requests", "out", "log")}
    fixture.requests(spark, folder).write.parquet(paths["requests"])
    states = [scratch_path(spark, "state") for _ in range(2)]
    for state in (*states, states[0]):
        streaming.serve_stream(
            streaming.request_stream(spark, paths["requests"]), model(spark, folder, 1),
            paths["out"], paths["log"], state, stored=lambda: None,
        ).awaitTermination()
    logged = serve.read_log(spark, paths["log"]).groupBy("user_id").agg(
        F.count("*").alias("n_logged"))
    answered = streaming.read_answers(spark, paths["out"]).groupBy("user_id").agg(
        F.count("*").alias("n_answers"))
    return answered.join(logged, "user_id", "left").select(
        "user_id", "n_answers", F.coalesce("n_logged", F.lit(0)).alias("n_logged"))


@query
def serve_decoded(spark, folder):
    """Answers of two versions with other numbers, one old and without its version, in text ids."""
    root, fitted = scratch_path(spark, "published"), model(spark, folder, 0.8)
    first, _ = split.hashed_halves(ratings(spark, folder), 0.5)
    maps = {1: [], 2: []}
    for column in ("user_id", "product_id"):
        known = materialize(encode.index_by_frequency(first, column), "known")
        maps[1].append(id_map(spark, folder, column))
        maps[2].append(materialize(
            encode.extend_index(known, ratings(spark, folder), column), "extended"))
    given = []
    for version, (users, products) in maps.items():
        publish.publish(spark, root, fitted, users, products)
        rows = encode.encode(ratings(spark, folder), users, products, fitted_on_df=True)
        item = F.struct(F.col("product_id_int").alias("product_id"), F.col("rating").alias("score"))
        given.append(materialize(rows.groupBy(F.col("user_id_int").alias("user_id")).agg(
            F.collect_list(item).alias("recommendations")).select(
            (F.col("user_id") * 2 + version).alias("request_id"), "user_id", "recommendations",
            iso_timestamp(F.current_timestamp()).alias("timestamp"),
            F.lit(version if version == 2 else None).cast("int").alias("version")), "given"))
    found = decoded.decoded_answers(spark, root, given[0].unionByName(given[1]), "request_id")
    return found.select("version", "user_id", F.inline("recommendations"))


# --- jobs ---------------------------------------------------------------------------------


@query
def publish_current(spark, folder):
    """Three publishes in a row: the last one is current, and it and one backup are kept."""
    root, fitted = scratch_path(spark, "published"), model(spark, folder, 0.8)
    users, products = id_map(spark, folder, "user_id"), id_map(spark, folder, "product_id")
    settings = settings_report(AlsSettings(), halves(spark, folder)[0].count())
    for _ in range(3):
        publish.publish(spark, root, fitted, users, products, settings=settings)
    current = publish.current_version(spark, root)
    kept = publish.kept_versions(spark, root)
    now = publish.load_published(spark, root)
    return publish.versions(spark, root).select(
        "version", (F.col("version") == current).alias("is_current"),
        F.col("version").isin(kept).alias("is_kept"),
        F.col("settings")["rank"].cast("int").alias("rank"),
        F.col("settings")["maxIter"].cast("int").alias("max_iter"),
        F.col("settings")["regParam"].cast("double").alias("reg_param"),
        F.col("settings")["coldStartStrategy"].alias("cold_start"),
        F.lit(now.user_map.count()).cast("bigint").alias("users"),
        F.lit(now.product_map.count()).cast("bigint").alias("products"),
    )


@query
def retrain_report(spark, folder):
    """The whole retrain job, from raw reviews to a published version, and its figures."""
    raw, root = scratch_path(spark, "raw"), scratch_path(spark, "models")
    sinks.write_parquet(fixture.reviews(spark, folder), raw)
    audit, run = jobs.retrain(
        spark, raw, root, file_format="parquet", settings=AlsSettings(max_iter=2),
        split="hashed",
    )
    return publish.versions(spark, root).select(
        "version", "test_rows", "predicted_rows", *[
            F.lit(value).cast("bigint").alias(name)
            for name, value in {
                "train_rows": run.train_rows, "raw_rows": audit.raw_rows,
                "removed_rows": audit.removed_rows, "final_rows": audit.final_rows,
                "users": run.users, "products": run.products,
            }.items()
        ],
    )


@query
def recommend_all_export(spark, folder):
    """The export job on a published version: lists as rows of text ids and ranks."""
    root, out = scratch_path(spark, "published"), scratch_path(spark, "exports")
    publish.publish(
        spark, root, model(spark, folder, 0.8), id_map(spark, folder, "user_id"),
        id_map(spark, folder, "product_id"),
    )
    jobs.recommend_all_job(spark, root, out)
    return spark.read.parquet(f"{out}/decoded").select("user_id", "rank")


@query
def export_manifest(spark, folder):
    """Two exports of a published version: what the manifest says of the last one."""
    root, out = scratch_path(spark, "published"), scratch_path(spark, "exports")
    publish.publish(
        spark, root, model(spark, folder, 0.8), id_map(spark, folder, "user_id"),
        id_map(spark, folder, "product_id"))
    for _ in range(2):
        jobs.export_job(spark, root, out)
    last = exports.exported(spark, out)
    return spark.createDataFrame(
        [(last.run, name, rows) for name, rows in last.rows.items()],
        "run int, name string, n bigint")


@query
def recs_export_lengths(spark, folder):
    """Lists of twenty through all four exports of one run."""
    root, out = scratch_path(spark, "published"), scratch_path(spark, "exports")
    users = id_map(spark, folder, "user_id")
    publish.publish(
        spark, root, model(spark, folder, 0.8), users, id_map(spark, folder, "product_id"))
    jobs.recommend_all_job(spark, root, out, k=20)
    size = F.size("recommendations")
    exports = {
        "n_parquet": sinks.read_recs(spark, f"{out}/recommendations").select("user_id_int", size),
        "n_json": sinks.read_recs_json(spark, f"{out}/recommendations_json").select(
            "user_id_int", size),
        "n_csv": sinks.read_recs_csv(spark, f"{out}/recommendations_csv").select(
            "user_id_int", size),
        "n_decoded": spark.read.parquet(f"{out}/decoded").join(users, "user_id").groupBy(
            "user_id_int").agg(F.count("*").cast("int")),
    }
    lengths = users.select("user_id_int")
    for name, rows in exports.items():
        lengths = lengths.join(rows.toDF("user_id_int", name), "user_id_int", "left")
    return lengths.where("n_parquet IS NOT NULL")


def builtin_lists(spark, fitted) -> DataFrame:
    """Spark's own lists of all users. Its blocks are as large as pays, and every part of the users
    meets every part of the products in a task of its own; broadcast products would leave as
    many tasks as the users have parts."""
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        lists = fitted.copy().setBlockSize(BUILTIN_BLOCK).recommendForAllUsers(LIST_LENGTH)
        return materialize(lists, "builtin")
    finally:
        spark.conf.set(threshold, before)


@query
def recs_match_builtin(spark, folder):
    """Every entry of every list beside Spark's own: the same score at the same rank."""
    fitted = model(spark, folder, 0.8)
    own = topk.long_form(topk.recommend_all(fitted, LIST_LENGTH))
    other = topk.long_form(builtin_lists(spark, fitted))
    other = other.select("user_id_int", "rank", F.col("score").alias("builtin"))
    return own.join(other, ["user_id_int", "rank"], "full").select(
        "user_id_int", "rank", (F.abs(F.col("score") - F.col("builtin")) < 1e-5).alias(
            "same_score"))


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """What should each customer be shown? Raw reviews to decoded lists, end to end."""
    return jobs.decoded_lists(
        all_lists(spark, folder), id_map(spark, folder, "user_id"),
        id_map(spark, folder, "product_id"),
    )
