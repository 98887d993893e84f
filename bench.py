"""Time the headline steps and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of cores. The steps are those
and its result is written out whole. All are run three times from scratch, nothing is cached
in between. The baseline was taken in a warm session, so the headline is the faster of the last
two runs of each step; the first run is reported beside it.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfwise.operators import clean, encode, evaluate, serve, split, topk  # noqa: E402
from shelfwise.operators.factorize import fit_and_store, predict  # noqa: E402
from shelfwise.plans import fixture, jobs  # noqa: E402
from shelfwise.session import build_session, materialize  # noqa: E402


def run(spark, folder):
    """Seconds of each step, all run from scratch."""
    seconds = {}

    def step(name, action):
        start = time.perf_counter()
        result = action()
        seconds[name] = round(time.perf_counter() - start, 3)
        return result

    # As the job does it: one pass over the reviews for both the ratings and the audit.
    groups = step("join_count_copies", lambda: materialize(
        clean.count_copies(fixture.reviews(spark, folder)), "groups"))
    ratings = step("clean", lambda: materialize(clean.ratings_of(groups), "ratings"))
    step("cleaning_audit", lambda: clean.audit_of(groups).first())
    users, products = step(
        "index", lambda: encode.index_columns(ratings, "user_id", "product_id"))
    encoded = step("encode", lambda: materialize(
        encode.encode(ratings, users, products, fitted_on_df=True), "encoded"))
    train, test = split.hashed_halves(encoded)
    model = step("fit", lambda: fit_and_store(train))
    step("predict_rmse", lambda: evaluate.evaluation(predict(model, test, "nan")).first())
    recs = step("top10_all_users", lambda: topk.recommend_all(model))  # a written table
    step("decode_lists", lambda: materialize(
        jobs.decoded_lists(recs, users, products), "decoded"))
    step("serve_batch", lambda: materialize(serve.answer(
        fixture.requests(spark, folder), model, fixture.stored_answers(spark, folder)), "answers"))
    return seconds


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    first, second, third = (run(spark, folder) for _ in range(3))
    warm = {name: min(second[name], third[name]) for name in first}
    spark.stop()
    print(json.dumps({
        "metric": "recommendation pipeline, raw reviews to served answers, warm session",
        "value": round(sum(warm.values()), 3), "unit": "sec", "queries": warm,
        "sf": folder.rsplit("/sf", 1)[-1], "cpus": int(cpus),
        "first_run": first, "first_run_total": round(sum(first.values()), 3),
    }))


if __name__ == "__main__":
    main()
