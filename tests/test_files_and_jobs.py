"""Files written and read back, printed lists, publishing and whole jobs."""

import json

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from shelfwise.__main__ import parser, run
from shelfwise.functions.recommendations import printed_items
from shelfwise.operators.factorize import AlsSettings
from shelfwise.plans import fixture, jobs, publish, registry
from shelfwise.schemas import EMPTY_MESSAGE, RECOMMENDATIONS
from shelfwise.session import (
    INITIAL_PARTITIONS, job_folder, materialize, path_exists, scratch_path, sized_shuffles,
)
from shelfwise.sources import sinks
from shelfwise.sources.reviews import read_ratings_csv
from shelfwise.streaming.requests import read_answers

QUICK = AlsSettings(max_iter=2)


@pytest.fixture(scope="module")
def lists(spark):
    return spark.createDataFrame(
        [(1, [(5, 1.5e-05), (6, -0.5)]), (2, [(i, 12.0 - i) for i in range(12)])],
        RECOMMENDATIONS,
    )


def items(rows):
    return {r.user_id_int: [(i.product_id, i.predicted_rating) for i in r.recommendations]
            for r in rows}


def test_exports_keep_signs_small_numbers_and_all_entries(spark, lists, tmp_path):
    as_json, as_csv = str(tmp_path / "json"), str(tmp_path / "csv")
    sinks.write_recs_json(lists, as_json)
    sinks.write_recs_csv(lists, as_csv)
    expected = items(sinks.export_table(lists).collect())
    assert len(expected[2]) == 12 and expected[1][1] == (6, -0.5)
    assert expected[1][0] == (5, pytest.approx(1.5e-05))
    assert items(sinks.read_recs_json(spark, as_json).collect()) == expected
    assert items(sinks.read_recs_csv(spark, as_csv).collect()) == expected
    line = json.loads(spark.read.text(as_json).first().value)
    assert set(line) == {"user_id_int", "recommendations"}


def test_recommendations_roundtrip(spark, lists, tmp_path):
    sinks.write_parquet(lists, str(tmp_path / "recs"))
    assert sorted(sinks.read_recs(spark, str(tmp_path / "recs")).collect()) == sorted(lists.collect())


def test_printed_lists(spark):
    text = "[Row(product_id_int=1, rating=-0.5), Row(product_id_int=2, rating=1.5e-05), " \
           "Row(product_id_int=3, rating=4)]"
    long = "[" + ", ".join(f"Row(product_id_int={i}, rating={i}.25)" for i in range(15)) + "]"
    df = spark.createDataFrame([(text,), (long,), ("[]",)], "t string")
    rows = [[tuple(i) for i in r.v] for r in df.select(printed_items("t").alias("v")).collect()]
    assert rows[0] == [(1, -0.5), (2, 1.5e-05), (3, 4.0)]
    assert rows[1] == [(i, i + 0.25) for i in range(10)]
    assert rows[2] == []


def test_ratings_csv_with_awkward_ids(spark, tmp_path):
    df = spark.createDataFrame(
        [("00042", 'a"b,c', 1.0), ("é", "p q", 4.5)],
        "user_id string, product_id string, rating double",
    )
    sinks.write_csv(df, str(tmp_path / "csv"))
    assert sorted(read_ratings_csv(spark, str(tmp_path / "csv")).collect()) == sorted(df.collect())


def test_ratings_csv_checks_its_header(spark, tmp_path):
    (tmp_path / "r.csv").write_text("product_id,user_id,rating\np,u,1.0\n")
    with pytest.raises(Exception, match="header"):
        read_ratings_csv(spark, str(tmp_path)).collect()


def test_preview_is_ordered(spark):
    df = spark.range(100).repartition(7)
    assert [r.id for r in sinks.preview(df, "id").collect()] == [0, 1, 2, 3, 4]
    assert sinks.column_types(df) == [("id", "bigint")]


def test_publish_keeps_one_backup(spark, tmp_path):
    root = str(tmp_path / "models")
    assert publish.current_version(spark, root) == 0
    with pytest.raises(FileNotFoundError):
        publish.load_published(spark, root)
    model = registry.model(spark, SMALL, 0.8)
    maps = registry.id_map(spark, SMALL, "user_id"), registry.id_map(spark, SMALL, "product_id")
    for number in range(1, 4):
        assert publish.publish(spark, root, model, *maps, settings={"rank": "10"}) == number
        assert publish.current_version(spark, root) == number
    assert publish.kept_versions(spark, root) == [2, 3]
    now, before = publish.load_published(spark, root), publish.load_published(spark, root, 2)
    assert (now.version, before.version) == (3, 2)
    assert now.user_map.count() == maps[0].count()
    assert publish.versions(spark, root).first().settings == {"rank": "10"}


def test_unfinished_version_is_not_seen(spark, tmp_path):
    root = str(tmp_path / "models")
    model = registry.model(spark, SMALL, 0.8)
    maps = registry.id_map(spark, SMALL, "user_id"), registry.id_map(spark, SMALL, "product_id")
    publish.publish(spark, root, model, *maps)
    maps[0].write.parquet(f"{root}/version=2/user_map")
    assert publish.load_published(spark, root).version == 1
    assert publish.publish(spark, root, model, *maps) == 2
    assert publish.load_published(spark, root).version == 2


@pytest.mark.parametrize("split", ["random", "hashed"])
def test_retrain_from_csv_to_served_answers(spark, tmp_path, split):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "models")
    sinks.write_csv(fixture.reviews(spark, SMALL), raw)
    audit, run = jobs.retrain(spark, raw, root, settings=QUICK, split=split, top=3)
    assert (audit.raw_rows, audit.removed_rows, audit.final_rows) == (6000, 622, 3532)
    assert run.train_rows + run.test_rows == 3532
    assert (run.version, run.users, run.products) == (1, 150, 198)
    assert 0 < run.predicted_rows <= run.test_rows and 0 < run.rmse < 5
    recs = publish.published_recommendations(spark, root)
    assert recs.count() == 150 and recs.select(F.max(F.size("recommendations"))).first()[0] == 3
    out = str(tmp_path / "exports")
    assert jobs.recommend_all_job(spark, root, out) == 150
    for name in ("recommendations", "recommendations_json", "recommendations_csv", "decoded",
                 "user_map/csv", "product_map/json"):
        assert path_exists(spark, f"{out}/{name}")
    requests = str(tmp_path / "requests")
    fixture.requests(spark, SMALL).write.parquet(requests)
    answers = jobs.serve_job(
        spark, requests, root, str(tmp_path / "answers"), str(tmp_path / "log"), "1"
    )
    assert answers.count() == 1000
    assert {r.source for r in answers.select("source").distinct().collect()} == {"model", "none"}


def test_converted_reviews_clean_alike(spark, tmp_path):
    raw, parquet = str(tmp_path / "raw"), str(tmp_path / "parquet")
    sinks.write_csv(fixture.reviews(spark, SMALL), raw)
    jobs.convert_job(spark, raw, parquet)
    first = jobs.clean_job(spark, raw, str(tmp_path / "a"), csv_path=str(tmp_path / "csv"))
    second = jobs.clean_job(spark, parquet, str(tmp_path / "b"), file_format="parquet")
    assert first == second
    a, b = spark.read.parquet(str(tmp_path / "a")), spark.read.parquet(str(tmp_path / "b"))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert read_ratings_csv(spark, str(tmp_path / "csv")).exceptAll(a).isEmpty()


def test_scratch_tables_of_a_job_are_removed(spark):
    with job_folder(spark) as folder:
        assert scratch_path(spark, "x").startswith(folder)
        materialize(spark.range(3), "x")
        assert path_exists(spark, folder)
    assert not path_exists(spark, folder)


def test_shuffles_are_sized_by_the_input(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(100_000).write.parquet(path)
    with sized_shuffles(spark, path):
        assert spark.conf.get(INITIAL_PARTITIONS, None) is None
    monkeypatch.setattr("shelfwise.session.SHUFFLE_BYTES", 10_000)
    with sized_shuffles(spark, path):
        assert int(spark.conf.get(INITIAL_PARTITIONS)) > 30
    assert spark.conf.get(INITIAL_PARTITIONS, None) is None


def test_command_line_runs_the_jobs(spark, tmp_path):
    def call(*words):
        return run(spark, parser().parse_args([str(w) for w in words]))

    raw, root, ratings = tmp_path / "raw", tmp_path / "models", tmp_path / "ratings"
    sinks.write_csv(fixture.reviews(spark, SMALL), str(raw))
    as_csv = tmp_path / "ratings_csv"
    assert call("clean", f"{raw}/*.csv", ratings, "--csv-path", as_csv).final_rows == 3532
    assert call("clean", raw, tmp_path / "again", "--no-multi-line").final_rows == 3532
    call("convert", raw, tmp_path / "parquet")
    assert call("clean", tmp_path / "parquet", tmp_path / "third", "--file-format", "parquet",
                "--on-bad-rating", "drop").final_rows == 3532
    first = call("train", as_csv, tmp_path / "other", "--max-iter", 1, "--split", "hashed",
                 "--file-format", "csv")
    run_again = call("train", ratings, root, "--max-iter", 1, "--split", "hashed")
    assert run_again.version == 1
    assert (first.train_rows, first.users) == (run_again.train_rows, run_again.users)
    assert call("retrain", raw, root, "--rank", 4, "--max-iter", 1)[1].version == 2
    assert publish.load_published(spark, str(root)).model.rank == 4
    assert call("recommend", root, tmp_path / "exports", "--k", 2) == 150
    requests = tmp_path / "requests"
    fixture.requests(spark, SMALL).write.parquet(str(requests))
    paths = [tmp_path / "answers", tmp_path / "log"]
    assert call("serve", requests, root, *paths, "first").count() == 1000
    found = json.loads(call("answer", root, *paths, 3, "--n", 2))
    assert found["user_id"] == 3 and len(found["recommendations"]) == 2 and found["timestamp"]
    stored = json.loads(call("answer", root, *paths, 20, "--n", 0))
    assert stored["recommendations"] and "message" not in stored
    assert json.loads(call("answer", root, *paths, 10**7)) == {
        "user_id": 10**7, "recommendations": [], "message": EMPTY_MESSAGE}
    call("stream", requests, root, tmp_path / "streamed", tmp_path / "log2", tmp_path / "state")
    assert read_answers(spark, str(tmp_path / "streamed")).count() == 1000


def test_answer_documents(spark):
    rows = spark.createDataFrame([
        (1, 3, [(5, 1.5)], "2024-01-01T00:00:00.000000", None), (2, 4, [], None, EMPTY_MESSAGE),
    ], "request_id bigint, user_id bigint, "
       "recommendations array<struct<product_id:int,score:double>>, timestamp string, message string")
    found, empty = [json.loads(r.document) for r in
                    sinks.answer_documents(rows).orderBy("request_id").collect()]
    assert found == {"user_id": 3, "recommendations": [{"product_id": 5, "score": 1.5}],
                     "timestamp": "2024-01-01T00:00:00.000000"}
    assert empty == {"user_id": 4, "recommendations": [], "message": EMPTY_MESSAGE}


def test_printed_entries_without_a_number_leave_the_others(spark):
    from shelfwise.functions.recommendations import printed_items

    text = ", ".join(f"Row(product_id_int={i}, rating={r})" for i, r in enumerate(
        ("4.5", "nan", "-0.5", "inf", "1.5e-05")))
    (row,) = spark.createDataFrame([(f"[{text}]",)], "t string").select(
        printed_items("t").alias("items")).collect()
    assert [tuple(x) for x in row["items"]] == [(0, 4.5), (2, -0.5), (4, 1.5e-05)]


def test_malformed_records_fail_unless_dropped(spark, tmp_path):
    from shelfwise.sources.reviews import read_raw_reviews

    path = tmp_path / "raw.csv"
    path.write_text('reviewerID,asin,overall\nA,p,1\nB,"q\nr",2\nC,s\nD,t,3,extra\n')
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        read_raw_reviews(spark, str(path)).collect()
    kept = read_raw_reviews(spark, str(path), on_malformed="drop").collect()
    assert [row.asin for row in kept] == ["p", "q\nr"]


def test_retired_versions_go_by_number_and_age(spark, tmp_path):
    from shelfwise.plans import publish

    root = str(tmp_path / "models")
    for version in range(1, 5):
        assert publish.claimed_version(spark, root) == version
        (tmp_path / "models" / f"version={version}").mkdir(parents=True)
        spark.createDataFrame([(version, "", None, 0, 0, 0.0, {})], publish.CURRENT).selectExpr(
            "version", "path", "current_timestamp() AS published_at", "test_rows",
            "predicted_rows", "rmse", "settings").write.mode("append").parquet(f"{root}/current")
    assert publish.retired_versions(spark, root, 4, 2, 0) == [1, 2]
    assert publish.retired_versions(spark, root, 4, 2, 3600) == []
    assert publish.kept_versions(spark, root) == [1, 2, 3, 4]
