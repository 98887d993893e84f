"""CSV records read from parts of files, against Python's own reader."""

import csv
import random

import pytest
from pyspark.sql import types as T

from shelfwise.plans import jobs
from shelfwise.sources import csv_records
from shelfwise.sources.reviews import read_raw_reviews

NAMES = ["a", "b\nc", "d"]


@pytest.fixture
def small_parts(spark):
    """Parts of 300 bytes in place of 128 MB."""
    before = {name: spark.conf.get(name) for name in (
        "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def invented(path, files=3, rows=120):
    """Files with line breaks, quotes and commas in fields, some much longer than a part."""
    rng, wanted = random.Random(1), []
    for number in range(files):
        with open(f"{path}/{number}.csv", "w", newline="") as file:
            out = csv.writer(file, lineterminator="\r\n" if number == 1 else "\n")
            out.writerow(NAMES)
            for i in range(rows):
                odd = "".join(rng.choices(["x", '"', "\n", ",", "é", " ", "\n\n", '""'],
                                          k=rng.randint(0, 9)))
                long = "x" * rng.choice([3, 900]) + "\n\n" + "y" * 50
                row = [f"{number}-{i}", odd, rng.choice(["", "q", long])]
                out.writerow(row)
                wanted.append(tuple(field or None for field in row))
    return wanted


def plain(rows):
    return sorted((tuple(field or None for field in row) for row in rows), key=repr)


def test_records_of_parts_equal_a_plain_reader(spark, tmp_path, small_parts):
    wanted = invented(tmp_path)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in NAMES])
    lines = csv_records.file_lines(spark, str(tmp_path))
    assert lines.select("file", "block").distinct().count() > 90
    assert plain(csv_records.read_csv(spark, str(tmp_path), schema).collect()) == plain(wanted)
    raw = read_raw_reviews(spark, str(tmp_path), na_tokens=())
    assert raw.columns == NAMES and raw.rdd.getNumPartitions() > 1
    assert plain(raw.collect()) == plain(wanted)


def test_batches_within_a_part(spark, tmp_path, small_parts):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        wanted = invented(tmp_path, files=1, rows=40)
        assert plain(read_raw_reviews(spark, str(tmp_path)).collect()) == plain(wanted)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_headers_and_empty_files(spark, tmp_path):
    schema = T.StructType([T.StructField(name, T.StringType()) for name in "xy"])

    def read(name, text):
        (tmp_path / name).write_text(text)
        return csv_records.read_csv(spark, str(tmp_path / name), schema).collect()

    assert read("empty.csv", "") == []
    assert read("header.csv", "x,y\n") == []
    assert read("blank.csv", "x,y\n\n  \n1,2\n\n") == [("1", "2")]
    assert read("open.csv", 'x,y\n1,"2\n') != []  # a field that never ends
    with pytest.raises(Exception, match="header does not name"):
        read("other.csv", "x,z\n1,2\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        read("short.csv", "x,y\n1\n")


@pytest.mark.parametrize("options", [{}, {"multi_line": False}, {"whole_files": True}])
def test_dropped_records_are_counted(spark, tmp_path, options):
    lines = ["reviewerID,asin,overall", "u,p,3", "u,p", "u,q,5,6", "v,p,1", "v,p,1", ",p,2"]
    (tmp_path / "raw.csv").write_text("\n".join(lines))
    audit = jobs.clean_job(
        spark, str(tmp_path / "raw.csv"), str(tmp_path / "out"), on_malformed="drop", **options)
    assert audit.malformed_rows == 2
    assert (audit.raw_rows, audit.complete_rows, audit.final_rows) == (4, 3, 2)
