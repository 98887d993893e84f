import pytest
from pyspark.sql import functions as F

from shelfwise.operators import clean
from shelfwise.sources.reviews import blank_to_null, read_raw_reviews


def raw(spark, rows, names="reviewerID string, asin string, overall string"):
    return blank_to_null(spark.createDataFrame(rows, names))


def triples(df):
    return sorted(tuple(r) for r in df.collect())


def test_copies_are_judged_after_typing(spark):
    df = raw(spark, [("A", "p", "5.0"), ("A", "p", "5"), ("A", "p", "1.0")])
    assert triples(clean.clean_reviews(df)) == [("A", "p", 1.0), ("A", "p", 5.0)]


def test_missing_text_in_other_columns_is_kept(spark):
    df = raw(
        spark, [("A", "p", "5", None)],
        "reviewerID string, asin string, overall string, reviewText string",
    )
    assert triples(clean.clean_reviews(df)) == [("A", "p", 5.0)]


@pytest.mark.parametrize("token", ["NA", "", "NaN", "null", "None", "#N/A"])
def test_missing_value_texts_drop_the_row(spark, token):
    df = raw(spark, [(token, "p", "5"), ("A", token, "5"), ("A", "p", token)])
    assert clean.clean_reviews(df).count() == 0
    audit = clean.cleaning_audit(df).first()
    assert (audit.raw_rows, audit.complete_rows, audit.removed_rows) == (3, 0, 3 - 0)


def test_other_token_sets(spark):
    df = spark.createDataFrame([("NA", "p", "5")], "user_id string, product_id string, rating string")
    assert clean.clean_reviews(blank_to_null(df, na_tokens=("",))).count() == 1


def test_range_has_both_ends(spark):
    values = ["0.99", "1.0", "5.0", "5.01", "NaN"]
    df = raw(spark, [(f"u{i}", "p", v) for i, v in enumerate(values)])
    assert triples(clean.clean_reviews(df)) == [("u1", "p", 1.0), ("u2", "p", 5.0)]


def test_nan_numbers_are_missing(spark):
    df = spark.createDataFrame(
        [("A", "p", float("nan")), ("B", "p", 2.0)],
        "user_id string, product_id string, rating double",
    )
    assert triples(clean.clean_reviews(df)) == [("B", "p", 2.0)]
    assert clean.cleaning_audit(df).first().complete_rows == 1


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_rating_fails_or_is_dropped(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        check_bad_rating(spark)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def check_bad_rating(spark):
    df = raw(spark, [("A", "p", "abc"), ("B", "p", "4")])
    with pytest.raises(Exception, match="abc"):
        clean.clean_reviews(df).collect()
    assert triples(clean.clean_reviews(df, "drop")) == [("B", "p", 4.0)]
    with pytest.raises(ValueError):
        clean.clean_reviews(df, "ignore")


@pytest.mark.parametrize("text", ["5d", "4.f", "0x1p1", " 3F "])
def test_numbers_of_another_language_are_bad(spark, text):
    df = raw(spark, [("A", "p", text), ("B", "p", " 4e0 "), ("C", "p", "inf")])
    with pytest.raises(Exception, match="is no number"):
        clean.clean_reviews(df).collect()
    assert triples(clean.clean_reviews(df, "drop")) == [("B", "p", 4.0)]


def test_bad_rating_beside_a_missing_id_is_no_error(spark):
    df = raw(spark, [(None, "p", "abc"), ("B", "p", "4")])
    assert clean.clean_reviews(df).count() == 1
    assert clean.cleaning_audit(df).first().final_rows == 1


def test_both_layouts_and_a_missing_column(spark):
    ours = spark.createDataFrame([("A", "p", 3.0, 1)], "user_id string, product_id string, rating double, x int")
    assert clean.clean_reviews(ours).columns == ["user_id", "product_id", "rating"]
    with pytest.raises(Exception, match="rating"):
        clean.clean_reviews(ours.drop("rating"))


def test_audit_equals_the_steps(spark):
    rows = [("A", "p", "5")] * 50 + [("A", "p", "9")] * 3 + [(None, "p", "5")] * 40
    audit = clean.cleaning_audit(raw(spark, rows)).first().asDict()
    assert audit == {
        "raw_rows": 93, "complete_rows": 53, "distinct_rows": 2, "final_rows": 1,
        "removed_rows": 91,
    }


def test_audit_of_nothing_is_zero(spark):
    assert set(clean.cleaning_audit(raw(spark, [])).first()) == {0}


def test_csv_keeps_zeros_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "r.csv").write_text(
        'asin,reviewerID,reviewText,overall\n'
        '0001234567,00042,"two\nlines, ""quoted""",5.0\n'
        'NA,00043,x,5.0\n'
        '0001234568,00044,,4\n'
    )
    df = read_raw_reviews(spark, str(tmp_path))
    assert triples(clean.clean_reviews(df)) == [
        ("00042", "0001234567", 5.0), ("00044", "0001234568", 4.0),
    ]
    text = df.filter(F.col("reviewerID") == "00042").first().reviewText
    assert text == 'two\nlines, "quoted"'


def test_scan_reads_only_needed_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame(
        [("A", "p", 5.0, "long text")],
        "reviewerID string, asin string, overall double, reviewText string",
    ).write.parquet(path)
    plan = clean.clean_reviews(spark.read.parquet(path))._jdf.queryExecution().toString()
    assert "reviewText" not in plan.split("ReadSchema")[1]
    for pushed in ("IsNotNull(reviewerID)", "IsNotNull(asin)", "GreaterThanOrEqual(overall,1.0)"):
        assert pushed in plan
