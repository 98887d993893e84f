"""A record of a raw CSV file is parsed once, whatever filters follow."""

from shelfwise.operators import clean
from shelfwise.sources.reviews import read_raw_reviews


def test_filters_do_not_parse_again(spark, tmp_path):
    path = str(tmp_path / "raw.csv")
    with open(path, "w") as file:
        file.write('reviewerID,asin,overall,reviewText\na,p,3.0,"x\ny"\na,p,3,z\n,p,3,\nb,q,7,\n')
    ratings = clean.clean_reviews(read_raw_reviews(spark, path))
    assert [tuple(row) for row in ratings.collect()] == [("a", "p", 3.0)]
    plan = ratings._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("FAILFAST") == 1
