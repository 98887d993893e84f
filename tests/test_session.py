from types import SimpleNamespace

import pytest

from shelfwise.session import SETTINGS, scratch_path, scratch_root, together


def fake(master, folder=None):
    conf = SimpleNamespace(get=lambda key, default: folder)
    return SimpleNamespace(
        conf=conf, sparkContext=SimpleNamespace(master=master, applicationId=master)
    )


def test_named_folder_is_used():
    assert scratch_root(fake("spark://host:1", "hdfs://x/shared/")) == "hdfs://x/shared"


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(fake("spark://host:1"))


def test_local_session_gets_one_folder():
    session = fake("local[2]")
    assert scratch_root(session) == scratch_root(session)


def test_paths_are_new_each_time(spark):
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_web_page_is_off_and_adaptive_execution_on(spark):
    assert spark.sparkContext.uiWebUrl is None
    for key, value in SETTINGS.items():
        assert spark.conf.get(key) == value


def test_results_keep_their_order(spark):
    counts = together(spark, *[lambda n=n: spark.range(n).count() for n in (5, 3, 9)])
    assert counts == [5, 3, 9]


def test_errors_are_passed_on(spark):
    with pytest.raises(ZeroDivisionError):
        together(spark, lambda: 1 / 0, lambda: spark.range(3).count())
