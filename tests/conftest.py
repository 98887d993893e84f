import pytest

from shelfwise.session import build_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8,4]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
