"""Several tables that appear together.

Every run writes into a folder of its own; a row in the manifest names the folder and each table's
number of rows once all of them are written. Readers take the last row, so they see all tables of
one run, or all of the one before, never a mixture.
"""

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.session import claimed_number, delete_path, folders_in, path_exists, together

MANIFEST = "run int, path string, rows map<string,bigint>, written_at timestamp"


def export(
    spark: SparkSession, root: str, writers: dict[str, Callable[[str], int]], keep: int = 2,
) -> int:
    """Write every table to the path its writer is given, then name them all in the manifest;
    the writers return numbers of rows. If one fails, the run does not exist, and the next one
    deletes what it left, like runs beyond the last ``keep``."""
    before = runs(spark, root)
    run = claimed_number(spark, f"{root}/claims", max(before, default=0))
    path = f"{root}/run={run}-{uuid4().hex}"
    counts = together(spark, *(
        lambda name=name, write=write: write(f"{path}/{name}") for name, write in writers.items()))
    row = (run, path, dict(zip(writers, counts)), None)
    spark.createDataFrame([row], MANIFEST).withColumn(
        "written_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(
        f"{root}/manifest")
    kept = {*sorted([*before, run])[-keep:]}
    for name in folders_in(spark, root):
        number = name.removeprefix("run=").split("-")[0]
        if name.startswith("run=") and int(number) < run and int(number) not in kept:
            delete_path(spark, f"{root}/{name}")
    return run


def _manifest(spark: SparkSession, root: str) -> DataFrame:
    if not path_exists(spark, f"{root}/manifest"):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifest")


def runs(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the whole runs; a row a run."""
    return sorted(row.run for row in _manifest(spark, root).select("run").collect())


def exported(spark: SparkSession, root: str):
    """The last whole run: its ``run``, ``path`` and ``rows`` of each table."""
    last = _manifest(spark, root).orderBy(F.desc("run")).first()
    if last is None:
        raise FileNotFoundError(f"nothing is exported to {root}")
    return last
