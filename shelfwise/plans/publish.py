"""Model, id maps and lists published together under one version number.

A version is complete before a row in the ``current`` table names it, so readers see the
old version until the new one is whole, and never none.
"""

import time
from contextlib import contextmanager
from dataclasses import dataclass
from uuid import uuid4

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shelfwise.operators.factorize import load_model, save_model
from shelfwise.schemas import PRODUCT_MAP, RECOMMENDATIONS, USER_MAP
from shelfwise.session import claimed_number, delete_path, names_in, path_exists, touch

CURRENT = (
    "version int, path string, published_at timestamp, test_rows bigint, "
    "predicted_rows bigint, rmse double, settings map<string,string>"
)
KEEP = 2
LEASE = 3600  # seconds


@dataclass(frozen=True)
class Published:
    """One version, read back."""

    version: int
    model: ALSModel
    user_map: DataFrame
    product_map: DataFrame


def versions(spark: SparkSession, root: str) -> DataFrame:
    """All published versions, one small row each."""
    if not path_exists(spark, f"{root}/current"):
        return spark.createDataFrame([], CURRENT)
    return spark.read.schema(CURRENT).parquet(f"{root}/current")


def current_version(spark: SparkSession, root: str) -> int:
    """The version in use, 0 if there is none."""
    return versions(spark, root).agg(F.max("version")).first()[0] or 0


def publish(
    spark: SparkSession, root: str, model: ALSModel, user_map: DataFrame,
    product_map: DataFrame, *, recs: DataFrame | None = None, settings=None,
    test_rows=None, predicted_rows=None, rmse=None, keep: int = KEEP, min_age: float = 0,
) -> int:
    """Write a new version, make it the current one and drop all but the last ``keep``. None is
    dropped that a reader holds, or that was still the current one ``min_age`` seconds ago, so
    that jobs which loaded it can go on reading. Maps stay."""
    version = claimed_version(spark, root)
    path = f"{root}/version={version}"
    save_model(model, f"{path}/model")
    user_map.write.mode("overwrite").parquet(f"{root}/maps/version={version}/user_map")
    product_map.write.mode("overwrite").parquet(f"{root}/maps/version={version}/product_map")
    if recs is not None:
        recs.write.mode("overwrite").parquet(f"{path}/recommendations")
    row = (version, path, None, test_rows, predicted_rows, rmse, settings or {})
    spark.createDataFrame([row], CURRENT).withColumn(
        "published_at", F.current_timestamp()
    ).coalesce(1).write.mode("append").parquet(f"{root}/current")
    for retired in retired_versions(spark, root, version, keep, min_age):
        delete_path(spark, f"{root}/version={retired}")
        delete_path(spark, f"{root}/leases/{retired}")
    return version


def claimed_version(spark: SparkSession, root: str) -> int:
    """A version number that no other publisher gets: whoever creates its file has it."""
    return claimed_number(spark, f"{root}/claims", current_version(spark, root))


def retired_versions(spark, root, version, keep, min_age) -> list[int]:
    """Versions beyond the last ``keep`` that were replaced at least ``min_age`` seconds ago and
    still have files; one small row a version is read."""
    replaced = F.lead("published_at").over(Window.orderBy("version"))
    old = versions(spark, root).select("version", replaced.alias("replaced_at")).where(
        (F.col("version") <= version - keep)
        & (F.col("replaced_at") <= F.current_timestamp() - F.make_dt_interval(secs=F.lit(min_age)))
    )
    return [
        row.version for row in old.collect()
        if path_exists(spark, f"{root}/version={row.version}")
        and not is_held(spark, root, row.version)
    ]


def lease(spark: SparkSession, root: str, version: int, seconds: float) -> str:
    """Keep a version from being retired for so long; returns the lease, a file that names its end."""
    path = f"{root}/leases/{version}/{int(time.time() + seconds)}-{uuid4().hex}"
    touch(spark, path)
    return path


def is_held(spark: SparkSession, root: str, version: int) -> bool:
    """Whether a reader's lease of the version has not ended."""
    ends = (name.split("-")[0] for name in names_in(spark, f"{root}/leases/{version}"))
    return any(int(end) > time.time() for end in ends)


@contextmanager
def held(spark: SparkSession, root: str, seconds: float = LEASE):
    """The current version, which no publisher retires while the block runs, or for ``seconds`` if
    the reader dies. The lease is written before the files are looked for, so a version retired
    in between is seen to be gone, and the one after it is taken."""
    while True:
        version = current_version(spark, root)
        if not version:
            raise FileNotFoundError(f"nothing is published in {root}")
        path = lease(spark, root, version, seconds)
        if path_exists(spark, f"{root}/version={version}"):
            break
        delete_path(spark, path)
    try:
        yield load_published(spark, root, version)
    finally:
        delete_path(spark, path)


def kept_versions(spark: SparkSession, root: str) -> list[int]:
    """Versions whose files are still there: the current one and its backups."""
    return sorted(
        row.version for row in versions(spark, root).select("version").collect()
        if path_exists(spark, f"{root}/version={row.version}")
    )


def load_published(spark: SparkSession, root: str, version: int | None = None) -> Published:
    """The current version, or an earlier one that is kept."""
    version = version or current_version(spark, root)
    if not version:
        raise FileNotFoundError(f"nothing is published in {root}")
    path = f"{root}/version={version}"
    return Published(
        version,
        load_model(spark, f"{path}/model"),
        *read_maps(spark, root, version),
    )


def read_maps(spark: SparkSession, root: str, version: int) -> tuple[DataFrame, DataFrame]:
    """The maps of users and products of a version. They stay when it is retired, since answers it
    has given hold its integers."""
    path = f"{root}/maps/version={version}"
    return (spark.read.schema(USER_MAP).parquet(f"{path}/user_map"),
            spark.read.schema(PRODUCT_MAP).parquet(f"{path}/product_map"))


def published_recommendations(spark: SparkSession, root: str, version: int | None = None):
    version = version or current_version(spark, root)
    return spark.read.schema(RECOMMENDATIONS).parquet(f"{root}/version={version}/recommendations")


class CurrentModel:
    """The model in use. Asked again, it looks at the pointer, and loads a version
    only if it is another one than before. It holds the version it has by a lease, which it
    renews when half of it is over."""

    def __init__(self, spark: SparkSession, root: str, lease: float = LEASE):
        self.spark, self.root, self.seconds = spark, root, lease
        self.kept, self.renewed = None, 0.0

    def now(self):
        """Version and model."""
        version = current_version(self.spark, self.root)
        if self.kept is None or self.kept[0] != version:
            with held(self.spark, self.root, self.seconds) as published:
                lease(self.spark, self.root, published.version, self.seconds)
                self.renewed = time.time()
                self.kept = published.version, published.model
        elif time.time() > self.renewed + self.seconds / 2:
            lease(self.spark, self.root, version, self.seconds)
            self.renewed = time.time()
        return self.kept
