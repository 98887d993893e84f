"""Session settings and the shared scratch folder."""

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}

# Shuffled bytes a byte of stored input may become, and what one task should read of them.
EXPANSION = 4
SHUFFLE_BYTES = 128 << 20
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

_LOCAL_ROOTS: dict[str, str] = {}
_JOB_FOLDER: ContextVar[str | None] = ContextVar("job_folder", default=None)


def build_session(app_name="shelfwise", master=None, **settings):
    """A session with the settings the jobs rely on; memory and cores are for spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without it: it gets a temporary folder of its own. On a
    cluster such a folder would not be visible to the other machines, so there it fails.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="shelfwise-")
    return _LOCAL_ROOTS[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used before."""
    parent = _JOB_FOLDER.get() or f"{scratch_root(spark)}/shelfwise"
    return f"{parent}/{name}-{uuid.uuid4().hex}"


@contextmanager
def job_folder(spark: SparkSession):
    """Keep the scratch tables of one job together and delete them when it is done. The job
    must have written its results elsewhere by then."""
    path = scratch_path(spark, "job")
    token = _JOB_FOLDER.set(path)
    try:
        yield path
    finally:
        _JOB_FOLDER.reset(token)
        delete_path(spark, path)


@contextmanager
def sized_shuffles(spark: SparkSession, path: str):
    """Start shuffles with as many partitions as the input may need. Adaptive execution joins
    small ones again but cannot split large ones, so the default would not do for terabytes."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    matches = files.globStatus(folder) or []
    size = sum(files.getContentSummary(match.getPath()).getLength() for match in matches)
    needed = size * EXPANSION // SHUFFLE_BYTES
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    if needed > int(before or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(INITIAL_PARTITIONS, str(needed))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(INITIAL_PARTITIONS)
        else:
            spark.conf.set(INITIAL_PARTITIONS, before)


def use_checkpoints(spark: SparkSession) -> None:
    """Let iterative jobs cut their lineage in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{scratch_root(spark)}/checkpoints")


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so later steps start from files."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def together(spark: SparkSession, *actions):
    """Run independent Spark actions at the same time, so that the short tail of one does not
    keep the other's tasks waiting; returns their results in order."""
    with ThreadPoolExecutor(len(actions)) as pool:
        jobs = [
            pool.submit(copy_context().run, inheritable_thread_target(spark)(action))
            for action in actions
        ]
        return [job.result() for job in jobs]


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder on whatever file system its URI names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def _listed(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.listStatus(hadoop_path) if files.exists(hadoop_path) else []


def folders_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``; none if it does not exist."""
    return sorted(f.getPath().getName() for f in _listed(spark, path) if f.isDirectory())


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly below ``path``; none if it does not exist."""
    return sorted(f.getPath().getName() for f in _listed(spark, path) if f.isFile())


def touch(spark: SparkSession, path: str) -> None:
    """Make an empty file."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).create(hadoop_path).close()


def claimed_number(spark: SparkSession, path: str, after: int = 0) -> int:
    """A number above ``after`` that nobody else gets: whoever creates its file below ``path`` has
    it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    while True:
        after += 1
        if files.createNewFile(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{after}")):
            return after
