"""The first stored answer of each user, kept as a table beside the log.

The log grows with every batch; what a fallback needs is one answer a user. So there is a base
and one small delta a batch, which holds only users whose first answer the batch has. Both are laid
out in folders by a hash of the user and sorted by user within them, so a lookup reads the folders its
users can be in, and of those the row groups. Deltas are folded into a new base now and then; a
pointer row names the base in use and the deltas it holds, so readers see either the old base or
the new one. A batch owns its delta and replaces it when it is repeated.
"""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.schemas import STORED_ANSWERS
from shelfwise.session import (
    claimed_number, delete_path, folders_in, materialize, path_exists,
)

SLOTS = 64
FOLD_AFTER = 8
FEW_USERS = 100  # whose ids go into the filter that the files are read with
BROADCAST_USERS = 500_000
CONTENT = "struct<timestamp:string,recommendations:array<struct<product_id:int,score:double>>>"
TABLE = f"user_id bigint, stored {CONTENT}, slot int"
POINTER = "generation int, base string, slots int, folded array<string>"


def earliest(answers: DataFrame) -> DataFrame:
    """``user_id`` and ``stored``: the earliest answer, equal times by content."""
    content = F.struct("timestamp", "recommendations")
    return answers.groupBy("user_id").agg(F.min(content).cast(CONTENT).alias("stored"))


def _merged(firsts: list[DataFrame]) -> DataFrame:
    rows = reduce(DataFrame.unionByName, [df.select("user_id", "stored") for df in firsts])
    return rows.groupBy("user_id").agg(F.min("stored").alias("stored"))


class FirstAnswers:
    """The table below ``root``. ``but_batch`` leaves out what that batch has added, for when it is
    answered again."""

    def __init__(self, spark: SparkSession, root: str, but_batch: str | None = None):
        self.spark, self.root, self.but_batch = spark, root, but_batch

    def start(
        self, answers: Callable[[], DataFrame | None] = lambda: None, slots: int = SLOTS,
    ) -> "FirstAnswers":
        """Make the first base, of the stored ``answers`` if there are some, unless there is one."""
        if not path_exists(self.spark, f"{self.root}/pointer"):
            rows = answers()
            if rows is None:
                rows = self.spark.createDataFrame([], STORED_ANSWERS)
            self._new_base(earliest(rows), slots, [])
        return self

    def pointer(self):
        rows = self.spark.read.schema(POINTER).parquet(f"{self.root}/pointer")
        return rows.orderBy(F.desc("generation")).first()  # a row a fold

    def deltas(self, pointer) -> list[str]:
        """Batches with a whole delta that the base does not hold."""
        return [name for name in folders_in(self.spark, f"{self.root}/delta")
                if name not in pointer.folded and name != self.but_batch
                and path_exists(self.spark, f"{self.root}/delta/{name}/_SUCCESS")]

    def tables(self, pointer) -> list[DataFrame]:
        """The base and the deltas beyond it, fewer than two folds' worth."""
        paths = [pointer.base, *(f"{self.root}/delta/{name}" for name in self.deltas(pointer))]
        return [self.spark.read.schema(TABLE).parquet(path) for path in paths]

    def of(self, users: DataFrame, n_users: int) -> DataFrame:
        """``user_id`` and ``stored`` of the given users, who should be a written table.

        There are at most ``slots`` folders, so the list of those needed is bounded; a bounded
        number of users is broadcast, and the ids of a few reach the files' own statistics.
        """
        pointer, users = self.pointer(), users.select("user_id")
        needed = users.select(_slot(pointer.slots)).distinct().collect()
        wanted = F.col("slot").isin([row.slot for row in needed])
        if n_users <= FEW_USERS:
            wanted &= F.col("user_id").isin([row.user_id for row in users.collect()])
        elif n_users <= BROADCAST_USERS:
            users = F.broadcast(users)
        return _merged([table.where(wanted).join(users, "user_id", "left_semi")
                        for table in self.tables(pointer)])

    def all(self) -> DataFrame:
        return _merged(self.tables(self.pointer()))

    def add(self, batch: str, answers: DataFrame) -> None:
        """Add a batch's answers: those of users who have none yet, or a later one. A repeated
        batch replaces what it added before."""
        new = materialize(earliest(answers), "first-answers")
        earlier = FirstAnswers(self.spark, self.root, batch)
        known = earlier.of(new, new.count()).withColumnRenamed("stored", "known")
        first = new.join(known, "user_id", "left").where("known IS NULL OR stored < known")
        pointer = self.pointer()
        name = f"{batch}~{pointer.generation}" if batch in pointer.folded else batch
        _write(first.select("user_id", "stored"), f"{self.root}/delta/{name}", pointer.slots)
        if len(earlier.deltas(pointer)) >= FOLD_AFTER:
            earlier.fold()

    def fold(self) -> None:
        """Make a new base of the base and its deltas. The deltas it holds are deleted, like the
        base before, by the next fold, when readers of the old pointer are done."""
        pointer = self.pointer()
        deltas = self.deltas(pointer)
        self._new_base(_merged(self.tables(pointer)), pointer.slots, deltas)
        for name in pointer.folded:
            delete_path(self.spark, f"{self.root}/delta/{name}")
        for name in folders_in(self.spark, f"{self.root}/base"):
            if int(name) < pointer.generation:
                delete_path(self.spark, f"{self.root}/base/{name}")

    def _new_base(self, firsts: DataFrame, slots: int, folded: list[str]) -> None:
        generation = claimed_number(self.spark, f"{self.root}/claims")
        base = f"{self.root}/base/{generation}"
        _write(firsts, base, slots)
        row = self.spark.createDataFrame([(generation, base, slots, folded)], POINTER)
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/pointer")


def _slot(slots: int):
    return F.pmod(F.xxhash64("user_id"), F.lit(slots)).cast("int").alias("slot")


def _write(firsts: DataFrame, path: str, slots: int) -> None:
    rows = firsts.select("*", _slot(slots)).repartition("slot")
    rows.sortWithinPartitions("slot", "user_id").write.mode("overwrite").partitionBy(
        "slot").parquet(path)
