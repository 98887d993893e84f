"""Line dedup across documents, by range-partitioned hashes and keep bitmaps.

Lines are hashed (128 bits of their key), range-partitioned by hash, document and position, and
sorted so within the partitions. One pass over each sorted run then keeps what the first document
holds and reports every later line; a hash that a third of all lines have is cut by document, so
it spans several partitions and no task gets all of it. Whether a partition's first run began in
an earlier one is settled from one row a partition. Nothing but positions leaves the pass: the
result is a compressed bitmap of the lines to keep for each document that loses any, which
``apply`` lays over the texts.

Cases: null and empty texts have one empty line, which is kept; rows that share a ``doc_id`` are
one document when holders are counted, and each is judged by itself; documents without an id
count as one that comes after all others; an empty table gives an empty result; a document that
loses all lines is left with an empty text; other columns are kept by ``apply``.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.batches import small
from shelfwise.llm.tables import fingerprint, line_key
from shelfwise.session import materialize

LAST_ID = (1 << 63) - 1  # stands for a missing id
ORDER = ["k1", "k2", "doc", "a", "b", "pos"]
FOUND = ("part int, sure boolean, doc long, a long, b long, pos int, n_lines int,"
         " first1 long, first2 long, first_doc long, last1 long, last2 long, last_doc long,"
         " one_run boolean")


def document_keys():
    print_ = fingerprint(F.col("text"))
    return (F.coalesce(F.col("doc_id"), F.lit(LAST_ID)).cast("long").alias("doc"),
            print_["a"].alias("a"), print_["b"].alias("b"))


def hashed_lines(documents: DataFrame, min_chars: int) -> DataFrame:
    lines = F.split(F.coalesce(F.col("text"), F.lit("")), "\n")
    rows = documents.select(*document_keys(), lines.alias("lines")).select(
        "doc", "a", "b", F.size("lines").alias("n_lines"),
        F.posexplode("lines").alias("pos", "line"))
    rows = rows.select("*", line_key(F.col("line")).alias("key"))
    return rows.where(F.length("key") >= min_chars).select(
        F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(1), "key").alias("k2"),
        "doc", "a", "b", "pos", "n_lines")


def later_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of a sorted partition that an earlier document holds, and one row on its ends.

    In the partition's first run the lines of its first document are reported as unsure."""
    part = TaskContext.get().partitionId()
    first = last = None  # (k1, k2, document) of the first and of the current run
    one_run = True
    for batch in batches:
        if not batch.num_rows:
            continue
        k1, k2, doc = (batch.column(i).to_numpy() for i in range(3))
        begins = np.empty(len(k1), bool)
        begins[0] = last is None or (k1[0], k2[0]) != last[:2]
        begins[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
        heads = np.flatnonzero(begins)
        if first is None:
            first = (k1[0], k2[0], doc[0])
            opening = np.cumsum(begins) == 1
        else:
            opening = (np.cumsum(begins) == 0) & one_run
        holders = np.concatenate([[last[2] if last else 0], doc[heads]])
        holder = holders[np.cumsum(begins)]
        later = doc != holder
        one_run = one_run and bool(opening.all())
        if len(heads):
            at = heads[-1]
            last = (k1[at], k2[at], doc[at])
        keep = np.flatnonzero(later | opening)
        if len(keep):
            rows = batch.take(pa.array(keep))
            n = len(keep)
            blank = pa.nulls(n, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part, np.int32)), pa.array(later[keep]),
                 *rows.columns[2:7], *[blank] * 6, pa.nulls(n, pa.bool_())], names=_NAMES)
    if first is not None:
        none = pa.nulls(1, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([False]), none, none, none,
             pa.nulls(1, pa.int32()), pa.nulls(1, pa.int32()),
             *(pa.array([int(x)]) for x in (*first, *last)), pa.array([one_run])], names=_NAMES)


_NAMES = [column.split()[0] for column in FOUND.split(",")]


def continued_parts(ends) -> list[int]:
    """Partitions whose first document is not the first holder of the run they open with. There
    is one row a partition, in order."""
    parts, run = [], None
    for row in ends:
        opened = run is not None and run[:2] == (row.first1, row.first2)
        if opened and run[2] != row.first_doc:
            parts.append(row.part)
        if not (opened and row.one_run):
            run = (row.last1, row.last2, row.last_doc)
    return parts


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Positions to drop as a compressed bitmap of the lines to keep."""
    for batch in batches:
        bitmaps, counts = [], []
        for drop, n in zip(batch.column(4), batch.column(3).to_numpy()):
            keep = np.ones(n, np.uint8)
            keep[drop.values.to_numpy()] = 0
            counts.append(int(n - keep.sum()))
            bitmaps.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes(), 1))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:4], pa.array(counts, pa.int32()), pa.array(bitmaps, pa.binary())],
            names=["doc", "a", "b", "n_lines", "n_dropped", "keep"])


def keep_bitmaps(documents: DataFrame, min_chars=10) -> DataFrame:
    """For each document that loses lines: how many it has, how many go, and the bitmap."""
    lines = hashed_lines(documents, min_chars)
    dealt = lines.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    found = materialize(dealt.mapInArrow(later_lines, FOUND), "later-lines")
    ends = found.where("pos IS NULL").orderBy("part").collect()  # one row a partition
    drop = F.col("sure")
    if parts := continued_parts(ends):
        drop = drop | F.col("part").isin(parts)
    dropped = found.where(F.col("pos").isNotNull() & drop).groupBy("doc", "a", "b").agg(
        F.max("n_lines").alias("n_lines"), F.collect_list("pos").alias("drop"))
    return dropped.mapInArrow(
        packed, "doc long, a long, b long, n_lines int, n_dropped int, keep binary")


def laid_over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        texts, keeps = batch.column("text"), batch.column("keep")
        kept = []
        for text, keep in zip(texts, keeps):
            if not keep.is_valid:
                kept.append(text.as_py())
                continue
            lines = text.as_py().split("\n")
            bits = np.unpackbits(np.frombuffer(zlib.decompress(keep.as_py()), np.uint8),
                                 count=len(lines), bitorder="little")
            kept.append("\n".join([lines[i] for i in np.flatnonzero(bits)]))
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, "text", pa.array(kept, texts.type))


def apply(documents: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The documents with the lines their bitmaps keep: ``row`` holds all columns as they were,
    ``text`` the new text (null stays null), ``n_lines`` and ``n_dropped`` the counts before."""
    own = F.struct(*(F.col(f"`{name}`") for name in documents.columns if name != "text"))
    rows = documents.select(own.alias("row"), "text", *document_keys(), F.size(
        F.split(F.coalesce(F.col("text"), F.lit("")), "\n")).alias("lines"))
    marks = bitmaps.select("doc", "a", "b", "n_dropped", "keep").hint("shuffle_hash")
    joined = rows.join(marks, ["doc", "a", "b"], "left").select(
        "row", "text", "lines", F.coalesce("n_dropped", F.lit(0)).alias("n_dropped"), "keep")
    return joined.mapInArrow(laid_over, joined.schema).drop("keep")


def dedup(documents: DataFrame, min_chars=10) -> DataFrame:
    """The documents without repeated lines; ``n_chars`` is counted anew where lines went."""
    rows = apply(documents, keep_bitmaps(documents, min_chars))

    def column(name):
        if name == "text":
            return F.col("text")
        old = F.col("row").getField(name)
        if name == "n_chars":
            return F.when(F.col("n_dropped") == 0, old).otherwise(
                F.length("text").cast(documents.schema[name].dataType)).alias(name)
        return old.alias(name)

    return rows.select(*(column(name) for name in documents.columns))
