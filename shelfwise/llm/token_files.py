"""Token ids of all documents as range-coded files, and their reader.

Texts become ids once and are kept in the shared folder, with one row a task that counts its ids.
These vectors are summed to one table of frequencies for the whole corpus, which is bounded by
the vocabulary. The documents are then range-partitioned and sorted by id, and every partition
writes its ids as a row of independent blocks (``rans``). Blocks are rows of a Parquet table, so Spark commits them
whole and reads them in parallel; each also has the ids and lengths of the documents that begin
in it. The reader decodes blocks in any order, checks them, and joins documents that span blocks
by their checksums.

Cases: null and empty texts have the end id only; documents without an id come first; equal ids
are ordered by text; an empty table gives empty files; other columns play no part.
"""

import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwise.llm import rans
from shelfwise.llm.batches import small
from shelfwise.llm.token_ids import default_path, encoder
from shelfwise.session import materialize, scratch_path

IDS = 1 << 16
SUMMERS = 64


def encoded(batches: Iterator[pa.RecordBatch], path: str, end: int) -> Iterator[pa.RecordBatch]:
    tail = np.array([end], np.uint16)
    for batch in small(batches, 2000):
        texts = [text or "" for text in batch.column(2).to_pylist()]
        ids = [np.concatenate([x, tail]).tobytes() for x in encoder(path).encode(texts)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(ids, pa.binary())],
            names=["doc_id", "tie", "ids"])
        del texts, ids
    pa.default_memory_pool().release_unused()  # workers stay, and other tasks need the room


def document_ids(documents: DataFrame, end: int, path: str | None = None) -> DataFrame:
    """``doc_id``, a tie-break from the text, and the text's ids with ``end`` as 16-bit bytes."""
    return _ids(documents, partial(encoded, path=path or default_path(), end=end))


def ids_and_counts(documents: DataFrame, end: int, path: str | None = None) -> DataFrame:
    """:func:`document_ids` with a column ``counts``, which only one more row a task has."""
    path = path or default_path()
    return _ids(documents, lambda batches: counted(encoded(batches, path, end)), ", counts binary")


def _ids(documents, function, more=""):
    rows = documents.select("doc_id", F.xxhash64("text").alias("tie"), "text")
    kind = documents.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(function, f"doc_id {kind}, tie long, ids binary{more}")


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, and a last one with how often each id occurs in them."""
    total = np.zeros(IDS, np.int64)
    schema = None
    for batch in batches:
        schema = batch.schema
        ids = batch.column(2)
        first, last = ids.offset, ids.offset + len(ids)
        places = np.frombuffer(ids.buffers()[1], np.int32)[[first, last]]
        total += np.bincount(np.frombuffer(ids.buffers()[2], "<u2")[places[0] // 2:places[1] // 2],
                             minlength=IDS)
        nothing = pa.nulls(len(ids), pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns, nothing], names=[*schema.names, "counts"])
    if schema:
        counts = pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())
        yield pa.RecordBatch.from_arrays([*(pa.nulls(1, field.type) for field in schema), counts],
                                         names=[*schema.names, "counts"])


def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(IDS, np.int64)
    for batch in batches:
        for counts in batch.column(0):
            total += np.frombuffer(zlib.decompress(counts.as_py()), np.int64)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["id", "n"])


def frequencies(rows: DataFrame) -> DataFrame:
    """How often each id occurs in the whole corpus, from the written :func:`ids_and_counts`."""
    parts = rows.where("counts IS NOT NULL").select("counts")
    sums = parts.repartition(SUMMERS).mapInArrow(summed, "id int, n long")
    return sums.groupBy("id").agg(F.sum("n").alias("n"))


def shared_counts(spark: SparkSession, path: str):
    """The written counts as a broadcast vector: 512 KiB whatever the corpus."""
    counts = np.zeros(IDS, np.int64)
    for row in spark.read.parquet(path).collect():  # one row an id of the vocabulary
        counts[row.id] = row.n
    return spark.sparkContext.broadcast(counts.tobytes())


BLOCKS = ("part int, block int, start long, n_ids int, open_start long, doc_ids array<{kind}>,"
          " doc_starts array<long>, doc_lengths array<long>, payload binary")


def block_rows(batches: Iterator[pa.RecordBatch], counts, id_type) -> Iterator[pa.RecordBatch]:
    """The sorted documents of a partition as blocks of at most ``rans.BLOCK`` ids."""
    table = _table(counts)
    part = TaskContext.get().partitionId()
    block, start, held, waiting = 0, 0, 0, []
    ids_, starts, lengths = [], [], []
    open_start, at = None, 0  # of the document that runs into the block; place in the partition

    def flush():
        ids = np.concatenate(waiting) if waiting else np.empty(0, np.uint16)
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([start]),
             pa.array([len(ids)], pa.int32()), pa.array([open_start], pa.int64()),
             pa.array([ids_], pa.list_(id_type)), pa.array([starts], pa.list_(pa.int64())),
             pa.array([lengths], pa.list_(pa.int64())),
             pa.array([rans.encode_block(ids, table)], pa.binary())],
            names=["part", "block", "start", "n_ids", "open_start", "doc_ids", "doc_starts",
                   "doc_lengths", "payload"])

    for batch in batches:
        for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(2)):
            ids = np.frombuffer(ids.as_buffer(), "<u2")
            ids_.append(doc_id)
            starts.append(at)
            lengths.append(len(ids))
            done = 0
            while done < len(ids):
                some = ids[done:done + rans.BLOCK - held].copy()
                waiting.append(some)
                held += len(some)
                done += len(some)
                if held == rans.BLOCK:
                    yield flush()
                    block, start, held, waiting = block + 1, start + held, 0, []
                    ids_, starts, lengths = [], [], []
                    open_start = at if done < len(ids) else None
            at += len(ids)
    if held:
        yield flush()


@lru_cache(2)
def _cached_table(counts: bytes) -> rans.Table:
    return rans.Table(np.frombuffer(counts, np.int64))


def _table(counts) -> rans.Table:
    return _cached_table(counts.value)


def write_files(documents: DataFrame, path: str, end=2, tokenizer: str | None = None) -> None:
    """Write ``path/table`` (the shared frequencies) and ``path/blocks``."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = documents.sparkSession
    written = materialize(ids_and_counts(documents, end, tokenizer), "token-ids")
    frequencies(written).write.parquet(f"{path}/table")
    ids = written.where("ids IS NOT NULL").drop("counts")
    shared = shared_counts(spark, f"{path}/table")
    kind = documents.schema["doc_id"].dataType
    rows = ids.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "ids")
    rows.mapInArrow(
        partial(block_rows, counts=shared, id_type=to_arrow_type(kind)),
        BLOCKS.format(kind=kind.simpleString()),
    ).write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def pieces(batches: Iterator[pa.RecordBatch], counts, id_type) -> Iterator[pa.RecordBatch]:
    """What each block has of each document: place, length and checksum of 32-bit ids."""
    table = _table(counts)
    for batch in batches:
        for row in batch.to_pylist():
            ids = rans.decode_block(row["payload"], table).astype("<u4")
            start, end = row["start"], row["start"] + row["n_ids"]
            docs = list(zip(row["doc_starts"], row["doc_lengths"], row["doc_ids"]))
            if row["open_start"] is not None:
                until = row["doc_starts"][0] if docs else end
                docs.insert(0, (row["open_start"], until - row["open_start"], None))
            out = []
            for doc_start, length, doc_id in docs:
                some = ids[max(doc_start, start) - start:min(doc_start + length, end) - start]
                out.append((row["part"], doc_start, max(doc_start, start), len(some),
                            zlib.crc32(some.tobytes()), doc_id))
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[1:5]),
                 pa.array(columns[5], id_type)],
                names=["part", "doc_start", "place", "length", "crc", "doc_id"])


def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sums = []
        for parts in batch.column("parts").to_pylist():
            total, *rest = sorted((p["place"], p["length"], p["crc"]) for p in parts)
            crc = total[2]
            for _, length, other in rest:
                crc = rans.crc32_joined(crc, other, 4 * length)
            sums.append(crc)
        at = batch.schema.get_field_index("parts")
        yield batch.set_column(at, "ids_crc32", pa.array(sums, pa.int64()))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Documents as the files have them: ``doc_id, start, n_tokens, ids_crc32``."""
    from pyspark.sql.pandas.types import to_arrow_type

    shared = shared_counts(spark, f"{path}/table")
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["doc_ids"].dataType.elementType
    found = blocks.mapInArrow(
        partial(pieces, counts=shared, id_type=to_arrow_type(kind)),
        "part int, doc_start long, place long, length long, crc long,"
        f" doc_id {kind.simpleString()}")
    docs = found.groupBy("part", "doc_start").agg(
        F.max("doc_id").alias("doc_id"), F.sum("length").alias("n_tokens"),
        F.collect_list(F.struct("place", "length", "crc")).alias("parts"))
    docs = docs.mapInArrow(
        joined, f"part int, doc_start long, doc_id {kind.simpleString()}, n_tokens long,"
        " ids_crc32 long")
    # One row a partition.
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    bases = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    return docs.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("doc_start")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(documents: DataFrame, end=2) -> DataFrame:
    """Write the files into the shared folder and read them back."""
    path = scratch_path(documents.sparkSession, "token-files")
    write_files(documents, path, end)
    return read_files(documents.sparkSession, path)
