"""Records of CSV files whose quoted fields may hold line breaks, read in parallel.

Spark splits such a file only if it may cut at every line break. So tasks read lines, wherever
their part of the file lies, and the number of quotes before a line tells whether it begins within
a quoted field: an odd one does. The quotes of each part are counted first (one small row a part,
added up over a file in order), so a task knows how its part begins. It gives out the records that
lie in its part, and at most two pieces, of the records that cross its borders; only those are
shuffled and put together. The records are texts that Spark's own CSV parser reads.

A quote within a quoted field is written twice, which leaves the count even. A file with single quotes
in fields that are not quoted cannot be read so; it has to be read whole.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F
from pyspark.sql import types as T

from shelfwise.session import materialize

QUOTE = '"'
CORRUPT = "_corrupt_record"
PIECES = "file bigint, block bigint, first boolean, opens boolean, closes boolean, record string"


def file_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its file (as a hash of its name) and where the part it is in begins. Rows of
    a part come in the order of the file."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), "value",
    )


def odd_parts(lines: DataFrame) -> DataFrame:
    """The parts that begin within a quoted field."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE)))
    counts = lines.groupBy("file", "block").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    parts = counts.withColumn("before", F.coalesce(F.sum("quotes").over(before), F.lit(0)))
    return parts.where("before % 2 = 1").select("file", "block", F.lit(True).alias("within"))


def pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records, and the pieces of those that go on beyond a part's borders."""
    part, held, headless, first = None, [], False, False
    within = False
    for batch in batches:
        keys = np.stack([batch.column(name).to_numpy() for name in ("file", "block")], 1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        for begin, end in zip([0, *cuts], [*cuts, len(keys)]):
            if begin == end:
                continue
            lines = batch.slice(begin, end - begin)
            if part != tuple(keys[begin]):
                if part is not None and held:
                    yield records(part, pa.array(["\n".join(held)]), first, not headless, False)
                part, held = tuple(keys[begin].tolist()), []
                within = headless = lines.column("within")[0].as_py()
                first = part[1] == 0
            values = lines.column("value")
            odd = pc.count_substring(values, QUOTE).to_numpy().astype(np.int64) & 1
            after = (np.cumsum(odd) + within) & 1  # one where a line ends within a field
            within = bool(after[-1])
            starts = np.concatenate([[0], np.flatnonzero(after == 0) + 1])
            single = np.diff(starts) == 1  # lines that are records on their own
            if len(single) and (held or headless or first):
                single[0] = False
            many = np.flatnonzero(~single)
            texts = ["\n".join(values.slice(i, j - i).to_pylist())
                     for i, j in zip(starts[many].tolist(), starts[many + 1].tolist())]
            rest = values.slice(int(starts[-1])).to_pylist()
            if not len(single):
                held += rest
                continue
            if held:
                texts[0] = "\n".join([*held, texts[0]])
            held = rest
            order = np.argsort(np.concatenate([np.flatnonzero(single), many]))
            found = pa.concat_arrays([
                values.take(pa.array(starts[:-1][single])), pa.array(texts, values.type)])
            yield records(part, found.take(pa.array(order)), first, not headless, True)
            headless = first = False
    if part is not None and held:
        yield records(part, pa.array(["\n".join(held)]), first, not headless, False)


def records(part, values, first, opens, closes) -> pa.RecordBatch:
    """Records and pieces; ``first`` and ``opens`` are said of the first of them."""
    ahead = np.arange(len(values)) == 0
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(values), part[0], np.int64)),
         pa.array(np.full(len(values), part[1], np.int64)), pa.array(ahead & first),
         pa.array(~ahead | opens), pa.array(np.full(len(values), closes)),
         values.cast(pa.string())],
        names=["file", "block", "first", "opens", "closes", "record"])


def stitched(pieces: DataFrame) -> DataFrame:
    """The records that cross borders: pieces of a file in order, from one that opens a record to
    the next that does."""
    order = Window.partitionBy("file").orderBy("block", F.col("closes").desc())
    number = F.count_if("opens").over(order.rowsBetween(Window.unboundedPreceding, 0))
    parts = F.array_sort(F.collect_list(F.struct("block", "record")))
    return pieces.select("*", number.alias("number")).groupBy("file", "number").agg(
        F.bool_or("first").alias("first"),
        F.array_join(F.transform(parts, lambda p: p["record"]), "\n").alias("record"),
    ).select("first", "record")


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``first``, which says that a record is the first of its file, and the ``record``."""
    lines = file_lines(spark, path)
    # A part begins within a field only where a record crosses a border, and a part is what one
    # task reads: 100 TB have fewer than a million, of 17 bytes each.
    odd = materialize(odd_parts(lines), "odd-parts")
    begun = lines.join(F.broadcast(odd), ["file", "block"], "left").select(
        "file", "block", F.coalesce("within", F.lit(False)).alias("within"), "value")
    pieces = materialize(begun.mapInArrow(pieces_of, PIECES), "csv-pieces")
    whole = pieces.where("opens AND closes").select("first", "record")
    found = whole.unionByName(stitched(pieces.where("NOT (opens AND closes)")))
    return found.select("first", F.regexp_replace("record", "\r$", "").alias("record")).where(
        F.trim("record") != "")


def read_csv(spark: SparkSession, path: str, schema: T.StructType, on_malformed: str = "fail",
             dropped: Observation | None = None) -> DataFrame:
    """The records of files with a header, which has to name the columns of ``schema``. Records
    with too few or too many fields or a value of another type fail the read, or are dropped
    and, with an ``Observation`` in ``dropped``, counted as ``malformed_rows`` in the same pass."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    options = {"escape": QUOTE, "multiLine": "true"}
    names = F.from_csv("record", _ddl(text), options)
    found = csv_records(spark, path)
    wanted = F.struct(*(F.lit(f.name).alias(f.name) for f in schema.fields))
    wrong = F.concat(F.lit("a header does not name the columns: "), F.col("record"))
    header = F.when(names == wanted, False).otherwise(F.raise_error(wrong).cast("boolean"))
    found = found.where(F.when(F.col("first"), header).otherwise(True)).select("record")
    if on_malformed == "fail":
        options["mode"] = "FAILFAST"
        return parsed_once(found, F.from_csv("record", _ddl(schema), options))
    options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_csv("record", _ddl(with_corrupt(schema)), options)
    return without_malformed(parsed_once(found, parsed), dropped)


def parsed_once(records: DataFrame, parsed: Column) -> DataFrame:
    """The fields of a parsed record. They come from a generator, since a filter on a field would
    otherwise be pushed below the parser and parse the record again wherever it names one."""
    return records.select(F.inline(F.array(parsed)))


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def without_malformed(rows: DataFrame, dropped: Observation | None = None) -> DataFrame:
    """Rows whose record had the right form; the others are counted by ``dropped``."""
    malformed = F.col(CORRUPT).isNotNull()
    if dropped is not None:
        rows = rows.observe(dropped, F.count_if(malformed).alias("malformed_rows"))
    return rows.where(~malformed).drop(CORRUPT)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}"
                     for f in schema.fields)
