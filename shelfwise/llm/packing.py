"""Hierarchical packing of documents into sequences of several context sizes.

Documents longer than the longest window are cut to full windows at once; what is left of them,
and shorter documents, go to the tier of the smallest window that holds them. From the longest
tier down, a window opens with its longest document, its gap is filled with the longest documents
of shorter tiers that fit, and where none fits a document is cut, so every window is exactly full.
Sequences of one tier, numbered over all tasks, make up step groups that all have the same number
of tokens but for the last one of a tier; sequences that are not full come last.

Each task packs its own documents and holds a bounded number of ids: full windows leave at once,
and the rest is packed whenever it reaches ``HELD``. What a task cannot make a full window of is
less than one window; those rests are dealt to few tasks and packed again, and only the very last
sequence of such a task is not full.

Cases: null and empty texts are one end id; rows that repeat are packed each; documents without
an id are packed like others; an empty table gives an empty result; other columns play no part.
"""

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.token_files import document_ids
from shelfwise.session import materialize

TIERS = (2048, 1024, 512, 256)
STEP_TOKENS = 1 << 16
HELD = 4_000_000
LEVEL = 1 << 62
NOT_FULL = -1  # in place of a number in the tier


class Packer:
    """Documents of one task; ``rows`` gathers the pieces placed so far, with the number of their
    sequence among the task's full ones of the tier."""

    def __init__(self, base: int, tiers=TIERS):
        self.base, self.tiers = base, tiers
        self.longest = tiers[0]
        self.by_length = [[] for _ in range(self.longest + 1)]
        self.lengths = 0  # bit n is set if a document of n ids waits
        self.held = 0
        self.rows: list[tuple] = []
        self.sequences = 0
        self.of_tier = dict.fromkeys(tiers, 0)

    def add(self, doc, start, total, ids):
        """Ids of a document from ``start`` on; full windows are placed at once."""
        cut = len(ids) - len(ids) % self.longest
        for at in range(0, cut, self.longest):
            self._place(self.longest, [(doc, start + at, total, ids[at:at + self.longest])])
        if cut < len(ids):
            self._wait((doc, start + cut, total, ids[cut:].copy()))

    def _wait(self, item):
        n = len(item[3])
        self.by_length[n].append(item)
        self.lengths |= 1 << n
        self.held += n

    def _take(self, n):
        item = self.by_length[n].pop()
        if not self.by_length[n]:
            self.lengths &= ~(1 << n)
        self.held -= n
        return item

    def _place(self, tier, items, full=True):
        number = self.of_tier[tier] if full else NOT_FULL
        self.of_tier[tier] += full
        offset = 0
        for doc, start, total, ids in items:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()),
                              total, self.base + self.sequences, offset, tier, number))
            offset += len(ids)
        self.sequences += 1

    def _fill(self, tier, items, gap):
        """Documents for a gap, longest first; cuts one where none fits. The gap left is the
        second result, above 0 only if nothing waits any more."""
        while gap and self.lengths:
            fitting = self.lengths & ((1 << (gap + 1)) - 1)
            if fitting:
                item = self._take(fitting.bit_length() - 1)
            else:
                doc, start, total, ids = self._take((self.lengths & -self.lengths).bit_length() - 1)
                self._wait((doc, start + gap, total, ids[gap:]))
                item = (doc, start, total, ids[:gap])
            items.append(item)
            gap -= len(item[3])
        return items, gap

    def drain(self):
        """Pack all that waits into full windows; what is left of it waits again."""
        for tier in self.tiers:
            while self.lengths.bit_length() - 1 > (tier // 2 if tier != self.tiers[-1] else 0):
                first = self._take(self.lengths.bit_length() - 1)
                items, gap = self._fill(tier, [first], tier - len(first[3]))
                if gap:
                    for item in items:
                        self._wait(item)
                    return
                self._place(tier, items)

    def finish(self):
        """Pack all: windows of falling size while they can be filled, then one that is not."""
        self.drain()
        for tier in self.tiers:
            while self.held >= tier:
                self._place(tier, self._fill(tier, [], tier)[0])
        if self.held:
            self._place(self.tiers[0], self._fill(self.tiers[0], [], self.tiers[0])[0], full=False)

    def waiting(self):
        return [item for items in self.by_length for item in items]


PIECES = ("doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long,"
          " sequence_id long, offset long, context_size int, step_id long")
_TYPES = [pa.int64()] * 6 + [pa.int32(), pa.int64(), pa.binary()]


def _rows(rows, id_type):
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], id_type),
         *(pa.array(c, t) for c, t in zip(columns[1:], _TYPES))],
        names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
               "context_size", "step_id", "ids"])


def packed(batches: Iterator[pa.RecordBatch], id_type, last: bool) -> Iterator[pa.RecordBatch]:
    """Pieces of full sequences, and rows with ``ids`` for what is left (none if ``last``)."""
    part = TaskContext.get().partitionId()
    packer = Packer((part << 32) + (LEVEL if last else 0))
    for batch in batches:
        columns = {name: batch.column(name) for name in batch.schema.names}
        docs = columns["doc_id"].to_pylist()
        for i, data in enumerate(columns["ids"]):
            ids = np.frombuffer(data.as_buffer(), "<u2")
            start = columns["start"][i].as_py() if last else 0
            total = columns["doc_tokens"][i].as_py() if last else len(ids)
            packer.add(docs[i], start, total, ids)
            if packer.held >= HELD:
                packer.drain()
        if packer.rows:
            yield _rows([(*row, None) for row in packer.rows], id_type)
            packer.rows = []
    if last:
        packer.finish()
    else:
        packer.drain()
    if packer.rows:
        yield _rows([(*row, None) for row in packer.rows], id_type)
    if rest := packer.waiting():
        yield _rows([(doc, start, len(ids), None, total, None, None, None, None, ids.tobytes())
                     for doc, start, total, ids in rest], id_type)


def in_steps(pieces: DataFrame) -> DataFrame:
    """Pieces with ``step_id`` in place of the number their task gave. A task counts its sequences
    of a tier, and those few counts add up to where each task begins."""
    pieces = pieces.withColumn("task", F.shiftright("sequence_id", 32)).withColumn(
        "not_full", F.col("step_id") == NOT_FULL)
    keys = ["context_size", "not_full", "task"]
    counts = pieces.where("offset = 0").groupBy(*keys).agg(F.count("*").alias("n"))
    before = Window.partitionBy("context_size").orderBy("not_full", "task")
    begins = counts.select(*keys, (F.sum("n").over(before) - F.col("n")).alias("begin"))
    number = F.col("begin") + F.greatest("step_id", F.lit(0))
    each = F.greatest(F.lit(1), F.floor(F.lit(STEP_TOKENS) / F.col("context_size")))
    step = F.shiftleft(F.col("context_size").cast("long"), 40) + F.floor(number / each)
    return pieces.join(F.broadcast(begins), keys).withColumn("step_id", step)


def pack(documents: DataFrame, end=1, tokenizer: str | None = None) -> DataFrame:
    """Every piece of every document with its place; see the module's text."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = documents.schema["doc_id"].dataType
    schema = PIECES.format(kind=kind.simpleString()) + ", ids binary"
    run = partial(packed, id_type=to_arrow_type(kind))
    first = materialize(document_ids(documents, end, tokenizer).mapInArrow(
        partial(run, last=False), schema), "packed")
    rest = first.where("ids IS NOT NULL")
    tasks = rest.agg(F.ceil(F.sum("length") / F.lit(HELD))).first()[0] or 1
    second = materialize(rest.repartition(int(tasks)).sortWithinPartitions(
        "doc_id", "start").mapInArrow(partial(run, last=True), schema), "packed-rests")
    pieces = in_steps(first.where("ids IS NULL").unionByName(second))
    return pieces.select(*(name for name in first.columns if name != "ids"))
