"""Exact join of texts whose shingle sets are close in Jaccard distance, by pivots and regions.

Jaccard distance is a metric, so a text may be compared with a few pivots in place of all others.

1. Unrelated texts are all at distance 1 from each other, where no text can serve as a pivot for
   them. The first pivots are therefore single shingles. A text lies in the region of the first
   of its shingles in one fixed order, and is a boundary text of the regions of the next ones: a
   text that lacks those costs too much distance from the ``(1 - t) n``-th shingle on, so it is
   replicated that far and no further. Shingles frequent in a sample come last in the order,
   which only saves work. Rows of regions are shuffled without more than the text's size; those
   of regions with several texts, few as a rule, then get counts of the text's shingles in classes,
   more of them the longer the text is. Sizes and counts bound the distance from below.
2. Texts that are left connected make cells. Cells too large for one task are cut by pivots from
   among their own texts: each text goes to its nearest pivot's Voronoi region, and also to every
   region that a text within reach of it may be in, which are those not farther than the nearest
   by twice the reach. Texts far from all pivots make a region of their own. Regions are cut again
   until they are small, or do not get smaller; those are compared block by block.
3. Small regions are joined exactly in one task. Tasks give out links that connect, not all pairs.

Equal sets are compared once. No case is dropped at any size: long runs of a region are chained
without the lower bounds, which makes cells larger and nothing less exact.

Cases: a text without words, and a null one, has an empty set and links with nothing; a text with
fewer words than a shingle has is one shingle; rows that share a ``doc_id`` are one document for
the groups; a null ``doc_id`` links with nothing and has no group; an empty table gives an empty
result; other columns play no part.
"""

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.batches import small
from shelfwise.llm.components import components
from shelfwise.llm.shingles import mixed, shingle_sets, text_bytes
from shelfwise.llm.vectors import Forest
from shelfwise.session import materialize

SAMPLE = 10_000  # documents that tell which shingles are frequent
FREQUENT = 262_144  # shingles at most that come last in the order
CLASSES = (64, 4096)  # fewest and most classes whose shingles are counted
MARGIN = 1.7  # unrelated texts differ in them by about so many times the bound
RUN = 4_096  # texts of one region that are compared by bounds
BUFFER = 50_000  # rows of regions a task looks at together, fewer if counts are long
COUNTS = 1_024  # bytes of counts that weigh as a row
GAPS = 1_000_000  # counts compared at once
MET = 500_000  # sets a task remembers to have met
LEAF = 2_000  # texts of a cell that one task joins
LEAF_SHINGLES = 4_000_000
PIVOTS = 24
NEAR = 0.5  # texts farther than this from all pivots make a region of their own
ROUNDS = 4
SLOTS = 1 << 20  # numbers a broadcast holds at most

ROWS = "kind int, key long, id long, n int, a long, b long, counts binary"
_SALT = np.uint64(0x5851F42D4C957F2D)


def prefix(n, percent):
    """How many first shingles a text of ``n`` must share one of with any linked text."""
    return n - -(-percent * n // 100) + 1


def fingerprints(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of a set."""
    return (int(mixed(shingles).sum(dtype=np.uint64).view(np.int64)),
            int(mixed(shingles + _SALT).sum(dtype=np.uint64).view(np.int64)))


def class_counts(shingles: np.ndarray, percent: int) -> bytes:
    """How many shingles are in each class; full at 255, which keeps differences bounds. Counts
    of unrelated texts of ``n`` differ by about ``1.13 * sqrt(n * classes)``."""
    share = (100 - percent) / (100 + percent) * 2
    wanted = (MARGIN * share / 1.13) ** 2 * len(shingles)
    classes = CLASSES[0]
    while classes < min(wanted, CLASSES[1]):
        classes *= 2
    counts = np.bincount(((mixed(shingles ^ _SALT) >> np.uint64(32)) % np.uint64(classes)).astype(
        np.int64), minlength=classes)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def folded(counts: np.ndarray, classes: int) -> np.ndarray:
    """Rows of counts in fewer classes."""
    if counts.shape[1] == classes:
        return counts.astype(np.int16)
    parts = counts.reshape(len(counts), -1, classes).sum(1, dtype=np.int32)
    return np.minimum(parts, 255).astype(np.int16)


def region_rows(batches: Iterator[pa.RecordBatch], width, percent, frequent):
    """One row a text with its set's size and fingerprint, and a row for each region it is in.
    Of texts of a task with equal sets one enters the regions; its row has the counts."""
    late = frequent.value
    met: set[tuple] = set()
    for batch in small(batches):
        ids = batch.column(0).to_pylist()
        sets = shingle_sets(text_bytes(batch.column(1)), width)
        marks = [fingerprints(s) for s in sets]
        first = []
        for i, mark in enumerate(marks):
            if ids[i] is not None and len(sets[i]) and mark not in met:
                met.add(mark)
                first.append(i)
        if len(met) > MET:
            met.clear()
        n = np.array([len(s) for s in sets], np.int32)
        chosen = set(first)
        counts = pa.array([class_counts(s, percent) if i in chosen else None
                           for i, s in enumerate(sets)], pa.binary())
        a, b = (np.array([mark[k] for mark in marks], np.int64) for k in (0, 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.zeros(len(ids), np.int32)), pa.array(a ^ b),
             pa.array(ids, pa.int64()), pa.array(n), pa.array(a), pa.array(b), counts],
            names=_NAMES)
        keys, owners = [], []
        for i in first:
            shingles = sets[i]
            if len(late):
                at = np.minimum(np.searchsorted(late, shingles), len(late) - 1)
                often = late[at] == shingles
                shingles = np.concatenate([shingles[~often], shingles[often]])
            keys.append(shingles[:prefix(len(shingles), percent)])
            owners.append(np.full(len(keys[-1]), i))
        if keys:
            keys, owners = np.concatenate(keys), np.concatenate(owners)
            known = pa.array(ids, pa.int64())
            for begin in range(0, len(keys), 100_000):
                some = slice(begin, begin + 100_000)
                size = len(keys[some])
                blank = pa.nulls(size, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ones(size, np.int32)), pa.array(keys[some].view(np.int64)),
                     known.take(pa.array(owners[some])), pa.array(n[owners[some]]), blank, blank,
                     pa.nulls(size, pa.binary())], names=_NAMES)


_NAMES = [column.split()[0] for column in ROWS.split(",")]


def shared_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of texts as they are, and of sorted rows of regions those of regions with several."""
    held, known = None, False  # the last row, and if the one before it has its region
    for batch in batches:
        kinds = batch.column(0)
        texts = batch.filter(pa.compute.equal(kinds, 0))
        if texts.num_rows:
            yield texts
        regions = batch.filter(pa.compute.equal(kinds, 1))
        if not regions.num_rows:
            continue
        if held is not None:
            regions = pa.Table.from_batches([held, regions]).combine_chunks().to_batches()[0]
        key = regions.column(1).to_numpy()
        same = key[1:] == key[:-1]
        several = np.concatenate([[known], same])
        several[:-1] |= same
        yield regions.slice(0, len(key) - 1).filter(pa.array(several[:-1]))
        held, known = regions.slice(len(key) - 1), bool(several[-1])
    if known:
        yield held


def weight(regions: pa.RecordBatch) -> int:
    return max(regions.num_rows, regions.column(6).nbytes // COUNTS)


def candidate_links(batches: Iterator[pa.RecordBatch], percent) -> Iterator[pa.RecordBatch]:
    """Rows of texts as they are, and for sorted rows of regions (kind 2) links in ``key`` and
    ``id`` that connect the texts no bound tells apart."""
    waiting: list[pa.RecordBatch] = []
    size = 0
    chained = False  # the first run waiting has rows that are chained already
    for batch in batches:
        kinds = batch.column(0)
        texts = batch.filter(pa.compute.equal(kinds, 0))
        if texts.num_rows:
            yield texts
        regions = batch.filter(pa.compute.equal(kinds, 1))
        if not regions.num_rows:
            continue
        waiting.append(regions)
        size += weight(regions)
        if size < BUFFER:
            continue
        rows = _Region(waiting)
        # The last run may go on. If it fills the buffer it is chained, and so is all that is to
        # come of it: texts on either side of a cut are never compared by bounds.
        cut = int(np.searchsorted(rows.runs, rows.runs[-1]))
        if cut:
            yield from rows.part(0, cut).links(percent, chained)
            chained = False
        else:
            cut = len(rows.key) - 1
            chained = True
            yield _links(rows.id[:-1], rows.id[1:])
        waiting = rows.batches(cut)
        size = sum(map(weight, waiting))
    if waiting:
        yield from _Region(waiting).links(percent, chained)
    waiting.clear()
    pa.default_memory_pool().release_unused()  # workers stay, and other tasks need the room


def _links(first, second) -> pa.RecordBatch:
    n = len(first)
    blank = pa.nulls(n, pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, 2, np.int32)), pa.array(first), pa.array(second),
         pa.nulls(n, pa.int32()), blank, blank, pa.nulls(n, pa.binary())], names=_NAMES)


class _Region:
    """Sorted rows of regions: key, text, size and counts."""

    def __init__(self, batches):
        table = pa.Table.from_batches(batches).combine_chunks()
        self.table = table
        self.key, self.id, self.n = (table.column(i).to_numpy() for i in (1, 2, 3))
        counts = table.column(6).to_pylist()
        self.width = np.array([len(c) for c in counts])
        # Rows of one number of classes make a matrix; ``place`` is the row in it.
        self.place = np.empty(len(counts), np.int64)
        self.counts = {}
        for width in np.unique(self.width).tolist():
            at = np.flatnonzero(self.width == width)
            self.place[at] = np.arange(len(at))
            self.counts[width] = np.frombuffer(
                b"".join([counts[i] for i in at]), np.uint8).reshape(-1, width)
        self.runs = np.cumsum(np.concatenate([[False], self.key[1:] != self.key[:-1]]))

    def batches(self, begin):
        return self.table.slice(begin).combine_chunks().to_batches()

    def part(self, begin, end):
        part = object.__new__(_Region)
        for name in ("key", "id", "n", "width", "place", "runs"):
            setattr(part, name, getattr(self, name)[begin:end])
        part.counts = self.counts
        return part

    def gaps(self, left, right):
        """Least number of shingles that only one of two texts has, for each pair."""
        out = np.zeros(len(left), np.int64)
        for a in np.unique(self.width[left]).tolist():
            for b in np.unique(self.width[right]).tolist():
                at = np.flatnonzero((self.width[left] == a) & (self.width[right] == b))
                classes, step = min(a, b), max(1, GAPS // max(a, b))
                for some in (at[k:k + step] for k in range(0, len(at), step)):
                    one = folded(self.counts[a][self.place[left[some]]], classes)
                    two = folded(self.counts[b][self.place[right[some]]], classes)
                    out[some] = np.abs(one - two).sum(1, dtype=np.int64)
        return out

    def links(self, percent, chained=False):
        """Links that connect: neighbours of long runs, and pairs that may be close enough. The
        first run is the rest of a long one if ``chained``."""
        where = np.searchsorted(self.runs, self.runs)
        length = np.searchsorted(self.runs, self.runs, "right") - where
        islong = length > RUN
        if chained:
            islong |= self.runs == self.runs[0]
        long = np.flatnonzero(islong[:-1] & (self.runs[:-1] == self.runs[1:]))
        ids, label = np.unique(self.id, return_inverse=True)
        forest = Forest(len(ids))
        root = np.arange(len(ids))
        some = np.flatnonzero(~islong & (length > 1))
        step = 1
        while len(some):
            some = some[some + step < where[some] + length[some]]
            left, right = some, some + step
            small, large = self.n[left].astype(np.int64), self.n[right].astype(np.int64)
            # Sizes rise within a run, so later ones are no closer.
            close = 100 * small >= percent * large
            some, left, right = some[close], left[close], right[close]
            apart = root[label[left]] != root[label[right]]
            left, right = left[apart], right[apart]
            if len(left):
                gap = self.gaps(left, right)
                both = self.n[left].astype(np.int64) + self.n[right]
                may = gap * (100 + percent) <= (100 - percent) * both
                pairs = np.unique(np.stack([label[left[may]], label[right[may]]]), axis=1)
                for i, j in pairs.T.tolist():
                    forest.join(i, j)
                if pairs.size:
                    root = np.array(forest.parent)
                    while (root != root[root]).any():
                        root = root[root]
            step += 1
        found = np.array(forest.links, np.int64).reshape(-1, 2)
        if len(found):
            yield _links(ids[found[:, 0]], ids[found[:, 1]])
        if len(long):
            yield _links(self.id[long], self.id[long + 1])


def sampled_shingles(batches, width) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        sets = shingle_sets(text_bytes(batch.column(0)), width)
        found, counts = np.unique(
            np.concatenate(sets or [np.empty(0, np.uint64)]), return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.view(np.int64)), pa.array(counts.astype(np.int64))],
            names=["shingle", "n"])


def frequent_shingles(documents: DataFrame, width: int) -> np.ndarray:
    """Shingles that several documents of a bounded sample have, sorted; at most ``FREQUENT``."""
    total = max(documents.count(), 1)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    sample = documents.where(place * F.lit(total) < F.lit(SAMPLE << 20)).select("text")
    rows = sample.mapInArrow(partial(sampled_shingles, width=width), "shingle long, n long")
    rows = rows.groupBy("shingle").agg(F.sum("n").alias("n")).where("n > 1").orderBy(
        F.desc("n"), "shingle").limit(FREQUENT).select("shingle").toArrow()
    return np.sort(rows.column(0).to_numpy().astype(np.int64).view(np.uint64))


def cell_sets(batches, width) -> Iterator[pa.RecordBatch]:
    """The sets of texts in cells, for the rows whose set is the one that is meant."""
    for batch in small(batches):
        sets = shingle_sets(text_bytes(batch.column("text")), width)
        a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
        right = [i for i, s in enumerate(sets) if fingerprints(s) == (a[i], b[i])]
        at = pa.array(right, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("cell").take(at), batch.column("id").take(at),
             pa.array([len(sets[i]) for i in right], pa.int32()),
             pa.array([sets[i].tobytes() for i in right], pa.binary())],
            names=["cell", "id", "n", "shingles"])


def joined_exactly(ids, sets, percent) -> list[tuple[int, int]]:
    """Links that connect all texts of a list whose sets are close enough. Texts meet on the rare
    shingles that one of two linked texts must share, and are then compared in full."""
    sizes = np.array([len(s) for s in sets])
    order = np.argsort(sizes, kind="stable")
    values, codes, often = np.unique(
        np.concatenate([sets[i] for i in order]), return_inverse=True, return_counts=True)
    rank = np.empty(len(values), np.int64)
    rank[np.lexsort((np.arange(len(values)), often))] = np.arange(len(values))
    codes = rank[codes]
    bounds = np.concatenate([[0], np.cumsum(sizes[order])])
    rows = [np.sort(codes[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    codes = np.concatenate(rows)
    met: dict[int, list[int]] = {}
    here = np.zeros(len(values), bool)
    forest = Forest(len(rows))
    for i, row in enumerate(rows):
        candidates = set()
        for code in row[:prefix(len(row), percent)].tolist():
            others = met.setdefault(code, [])
            candidates.update(others)
            others.append(i)
        mine = forest.root(i)
        near = [j for j in candidates
                if 100 * len(rows[j]) >= percent * len(row) and forest.root(j) != mine]
        if not near:
            continue
        here[row] = True
        for j in near:
            if forest.root(j) == forest.root(i):
                continue
            shared = int(np.count_nonzero(here[rows[j]]))
            if 100 * shared >= percent * (len(row) + len(rows[j]) - shared):
                forest.join(i, j)
        here[row] = False
    return [(ids[order[i]], ids[order[j]]) for i, j in forest.links]


def joined_cells(batches: Iterator[pa.RecordBatch], percent) -> Iterator[pa.RecordBatch]:
    """Links in each cell of a partition that is sorted by cell. No cell is larger than a leaf."""
    cell, ids, sets = None, [], []

    def links():
        found = joined_exactly(ids, sets, percent) if len(ids) > 1 else []
        return pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in found], pa.int64()),
             pa.array([x[1] for x in found], pa.int64())], names=["first", "second"])

    for batch in batches:
        for now, i, data in zip(batch.column("cell").to_pylist(), batch.column("id").to_pylist(),
                                batch.column("shingles")):
            if now != cell:
                if len(ids) > 1:
                    yield links()
                cell, ids, sets = now, [], []
            ids.append(i)
            sets.append(np.frombuffer(data.as_py(), np.uint64))
    if len(ids) > 1:
        yield links()


def to_regions(members: pa.Table, pivots: pa.Table, percent: int) -> pa.Table:
    """Members of a cell in the regions of its pivots, each as often as reach demands."""
    reach = 1 - percent / 100
    sets = [np.frombuffer(x.as_py(), np.uint64) for x in members.column("shingles")]
    codes, inverse = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    sizes = np.array([len(s) for s in sets])
    far = np.ones((len(sets), pivots.num_rows))
    for k, data in enumerate(pivots.column("shingles")):
        pivot = np.frombuffer(data.as_py(), np.uint64)
        shared = np.bincount(owner[np.isin(codes, pivot)[inverse]], minlength=len(sets))
        far[:, k] = 1 - shared / (sizes + len(pivot) - shared)
    names = np.array(pivots.column("pivot").to_pylist() + [None], object)
    rows, regions = [], []
    nearest = far.min(1, initial=1.0)
    for i in range(len(sets)):
        within = np.minimum(nearest[i] + 2 * reach, NEAR + reach) + 1e-9
        chosen = np.flatnonzero(far[i] <= within).tolist()
        if nearest[i] > NEAR:
            chosen.append(len(names) - 1)  # far from all: a region of its own
        rows += [i] * len(chosen)
        regions += [names[k] for k in chosen]
    taken = members.select(["cell", "id", "n", "shingles"]).take(pa.array(rows, pa.int64()))
    return taken.append_column("pivot", pa.array(regions, pa.int64()))


def sized(cells: DataFrame) -> DataFrame:
    return cells.groupBy("cell").agg(F.count("*").alias("texts"), F.sum("n").alias("shingles_in"))


def is_leaf(leaf, leaf_shingles):
    return (F.col("texts") <= leaf) & (F.col("shingles_in") <= leaf_shingles)


def cut_by_pivots(cells: DataFrame, sizes: DataFrame, percent: int, salt: int, leaf,
                  leaf_shingles) -> DataFrame:
    """The texts of large cells in the regions of pivots drawn from the cells themselves."""
    rows = cells.join(sizes, "cell")
    place = F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(1 << 30))
    parts = F.greatest(F.ceil(F.col("texts") / F.lit(leaf)),
                       F.ceil(F.col("shingles_in") / F.lit(leaf_shingles))).cast("int")
    # Each part of a cell gets a copy of the cell's few pivots.
    pivots = rows.where(place * F.col("texts") < F.lit(PIVOTS << 30)).select(
        F.col("cell").alias("in_cell"), F.col("id").alias("pivot"),
        F.col("shingles").alias("shingles"),
        F.explode(F.sequence(F.lit(0), parts - 1)).alias("in_part"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("id", F.lit(-salt)), parts).cast("int"))

    def dealt(key: tuple[pa.Scalar, ...], members: pa.Table, drawn: pa.Table) -> pa.Table:
        if not members.num_rows:
            return _NO_REGIONS
        return to_regions(members, drawn, percent)

    found = rows.groupBy("cell", "part").cogroup(
        pivots.groupBy("in_cell", "in_part")).applyInArrow(
        dealt, "cell long, id long, n int, shingles binary, pivot long")
    return found.select(
        F.xxhash64("cell", F.coalesce("pivot", F.lit(-1)), F.col("pivot").isNull(),
                   F.lit(salt)).alias("cell"), F.col("cell").alias("whole"), "id", "n",
        "shingles")


_NO_REGIONS = pa.table({
    "cell": pa.array([], pa.int64()), "id": pa.array([], pa.int64()),
    "n": pa.array([], pa.int32()), "shingles": pa.array([], pa.binary()),
    "pivot": pa.array([], pa.int64())})


def as_blocks(cells: DataFrame, sizes: DataFrame, leaf, leaf_shingles) -> DataFrame:
    """The texts of cells that pivots do not cut, in every pair of blocks they are in."""
    half = F.greatest(F.ceil(2 * F.col("texts") / F.lit(leaf)),
                      F.ceil(2 * F.col("shingles_in") / F.lit(leaf_shingles))).cast("int")
    rows = cells.join(sizes, "cell").withColumn("blocks", half)
    own = F.pmod(F.xxhash64("id", F.lit(0)), "blocks").cast("int")
    rows = rows.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select(
        F.xxhash64("cell", F.least("own", "other"), F.greatest("own", "other")).alias("cell"),
        "id", "n", "shingles")


def exact_links(cells: DataFrame, percent: int, leaf=LEAF, leaf_shingles=LEAF_SHINGLES):
    """``first, second`` links that connect the close texts of all cells."""
    def joined(rows):
        return rows.repartition("cell").sortWithinPartitions("cell", "id").mapInArrow(
            partial(joined_cells, percent=percent), "first long, second long")

    links = None
    for turn in range(ROUNDS + 1):
        sizes = materialize(sized(cells), "cells")
        small = is_leaf(leaf, leaf_shingles)
        found = joined(cells.join(sizes.where(small), "cell"))
        links = found if links is None else links.unionByName(found)
        large = sizes.where(~small)
        if large.isEmpty():
            return links
        if turn == ROUNDS:
            return links.unionByName(joined(as_blocks(cells, large, leaf, leaf_shingles)))
        regions = materialize(cut_by_pivots(
            cells, large, percent, turn + 1, leaf, leaf_shingles), "regions")
        # A cut that would leave most of a cell's pairs to compare is dropped.
        pairs = regions.groupBy("whole", "cell").agg(F.count("*").alias("part")).groupBy(
            F.col("whole").alias("cell")).agg(F.sum(F.col("part") ** 2).alias("pairs"))
        cut = large.join(pairs, "cell").withColumn(
            "helps", F.col("pairs") < 0.7 * F.col("texts") ** 2)
        cut = materialize(cut, "cuts")
        links = links.unionByName(joined(as_blocks(
            cells, cut.where("NOT helps").drop("pairs", "helps"), leaf, leaf_shingles)))
        cells = regions.join(cut.where("helps").select(F.col("cell").alias("whole")), "whole",
                             "left_semi").drop("whole")
    return links


def groups(documents: DataFrame, width=5, percent=80, leaf=LEAF, leaf_shingles=LEAF_SHINGLES):
    """Every row's ``doc_id`` with ``n_shingles`` and ``component_id``, the smallest id that
    links of a Jaccard similarity of ``percent`` hundredths or more reach."""
    spark = documents.sparkSession
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    frequent = spark.sparkContext.broadcast(frequent_shingles(texts, width))
    rows = texts.mapInArrow(
        partial(region_rows, width=width, percent=percent, frequent=frequent), ROWS)
    rows = rows.repartition("key").sortWithinPartitions("kind", "key", "n", "id")
    rows = materialize(rows.mapInArrow(shared_regions, ROWS), "regions")
    # Two texts that share an id and a size give each other's counts to their rows as well, which
    # makes cells larger and nothing less exact.
    marks = rows.where("kind = 0 AND counts IS NOT NULL").select("id", "n", "a", "b", "counts")
    marked = rows.where("kind = 1").select("kind", "key", "id", "n").join(
        marks.distinct().select("id", "n", "counts"), ["id", "n"])
    blank = F.lit(None).cast("long")
    linked = marked.select(
        "kind", "key", "id", "n", blank.alias("a"), blank.alias("b"), "counts").repartition(
        "key").sortWithinPartitions("key", "n", "id").mapInArrow(
        partial(candidate_links, percent=percent), ROWS)

    sets = rows.where("kind = 0").select("id", "n", "a", "b")
    # The first document of each set stands for it; the others link to it.
    first = sets.where("id IS NOT NULL AND n > 0").groupBy("a", "b").agg(
        F.min("id").alias("rep"), F.min("n").alias("n"))
    copies = sets.where("id IS NOT NULL AND n > 0").select("id", "a", "b").join(
        first, ["a", "b"]).where("id <> rep").select(
        F.col("id").alias("first"), F.col("rep").alias("second"))
    cells = components(linked.select("key", "id"), "key", "id")
    cells = sets.join(cells, "id").groupBy("a", "b").agg(F.min("component").alias("cell")).join(
        first, ["a", "b"]).select("cell", F.col("rep").alias("id"), "a", "b")
    cells = materialize(cells, "members")
    several = cells.groupBy("cell").agg(F.count("*").alias("texts")).where("texts > 1")
    cells = cells.join(several.select("cell"), "cell", "left_semi")
    # Most texts are in no cell; they are left out before the join shuffles any text. The slots
    # are at most ``SLOTS`` numbers, and a text that shares one by chance goes in the join.
    slots = cells.select(F.pmod(F.xxhash64("id"), F.lit(SLOTS)).alias("slot")).distinct()
    texts = texts.withColumn("slot", F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS))).join(
        F.broadcast(slots), "slot", "left_semi").drop("slot")
    found = texts.join(cells, texts["doc_id"] == cells["id"]).select(
        "cell", "id", "a", "b", "text").mapInArrow(
        partial(cell_sets, width=width), "cell long, id long, n int, shingles binary")
    links = exact_links(materialize(found, "cell-sets"), percent, leaf, leaf_shingles)
    labels = components(links.unionByName(copies), "first", "second")
    return sets.join(labels, "id", "left").select(
        F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id"))


def one_of_each(documents: DataFrame, width=5, percent=80) -> DataFrame:
    """The documents, as they are, without those that are not the first of their group. Rows
    without an id are kept, of rows that share one a single one is."""
    found = materialize(
        groups(documents, width, percent).select("doc_id", "component_id"), "groups")
    kept = found.where("doc_id = component_id").select("doc_id").distinct().alias("kept")
    # As a rule most documents are alone with their id and first of their group, and need no join.
    # Slots of the ids of all others are broadcast; an id that shares one by chance is joined.
    others = found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.count("*").alias("rows"), F.max(F.col("doc_id") != F.col("component_id")).alias(
            "later")).where("rows > 1 OR later")
    slots = materialize(others.select(
        F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS)).alias("slot")).distinct(), "slots")
    named = documents.where("doc_id IS NOT NULL").alias("own")
    in_slot = F.pmod(F.xxhash64(F.col("own.doc_id").cast("long")), F.lit(SLOTS)) == F.col(
        "slots.slot")
    slots = F.broadcast(slots.alias("slots"))
    alone = named.join(slots, in_slot, "left_anti")
    rows = named.join(slots, in_slot, "left_semi").alias("own").join(
        kept, F.col("own.doc_id").cast("long") == F.col("kept.doc_id"), "left_semi")
    # Which of those that share an id does not depend on the order rows come in.
    tied = rows.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1")
    single = rows.join(tied.select("doc_id"), "doc_id", "left_anti").select(*documents.columns)
    several = rows.join(tied.select("doc_id"), "doc_id", "left_semi")
    several = several.groupBy("doc_id").agg(F.min(F.struct(*(
        F.col(f"`{name}`") for name in documents.columns))).alias("row")).select("row.*")
    without = documents.where("doc_id IS NULL")
    return alone.unionByName(single).unionByName(several).unionByName(without)
