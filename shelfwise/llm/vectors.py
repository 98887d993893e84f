"""Near-duplicate vectors by product quantisation, checked by exact cosine.

Vectors of length one are assigned to the nearest of a set of coarse centroids; what is left after
subtracting it (the residual) is cut into subspaces and stored as one code byte each. A vector
visits every list for which the distance to the plane between its own cell and that one does not
exceed ``reach``, half the radius of the threshold. Two linked vectors of different cells lie on
either side of the plane between those, and their distances to it add up to no more than the radius,
so the nearer one visits the other: no link is missed. That visit alone counts the link, for
both of them. A ``spread`` narrows ``reach`` to so many standard deviations of a neighbour's
offset, and may miss links. In a list, distances come from one table of
subspace distances a visitor; the stored error of each code makes that filter lossless, and what
passes is checked by the cosine in double precision.

Vectors link with those of their own length only, so each length has a quantiser and lists of its
own. It is fitted on a bounded sample (``FIT``), the lists hold all vectors. Equal vectors
count as one with a weight, lists are cut into blocks of at most ``BLOCK`` vectors, and a task
gives out the number of links of a visitor in a block and a spanning forest of the links, never
all pairs.

Cases: vectors that are null, empty, zero, or hold null or non-finite components link with
nothing; rows that share a ``vec_id`` are one vector for the
components, and have the larger number of links; a null ``vec_id`` gets a null
component; an empty table gives an empty result; other columns play no part.
"""

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.components import components
from shelfwise.session import materialize

FIT = 20_000
BLOCK = 2_048
SUBSPACES = 16
CODES = 64
PAIRS = 32_768  # whose distances to planes are computed at once


def valid_rows(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """The vectors that can link, as bytes."""
    for batch in batches:
        ids, out = [], []
        for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1)):
            if not vector.is_valid or not len(vector) or vector.values.null_count:
                continue
            values = vector.values.to_numpy().astype(kind)
            if np.isfinite(values).all() and values.any():
                ids.append(vec_id)
                out.append(values.tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(out, pa.binary())], names=["vec_id", "vector"])


def points(column, kind: str) -> np.ndarray:
    """Vectors scaled to length one, in double precision."""
    rows = np.stack([np.frombuffer(x.as_buffer(), kind) for x in column]).astype(np.float64)
    rows /= np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def by_length(column, kind: str):
    """For each length in a column its rows' numbers and points."""
    lengths = pa.compute.binary_length(column).to_numpy() // np.dtype(kind).itemsize
    for dim in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == dim)
        yield dim, at, points(column.take(pa.array(at)), kind)


def k_means(sample, k, rounds, rng):
    """Plain Lloyd iterations on a sample; empty clusters keep their place."""
    centres = sample[rng.choice(len(sample), min(k, len(sample)), replace=False)].copy()
    for _ in range(rounds):
        near = nearest(sample, centres)
        counts = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def squared(rows, centres):
    return np.maximum((rows ** 2).sum(1)[:, None] + (centres ** 2).sum(1)
                      - 2 * rows @ centres.T, 0)


def nearest(rows, centres):
    return np.concatenate([squared(rows[i:i + 4096], centres).argmin(1)
                           for i in range(0, len(rows), 4096)])


class Quantiser:
    """Coarse centroids and one codebook for each subspace of the residuals."""

    def __init__(self, sample: np.ndarray, lists: int, seed=7):
        rng = np.random.default_rng(seed)
        self.centres = k_means(sample, lists, 12, rng)
        rest = sample - self.centres[nearest(sample, self.centres)]
        self.cuts = np.array_split(np.arange(sample.shape[1]), min(SUBSPACES, sample.shape[1]))
        self.books = [k_means(rest[:, cut], CODES, 8, rng) for cut in self.cuts]
        gaps = squared(self.centres, self.centres)
        self.gaps = np.sqrt(gaps)

    def encode(self, residuals):
        """Codes of residuals, and how far each code is from its residual."""
        codes = np.stack([nearest(residuals[:, cut], book)
                          for cut, book in zip(self.cuts, self.books)], 1).astype(np.uint8)
        error = np.zeros(len(residuals))
        for i, (cut, book) in enumerate(zip(self.cuts, self.books)):
            error += ((residuals[:, cut] - book[codes[:, i]]) ** 2).sum(1)
        return codes, np.sqrt(error)

    def tables(self, residuals):
        """Squared distances from residuals to all codewords: row, subspace, code."""
        return [squared(residuals[:, cut], book) for cut, book in zip(self.cuts, self.books)]

    def planes(self, rows, own, other):
        """For each point how far it is from the plane between two lists, its own first. A row's
        result depends on that row alone, so all tasks find the same."""
        step = self.centres[other] - self.centres[own]
        middle = (self.centres[other] + self.centres[own]) / 2
        length = np.sqrt((step ** 2).sum(1))
        return ((middle - rows) * step).sum(1) / np.where(length > 0, length, 1)

    def visits(self, rows, home, reach):
        """For each point, whose own list is ``home``, a row of lists to visit."""
        far = squared(rows, self.centres)
        gap = self.gaps[home]
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = (far - far[np.arange(len(rows)), home, None]) / (2 * gap)
        return ~(plane > reach) | (np.arange(far.shape[1]) == home[:, None])


class Quantisers:
    """One for each length of vectors; their lists are numbered on from one to the next."""

    def __init__(self, of_length: dict[int, Quantiser]):
        self.of_length, self.first, number = of_length, {}, 0
        for dim, quantiser in of_length.items():
            self.first[dim] = number
            number += len(quantiser.centres)


def at_home(batches, shared, kind) -> Iterator[pa.RecordBatch]:
    """The list each vector lies in."""
    for batch in batches:
        if batch.num_rows:
            home = np.empty(batch.num_rows, np.int64)
            for dim, at, rows in by_length(batch.column("vector"), kind):
                centres = shared.value.of_length[dim].centres
                home[at] = nearest(rows, centres) + shared.value.first[dim]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(home.astype(np.int32))],
                names=[*batch.schema.names, "own"])


def visiting(batches, shared, kind, reach) -> Iterator[pa.RecordBatch]:
    """A row for each list that a vector visits, its own included."""
    for batch in batches:
        for begin in range(0, batch.num_rows, 512):
            some = batch.slice(begin, 512)
            for dim, at, found in by_length(some.column("vector"), kind):
                home = some.column("own").to_numpy()[at] - shared.value.first[dim]
                visit = shared.value.of_length[dim].visits(found, home, reach[dim])
                rows, lists = np.nonzero(visit)
                taken = some.take(pa.array(at[rows]))
                numbers = (lists + shared.value.first[dim]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array(numbers), pa.array(home[rows] == lists)],
                    names=[*taken.schema.names, "list", "home"])


class Forest:
    """Union-find over row numbers that keeps the links which joined two trees."""

    def __init__(self, n):
        self.parent = list(range(n))
        self.links = []

    def root(self, i):
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i, j):
        a, b = self.root(i), self.root(j)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
            self.links.append((i, j))


def links_in_block(key, group: pa.Table, shared, kind, threshold) -> pa.Table:
    """Links of the visitors of one block with its vectors: counts, and a forest. The block's own
    vectors visit in the first share only. A link of two lists is left to the vector nearer to
    the plane between them, as the other one need not visit."""
    number, _, share = (x.as_py() for x in key)
    ids = group.column("rep").to_numpy()
    weights = group.column("weight").to_numpy()
    rows = points(group.column("vector").combine_chunks(), kind)
    home = group.column("home").to_numpy()
    held = np.flatnonzero(home)
    guests = np.arange(len(ids)) if share == 0 else np.flatnonzero(~home)
    quantiser = shared.value.of_length[rows.shape[1]]
    number -= shared.value.first[rows.shape[1]]
    own = group.column("own").to_numpy() - shared.value.first[rows.shape[1]]
    centre = quantiser.centres[number]
    codes, error = quantiser.encode(rows[held] - centre)
    radius = np.sqrt(2 - 2 * threshold)
    counts = np.zeros(len(ids), np.int64)
    forest = Forest(len(ids))
    for begin in range(0, len(guests), 256):
        some = guests[begin:begin + 256]
        far = np.zeros((len(some), len(held)))
        for i, table in enumerate(quantiser.tables(rows[some] - centre)):
            far += table[:, codes[:, i]]
        visitor, other = np.nonzero(np.sqrt(far) <= radius + error + 1e-6)
        visitor, other = some[visitor], held[other]
        linked = (visitor != other) & (
            np.einsum("ij,ij->i", rows[visitor], rows[other]) >= threshold)
        visitor, other = visitor[linked], other[linked]
        across = own[visitor] != number
        mine = ~across
        pairs = np.flatnonzero(across)
        for at in range(0, len(pairs), PAIRS):
            part = pairs[at:at + PAIRS]
            one, two = visitor[part], other[part]
            near = quantiser.planes(rows[one], own[one], own[two])
            far = quantiser.planes(rows[two], own[two], own[one])
            mine[part] = (near < far) | ((near == far) & (ids[one] < ids[two]))
        visitor, other, across = visitor[mine], other[mine], across[mine]
        np.add.at(counts, visitor, weights[other])
        np.add.at(counts, other[across], weights[visitor[across]])
        for i, j in zip(visitor.tolist(), other.tolist()):
            forest.join(i, j)
    found = np.flatnonzero(counts)
    pairs = np.array(forest.links, np.int64).reshape(-1, 2)
    blank = np.zeros(len(pairs), np.int64)
    return pa.table({
        "rep": np.concatenate([ids[found], ids[pairs[:, 0]]]),
        "n": np.concatenate([counts[found], blank]),
        "other": pa.array([None] * len(found) + ids[pairs[:, 1]].tolist(), pa.int64())})


def fitted(vectors: DataFrame, total: int, kind: str, lists: int | None) -> Quantiser:
    """A quantiser from a sample of about ``FIT`` distinct vectors; all of them if fewer."""
    place = F.pmod(F.xxhash64("vector"), F.lit(1 << 20))
    sample = vectors.where(place * total < F.lit(FIT << 20)).select("rep", "vector")
    sample = points(sample.orderBy("rep").toArrow().column(1).combine_chunks(), kind)
    return Quantiser(sample, lists or max(1, min(int(np.sqrt(total)), len(sample) // 8)))


def found_links(vectors: DataFrame, totals, kind, threshold, spread, lists, block):
    """Rows ``rep, n`` with numbers of links to add up, and rows ``rep, other`` of a forest.
    ``totals`` has the number of vectors of each length."""
    size = np.dtype(kind).itemsize
    quantisers = Quantisers({
        dim: fitted(vectors.where(F.length("vector") == dim * size), total, kind, lists)
        for dim, total in totals.items()})
    shared = vectors.sparkSession.sparkContext.broadcast(quantisers)  # bounded by the samples
    share = {dim: min(0.5, spread / np.sqrt(dim)) if spread else 0.5 for dim in totals}
    reach = {dim: share[dim] * np.sqrt(2 - 2 * threshold) + 1e-6 for dim in totals}
    names = "rep long, weight long, vector binary, own int"
    own = materialize(vectors.select("rep", "weight", "vector").mapInArrow(
        partial(at_home, shared=shared, kind=kind), names), "lists")
    held = own.withColumn("list", F.col("own"))
    # A list is cut into blocks which all its visitors see, and those come in shares, so that no
    # group grows with the table.
    sizes = held.groupBy("list").agg(
        F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks"))
    visits = own.mapInArrow(partial(visiting, shared=shared, kind=kind, reach=reach),
                            names + ", list int, home boolean")
    counts = visits.groupBy("list").agg(
        F.ceil(F.count("*") / F.lit(8 * block)).cast("int").alias("shares"))
    sizes = F.broadcast(materialize(sizes.join(counts, "list"), "list-sizes"))  # a row a list
    spot = F.pmod(F.xxhash64("rep"), "blocks").cast("int")
    held = held.join(sizes, "list").select(
        "list", spot.alias("block"), "rep", "weight", "vector", "own", F.lit(True).alias("home"),
        F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"))
    guests = visits.join(sizes, "list").select(
        "*", spot.alias("spot"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias(
            "block")).where(~(F.col("home") & (F.col("block") == F.col("spot"))))
    guests = guests.select(
        "list", "block", "rep", "weight", "vector", "own", F.lit(False).alias("home"),
        F.pmod(F.xxhash64("rep", F.lit(1)), "shares").cast("int").alias("share"))

    def linked(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        return links_in_block(key, group, shared, kind, threshold)

    return held.unionByName(guests).groupBy("list", "block", "share").applyInArrow(
        linked, "rep long, n long, other long")


def near_duplicates(embeddings: DataFrame, threshold=0.9, spread=None, lists=None,
                    block=BLOCK) -> DataFrame:
    """Every row's ``vec_id`` with ``n_links``, ``component_id`` and ``kept``."""
    single = embeddings.schema["embedding"].dataType.simpleString() == "array<float>"
    kind = "<f4" if single else "<f8"
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast(f"array<{'float' if single else 'double'}>").alias("embedding"))
    valid = materialize(rows.where("vec_id IS NOT NULL").mapInArrow(
        partial(valid_rows, kind=kind), "vec_id long, vector binary"), "valid-vectors")
    vectors = materialize(valid.groupBy("vector").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("weight")), "vectors")
    counts = vectors.groupBy(F.length("vector").alias("bytes")).count().orderBy("bytes").collect()
    totals = {row.bytes // np.dtype(kind).itemsize: row["count"] for row in counts}
    if totals:
        found = materialize(found_links(
            vectors, totals, kind, threshold, spread, lists, block), "vector-links")
    else:
        found = rows.sparkSession.createDataFrame([], "rep long, n long, other long")
    members = valid.join(vectors, "vector").select("vec_id", "rep", "weight")
    links = found.where("other IS NOT NULL").select("rep", "other").unionByName(
        members.select("rep", F.col("vec_id").alias("other")))
    labels = components(links, "rep", "other").select(
        F.col("id").alias("vec_id"), F.col("component").alias("component_id"))
    counts = found.where("other IS NULL").groupBy("rep").agg(F.sum("n").alias("n"))
    counts = members.join(counts, "rep", "left").groupBy("vec_id").agg(F.max(
        F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    component = F.coalesce("component_id", "vec_id")
    return rows.select("vec_id").join(counts, "vec_id", "left").join(
        labels, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
