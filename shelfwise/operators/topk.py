"""The best items of every user, by the dot product of their factors.

All users are compared with all items. Users lie in blocks, and every block meets the items in packs
that Spark shuffles and sorts by their longest vector, so a task keeps the lists of its users and a
few thousand items at a time. A score is at most the product of both lengths: once that falls below the
last entry of a user's list, the packs that follow cannot change it. Products are first taken in single
precision; all that may enter a list is computed again in double precision, one component after
the other, so results depend on no order and equal scores go by product.
"""

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.schemas import LIST_LENGTH
from shelfwise.session import materialize

SHORTEST = 16  # lists up to this length are made in one go
PAIRS = 50_000_000  # of vectors that one block compares at least
ENTRIES = 20_000_000  # of lists and vectors that one block keeps
PACK_BYTES = 6000
ITEMS, USERS = 4096, 256  # that one product of matrices compares
MOST_SEEN = 65_536  # items that are hidden from a user while comparing
INT_MAX = 2**31 - 1
NONE = np.iinfo(np.int64).max
PACKS = "block int, reach double, ids binary, vectors binary"
LISTS = "id bigint, items array<bigint>, scores array<double>"


def dot(left: Column | str, right: Column | str) -> Column:
    """The dot product of two arrays of equal length, in double precision."""
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def packed(batches: Iterator[pa.RecordBatch], width: int, kind: str, of_users: bool):
    """``(id, features, block)`` as rows that hold several vectors of one block, longest first.
    Users have no bound, which puts them before all items of their block."""
    size = max(1, PACK_BYTES // (8 + width * np.dtype(kind).itemsize))
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, block = (batch.column(name).to_numpy() for name in ("id", "block"))
        values = batch.column("features").flatten().to_numpy(zero_copy_only=False)
        vectors = values.astype(kind).reshape(len(ids), width)
        lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(1))
        order = np.lexsort((-lengths, block))
        starts = np.flatnonzero(np.diff(block[order], prepend=-1))
        begins = np.concatenate([
            np.arange(a, b, size) for a, b in zip(starts, [*starts[1:], len(order)])])
        parts = [order[a:b] for a, b in zip(begins, [*begins[1:], len(order)])]
        yield pa.RecordBatch.from_arrays([
            pa.array([block[p[0]] for p in parts], pa.int32()),
            pa.array([np.inf if of_users else lengths[p[0]] for p in parts], pa.float64()),
            pa.array([ids[p].astype(np.int64).tobytes() for p in parts], pa.binary()),
            pa.array([vectors[p].tobytes() for p in parts], pa.binary()),
        ], names=["block", "reach", "ids", "vectors"])


def hidden(batches: Iterator[pa.RecordBatch]):
    """``(id, item, block)`` as rows that hold several pairs of one block. Their bound is no number,
    which puts them before the users of their block."""
    size = PACK_BYTES // 16
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, items, block = (column.to_numpy() for column in batch.columns)
        order = np.argsort(block, kind="stable")
        starts = np.flatnonzero(np.diff(block[order], prepend=-1))
        parts = [order[i:min(i + size, b)] for a, b in zip(starts, [*starts[1:], len(order)])
                 for i in range(a, b, size)]
        yield pa.RecordBatch.from_arrays([
            pa.array([block[p[0]] for p in parts], pa.int32()),
            pa.array(np.full(len(parts), np.nan)),
            pa.array([ids[p].astype(np.int64).tobytes() for p in parts], pa.binary()),
            pa.array([items[p].astype(np.int64).tobytes() for p in parts], pa.binary()),
        ], names=["block", "reach", "ids", "vectors"])


class Best:
    """The lists of some users so far, best first, equal scores by item. ``seen`` has users' and
    items' ids, pairs that are in no list."""

    def __init__(self, ids, vectors, k: int, single: bool, seen=None):
        self.ids, self.exact, self.single = ids, vectors.astype(np.float64), single
        self.lengths = np.sqrt((self.exact**2).sum(1))
        with np.errstate(over="ignore"):
            self.rough = vectors.astype(np.float32)
        self.scores = np.full((len(ids), k), -np.inf)
        self.items = np.full((len(ids), k), NONE)
        self.seen = None
        if seen is not None:
            order = np.argsort(ids)
            place = np.minimum(np.searchsorted(ids, seen[0], sorter=order), len(ids) - 1)
            rows = order[place]
            known = ids[rows] == seen[0]
            rows, others = rows[known], seen[1][known]
            order = np.argsort(others, kind="stable")
            self.seen = rows[order], others[order]

    def hidden(self, ids):
        """Users who have seen some of the items, in their order, and the places of those."""
        rows, items = self.seen
        begins, ends = (np.searchsorted(items, ids, side) for side in ("left", "right"))
        item = np.repeat(np.arange(len(ids)), ends - begins)
        firsts = np.cumsum(ends - begins) - (ends - begins)
        row = rows[np.arange(len(item)) + np.repeat(begins - firsts, ends - begins)]
        order = np.argsort(row, kind="stable")
        return row[order], item[order]

    def meet(self, ids, vectors) -> None:
        """Compare with some items."""
        exact = vectors.astype(np.float64)
        reach = np.sqrt((exact**2).sum(1)).max()
        k, width = self.scores.shape[1], exact.shape[1]
        is_rough = self.lengths.max() * reach < 1e30 and max(self.lengths.max(), reach) < 1e30
        kind = np.float32 if is_rough else np.float64
        users, others = self.rough if is_rough else self.exact, exact.astype(kind).T
        # How far a rounded product may be off, and a score that is rounded to single precision.
        slack = self.lengths * reach * ((width + 4) * np.finfo(kind).eps)
        slack += self.lengths * reach * 1e-7 * self.single + (1e-36 if is_rough else 0)
        live = np.flatnonzero(self.lengths * reach + slack >= self.scores[:, -1])
        seen = self.hidden(ids) if self.seen is not None else None
        for begin in range(0, len(live), USERS):
            rows = live[begin:begin + USERS]
            products = users[rows] @ others
            if seen is not None:
                a, b = np.searchsorted(seen[0], [rows[0], rows[-1] + 1])
                place = np.searchsorted(rows, seen[0][a:b])
                there = rows[place] == seen[0][a:b]
                products[place[there], seen[1][a:b][there]] = -np.inf
            floor = self.scores[rows, -1] - slack[rows]
            near = np.flatnonzero(products.max(1) >= floor)
            if not len(near):
                continue
            rows, products, floor = rows[near], products[near], floor[near]
            found = products >= floor[:, None]
            if np.count_nonzero(found) > 4 * k * len(rows) and products.shape[1] > k:
                last = np.partition(products, -k, axis=1)[:, -k]
                found = products >= np.maximum(floor, last - 2 * slack[rows])[:, None]
            if seen is not None:
                found &= products > -np.inf
            row, item = np.nonzero(found)
            self.add(rows, row, ids[item], self.score(rows[row], exact[item]))

    def score(self, rows, vectors):
        left, total = self.exact[rows], np.zeros(len(rows))
        for i in range(left.shape[1]):
            total += left[:, i] * vectors[:, i]
        return total.astype(np.float32).astype(np.float64) if self.single else total

    def add(self, rows, row, items, scores) -> None:
        """Entries for ``rows``, each for the one at place ``row`` of them."""
        n, k = len(rows), self.scores.shape[1]
        row = np.concatenate([np.repeat(np.arange(n), k), row])
        scores = np.concatenate([self.scores[rows].ravel(), scores])
        items = np.concatenate([self.items[rows].ravel(), items])
        order = np.lexsort((items, -scores, row))
        firsts = np.searchsorted(row[order], np.arange(n))
        kept = order[firsts[:, None] + np.arange(k)]
        self.scores[rows], self.items[rows] = scores[kept], items[kept]

    def lists(self) -> Iterator[pa.RecordBatch]:
        step = max(1, 1_000_000 // self.scores.shape[1])
        for begin in range(0, len(self.ids), step):
            items, scores = self.items[begin:begin + step], self.scores[begin:begin + step]
            there = scores > -np.inf
            offsets = pa.array(np.concatenate([[0], np.cumsum(there.sum(1))]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                pa.array(self.ids[begin:begin + step]),
                pa.ListArray.from_arrays(offsets, pa.array(items[there])),
                pa.ListArray.from_arrays(offsets, pa.array(scores[there])),
            ], names=["id", "items", "scores"])


def best_items(batches: Iterator[pa.RecordBatch], width: int, kind: str, k: int, single: bool):
    """The lists of the users of each block, of packs sorted by block and falling reach."""
    block, best, users, items, seen = None, None, [], [], []

    def whole(packs):
        ids = np.concatenate([np.frombuffer(p[0], np.int64) for p in packs])
        return ids, np.concatenate([np.frombuffer(p[1], kind).reshape(-1, width) for p in packs])

    def pairs():
        if seen:
            return [np.concatenate([np.frombuffer(p[i], np.int64) for p in seen]) for i in (0, 1)]

    def met():
        nonlocal best
        if users:
            best = best or Best(*whole(users), k, single, pairs())
            seen.clear()
            if items:
                best.meet(*whole(items))
        items.clear()

    held = 0
    for batch in batches:
        for number, reach, ids, vectors in zip(*(column.to_pylist() for column in batch.columns)):
            if number != block:
                met()
                if best is not None:
                    yield from best.lists()
                block, best, users, held = number, None, [], 0
                seen.clear()
            if np.isnan(reach):
                seen.append((ids, vectors))
                continue
            if np.isinf(reach):
                users.append((ids, vectors))
                continue
            items.append((ids, vectors))
            held += len(ids) // 8  # ids are eight bytes each
            if held >= ITEMS:
                met()
                held = 0
    met()
    if best is not None:
        yield from best.lists()


def _lists(users, items, k: int, width: int, kind: str, single: bool, sizes, pairs: int = PAIRS,
           seen=None, n_seen: int = 0):
    """``LISTS`` for vectors ``(id, features)`` that have ``width`` finite components each. Rows of
    users are told apart, also if they share an id. The ``n_seen`` pairs ``(id, item)`` of ``seen``
    are left out; users have one row each then, and all scores are finite."""
    spark, (n_users, n_items) = users.sparkSession, sizes
    k = min(k, n_items)
    if not n_users or k < 1:
        return spark.createDataFrame([], LISTS)
    blocks = max(1, min(
        -(-n_users * n_items // pairs),
        max(2 * spark.sparkContext.defaultParallelism, -(-n_users * (k + width) // ENTRIES))))
    blocks = max(blocks, -(-2 * n_seen // ENTRIES))
    columns = F.col("id").cast("bigint").alias("id"), "features"
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block")
    askers = users.select(*columns, block).mapInArrow(
        partial(packed, width=width, kind=kind, of_users=True), PACKS)
    if seen is not None:
        askers = askers.unionByName(seen.select("id", "item", block).mapInArrow(hidden, PACKS))
    packs = items.select(*columns, F.lit(0).alias("block")).mapInArrow(
        partial(packed, width=width, kind=kind, of_users=False), PACKS)
    copies = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    both = askers.unionByName(packs.select(copies, "reach", "ids", "vectors"))
    sorted_packs = both.repartitionById(blocks, F.col("block")).sortWithinPartitions(
        "block", F.desc("reach"))
    return sorted_packs.mapInArrow(
        partial(best_items, width=width, kind=kind, k=k, single=single), LISTS)


def _usable(width: int) -> Column:
    finite = F.forall("features", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return F.coalesce(F.col("id").isNotNull() & (F.size("features") == width) & finite, F.lit(False))


def top_k(users: DataFrame, items: DataFrame, k: int, pairs: int = PAIRS) -> DataFrame:
    """``(id, rank, item, score)`` for given vectors ``(id, features)``: the ``k`` items with the
    largest dot products, equal ones by id.

    Vectors of the commonest number of components are compared as matrices. Those with nulls, of
    another number of components or without a finite value are compared one by one: they have scores
    that are null, or not a number, with all others.
    """
    sized = items.groupBy(F.size("features").alias("width")).count()
    widest = sized.where("width > 0").orderBy(F.desc("count"), "width").first()
    width = widest.width if widest else 1
    kind = "f4" if dict(items.dtypes)["features"] == dict(users.dtypes)["features"] == (
        "array<float>") else "f8"
    usable = _usable(width)
    sizes, odd = [], []
    for rows in (users, items):
        whole, others = rows.agg(F.count_if(usable), F.count_if(~usable)).first()
        sizes.append(whole)
        odd.append(others)
    lists = _lists(users.where(usable), items.where(usable), k, width, kind, False, sizes, pairs)
    scores = lists.select("id", F.inline(F.arrays_zip("items", "scores"))).toDF(
        "id", "item", "score")
    if any(odd):
        parts = [_one_by_one(users.where(~usable), items, pairs),
                 _one_by_one(users.where(usable), items.where(~usable), pairs)]
        parts = [materialize(_ranked(part, k), "scores") for part in (scores, *parts)]
        scores = reduce(DataFrame.unionByName, parts)
    return _ranked(scores, k).select(
        F.col("id").cast(dict(users.dtypes)["id"]), "rank",
        F.col("item").cast(dict(items.dtypes)["id"]), "score")


def _ranked(scores: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "item"))
    return scores.withColumn("rank", rank).where(F.col("rank") <= k)


def _one_by_one(users: DataFrame, items: DataFrame, pairs: int) -> DataFrame:
    """All pairs with their scores; users lie in blocks that meet a copy of the items."""
    blocks = max(1, -(-users.count() * items.count() // pairs))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block")
    copies = F.explode(F.sequence(*(F.lit(n).cast("bigint") for n in (0, blocks - 1)))).alias("block")
    items = items.select(F.col("id").alias("item"), F.col("features").alias("other"), copies)
    return users.select("id", "features", block).join(items, "block").select(
        F.col("id").cast("bigint").alias("id"), F.col("item").cast("bigint").alias("item"),
        dot("features", "other").alias("score"))


def _recommended(model: ALSModel, users: DataFrame, n_users: int, n_items: int, k: int,
                 **seen) -> DataFrame:
    """``(user_id_int, recommendations)`` for some of the model's user factors."""
    lists = _lists(users.select("id", "features"), model.itemFactors, k, model.rank, "f4", True,
                   (n_users, n_items), **seen)
    entries = F.transform(F.arrays_zip("items", "scores"), lambda x: F.struct(
        x["items"].cast("int").alias("product_id_int"), x["scores"].cast("float").alias("rating")))
    return lists.select(F.col("id").cast("int").alias("user_id_int"), entries.alias(
        "recommendations"))


def recommend_all(model: ALSModel, k: int = LIST_LENGTH) -> DataFrame:
    """The ``k`` best products of every user of the model, rated ones included."""
    if k <= 0:
        raise ValueError("k is at least 1")
    lists = _recommended(
        model, model.userFactors, model.userFactors.count(), model.itemFactors.count(), k)
    return materialize(lists, "recommendations")


def recommend_for(model: ALSModel, wanted: DataFrame) -> DataFrame:
    """The same for the users in ``wanted``, a written table with one row ``(user_id, k)`` each;
    unknown ones are left out. Each list has the length its own row asks for, or all products if
    fewer. Users are put into classes by that length, rounded up to a power of two, so that one
    long list does not make all lists long."""
    n_items = max(model.itemFactors.count(), 1)
    wanted = wanted.where(F.col("user_id").between(0, INT_MAX) & (F.col("k") > 0)).select(
        F.col("user_id").cast("int").alias("user_id_int"),
        F.least("k", F.lit(n_items)).cast("int").alias("k"))
    power = F.ceil(F.log2(F.greatest("k", F.lit(SHORTEST)))).cast("int")
    known = materialize(wanted.select("*", power.alias("power")).join(
        model.userFactors.withColumnRenamed("id", "user_id_int"), "user_id_int"), "wanted")
    classes = dict(known.groupBy("power").count().collect())  # 31 at most
    lists = [model.userFactors.sparkSession.createDataFrame(
        [], "user_id_int int, recommendations array<struct<product_id_int:int,rating:float>>")]
    for number, n_users in sorted(classes.items()):
        users = known.where(F.col("power") == number)
        once = users.select(F.col("user_id_int").alias("id"), "features").dropDuplicates(["id"])
        found = _recommended(model, once, n_users, n_items, 2**number)
        lists.append(found.join(users.select("user_id_int", "k"), "user_id_int").select(
            "user_id_int", F.slice("recommendations", 1, F.col("k")).alias("recommendations")))
    return materialize(reduce(DataFrame.unionAll, lists), "recommendations")


def recommend_unseen(model: ALSModel, seen: DataFrame, k: int = LIST_LENGTH) -> DataFrame:
    """``(user_id_int, rank, product_id_int, score)``: the ``k`` best products of every user of the
    model that are not in ``seen``, rows ``(user_id_int, product_id_int)``.

    What a user has seen is hidden while the lists are made. Users who have seen more than
    ``MOST_SEEN`` products, ``n`` say, get a list of at least ``k + n`` instead, so ``k`` are left
    whatever they are, and what is seen is taken out by an anti join of entries. So no task
    holds all that such a user has seen.
    """
    pairs = materialize(
        seen.select("user_id_int", "product_id_int").dropna().distinct(), "seen")
    counts = materialize(pairs.groupBy("user_id_int").agg(F.count("*").alias("n")), "counts")
    is_many = F.col("n") > MOST_SEEN
    n_many, n_seen = counts.agg(
        F.count_if(is_many), F.coalesce(F.sum(F.when(~is_many, F.col("n"))), F.lit(0))).first()
    users, few, many = model.userFactors, pairs, counts.where(is_many)
    if n_many:
        users = users.join(many, F.col("id") == F.col("user_id_int"), "left_anti")
        few = pairs.join(many, "user_id_int", "left_anti")
    few = few.select(F.col("user_id_int").alias("id"), F.col("product_id_int").alias("item"))
    lists = long_form(materialize(_recommended(
        model, users, users.count(), model.itemFactors.count(), k, seen=few, n_seen=n_seen),
        "recommendations"))
    if not n_many:
        return lists
    wanted = materialize(many.select(
        F.col("user_id_int").alias("user_id"), (F.col("n") + k).alias("k")), "lengths")
    left = long_form(recommend_for(model, wanted)).join(
        pairs, ["user_id_int", "product_id_int"], "left_anti")
    place = F.row_number().over(Window.partitionBy("user_id_int").orderBy("rank"))
    return lists.unionByName(left.withColumn("rank", place).where(F.col("rank") <= k).select(
        "user_id_int", "rank", "product_id_int", "score"))


def long_form(recs: DataFrame, *keys: str, length: int | None = None) -> DataFrame:
    """One row an entry: ``(*keys, rank, product_id_int, score)``, ranks from 1; ``length``
    cuts longer lists."""
    keys = keys or ("user_id_int",)
    entries = F.col("recommendations")
    if length is not None:
        entries = F.slice(entries, 1, length)
    return recs.select(*keys, F.posexplode(entries).alias("pos", "item")).select(
        *keys,
        (F.col("pos") + 1).alias("rank"),
        F.col("item.product_id_int").alias("product_id_int"),
        F.col("item.rating").cast("double").alias("score"),
    )
