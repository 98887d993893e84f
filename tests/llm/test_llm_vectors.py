"""Whitening and centroid clustering against brute force, with awkward rows."""

import hashlib
import math

import numpy as np
import pytest

from shelfwise.llm import clusters, whitening

NAN, INF = float("nan"), float("inf")
VECTORS = "vec_id long, embedding array<double>, x string, cluster string, n int"


def awkward(dims):
    return [None, [], [NAN] * dims, [None] + [1.0] * (dims - 1), [INF] + [0.0] * (dims - 1),
            [-INF] * dims, [1.0] * (dims + 1)]


def vector_table(spark, rows, ids=None):
    ids = range(len(rows)) if ids is None else ids
    return spark.createDataFrame([(i, v, "x", "c", 7) for i, v in zip(ids, rows)], VECTORS)


def invented(dims, n, seed=3):
    """Clustered vectors with copies, a hot copy, and a zero vector."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    rows = [list(map(float, centres[i % 6] + 0.3 * rng.normal(size=dims))) for i in range(n)]
    return rows + rows[:5] + [rows[0]] * (n // 3) + [[0.0] * dims]


def whole(row):
    return [math.floor(256 * c) for c in row]


def test_whitening_equals_brute_force(spark):
    rows = invented(8, 150) + awkward(8)
    found = whitening.whiten(vector_table(spark, rows)).collect()
    kept = {i: whole(v) for i, v in enumerate(rows) if i < len(rows) - 7}
    fit = np.array(sorted(set(map(tuple, kept.values()))))
    n, sums = len(fit), fit.sum(0)
    centred = fit - sums / n
    covariance = centred.T @ centred / n
    values, x = np.linalg.eigh(covariance)
    values, x = values[::-1], x[:, ::-1]
    assert len(found) == 4 * len(kept)
    assert {r.n for r in found} == {n}
    for k in range(1, 5):
        mine = {r.vec_id: r for r in found if r.component == k}
        assert set(mine) == set(kept)
        wanted = {i: (np.array(v) - sums / n) @ x[:, k - 1] / np.sqrt(values[k - 1])
                  for i, v in kept.items()}
        sign = np.sign(wanted[1] * mine[1].whitened)
        for i, row in mine.items():
            assert row.whitened == pytest.approx(sign * wanted[i], rel=1e-9, abs=1e-10)
            assert row.deviation == sum((n * a - int(s)) ** 2 for a, s in zip(kept[i], sums))
            assert row.explained == pytest.approx(values[k - 1] / values.sum(), rel=1e-12)
            assert row.identity_error < 1e-10
    assert len({(r.component, r.explained, r.identity_error) for r in found}) == 4


def test_whitening_of_few_or_no_vectors(spark):
    assert whitening.whiten(vector_table(spark, [[1.0, 2.0]]).limit(0)).count() == 0
    assert whitening.whiten(vector_table(spark, awkward(2)[:-1])).count() == 0
    assert whitening.whiten(vector_table(spark, [[1.0, 2.0]] * 3)).count() == 0
    two = whitening.whiten(vector_table(spark, [[1.0, 2.0], [2.0, 2.0], [1.0, 2.0]])).collect()
    assert [(r.component, r.explained) for r in two] == [(1, 1.0)] * 3
    assert sorted(abs(r.whitened) for r in two) == pytest.approx([1, 1, 1])


def test_eigenvectors_are_right_to_high_precision():
    rng = np.random.default_rng(5)
    turn = np.linalg.qr(rng.normal(size=(24, 24)))[0].astype(np.longdouble)
    for _ in range(3):  # orthonormal beyond double precision
        turn = turn + turn @ (np.eye(24) - turn.T @ turn) / 2
    # Far apart, closer than float32 can tell, and equal.
    values = np.array([900, 500, 500 - 1e-6, 500 - 3e-6, 20, 20, 20, 3, *np.linspace(2, 1, 16)],
                      np.longdouble)
    matrix = (turn * values) @ turn.T
    found, x = whitening.eigenvectors((matrix + matrix.T) / 2)
    assert np.abs(found - values).max() < 1e-14 * 900
    assert np.abs(x.T @ x - np.eye(24)).max() < 1e-16
    for i in [0, 1, 2, 3, 7, 15, 23]:  # determined up to the sign
        assert abs(abs(turn[:, i] @ x[:, i]) - 1) < 1e-15
        assert np.abs(x[:, i] - np.sign(turn[:, i] @ x[:, i]) * turn[:, i]).max() < 1e-10
    space = x[:, 4:7]
    assert np.abs(space @ space.T - turn[:, 4:7] @ turn[:, 4:7].T).max() < 1e-14
    plain = np.linalg.eigh(matrix.astype(np.float32))[1]
    assert np.abs(plain.T @ turn[:, 1:4]).max() < 1 - 1e-9  # which float32 does not know


def lloyd(rows, ids, k, rounds):
    """Plain rounds in whole numbers of any size."""
    first = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), row)
                   for i, row in zip(ids, rows) if i is not None)
    centres = [row for _, row in first[:k]]

    def assign():
        far = [[sum((a - b) ** 2 for a, b in zip(row, c)) for c in centres] for row in rows]
        return [d.index(min(d)) for d in far], [min(d) for d in far]

    for _ in range(rounds):
        own, _ = assign()
        for c in range(len(centres)):
            members = [row for row, o in zip(rows, own) if o == c]
            if members:
                centres[c] = [sum(column) // len(members) for column in zip(*members)]
    return *assign(), centres


@pytest.mark.parametrize("scale", [1, 1e5])
def test_clusters_equal_brute_force(spark, scale):
    rows = [[c * scale for c in row] for row in invented(8, 200)]
    ids = [*range(len(rows) - 9), *[3] * 4, *[None] * 5]
    table = vector_table(spark, rows + awkward(8), ids + [900 + i for i in range(7)])
    found = clusters.cluster(table, k=9, rounds=5, dims=8).collect()
    own, far, centres = lloyd(list(map(whole, rows)), ids, 9, 5)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    inertia = [sum(d for d, o in zip(far, own) if o == c) for c in range(9)]
    wanted = [(i, o, d, inertia[o], sum(far), digest[o]) for i, o, d in zip(ids, own, far)]
    assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)


def test_clusters_with_equal_centroids_and_few_vectors(spark):
    same = clusters.cluster(vector_table(spark, [[1.0, 2.0]] * 5), k=3, rounds=2, dims=2).collect()
    assert {(r.cluster, r.distance, r.inertia) for r in same} == {(0, 0, 0)} and len(same) == 5
    one = clusters.cluster(vector_table(spark, [[1.0, -2.0]]), k=3, rounds=2, dims=2).collect()
    assert [(r.cluster, r.distance) for r in one] == [(0, 0)]
    none = clusters.cluster(vector_table(spark, [[1.0, 2.0]], [None]), dims=2).collect()
    assert [(r.vec_id, r.cluster, r.distance) for r in none] == [(None, None, None)]
    assert clusters.cluster(vector_table(spark, awkward(2)), dims=2).count() == 0


def test_approach_bounds_every_point_of_the_sphere():
    rng = np.random.default_rng(8)
    tighter = 0
    for dims in (2, 5):
        old = rng.integers(-900, 900, (12, dims))
        new = old + rng.integers(-300, 300, (12, dims)) * (rng.random((12, 1)) < 0.8)
        radius = rng.uniform(0, 700, 12)
        bound = clusters.approach(old, new, radius)
        drift = np.sqrt(((new - old) ** 2).sum(1))
        for i in range(12):
            step = rng.normal(size=(4000, dims))
            step *= (radius[i] * rng.random((4000, 1)) ** 0.1) / np.sqrt((step ** 2).sum(1))[:, None]
            points = (old[i] + step)[:, None, :]
            nearer = (np.sqrt(((points - old) ** 2).sum(2)) - np.sqrt(((points - new) ** 2).sum(2)))
            nearer[:, i] = 0
            assert nearer.max() <= bound[i] + 1e-9
            tighter += bound[i] < 0.95 * np.delete(drift, i).max()
    assert tighter > 6


def test_bounds_spare_most_comparisons():
    rng = np.random.default_rng(2)
    middle = rng.integers(-2000, 2000, (20, 16))
    rows = np.concatenate([m + rng.integers(-90, 90, (100, 16)) for m in middle])
    old = middle + rng.integers(-40, 40, middle.shape)
    move = clusters.Move(old)
    cluster, upper, lower, scanned = move.settle(rows, None, None, None)
    assert scanned == len(rows)
    radius = np.array([upper[cluster == c].max(initial=0) for c in range(20)])
    move = clusters.Move(middle, old, radius)
    cluster, _, _, scanned = move.settle(rows, cluster, upper, lower)
    assert (cluster == clusters.squared_distances(rows, middle).argmin(1)).all()
    assert scanned < len(rows) / 20
