"""Vector codes and centroid clustering against plain versions."""

import hashlib
import math
import random

import numpy as np
import pytest

from tripflow.llm import grid_codes
from tripflow.llm.centroids import choose_pivots, cluster_vectors, nearest
from tripflow.llm.grid_codes import Cells, compress_vectors
from tripflow.llm.vectors import join_groups

SCHEMA = "vec_id long, embedding array<float>, label int, id long, v string, n long"
NAN, INF = float("nan"), float("inf")


@pytest.fixture
def make_vectors(spark):
    """Rows of embeddings, with further columns whose names the operators use inside."""

    def make(vectors, ids=None, labels=None):
        ids = list(range(len(vectors))) if ids is None else ids
        labels = [k % 3 for k in range(len(vectors))] if labels is None else labels
        rows = [(i, x, lab, -1, "clash", 7) for i, x, lab in zip(ids, vectors, labels, strict=True)]
        return spark.createDataFrame(rows, SCHEMA)

    return make


def whole(vectors, scale):
    return [[math.floor(scale * float(np.float32(x))) for x in v] for v in vectors]


def dist(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def best(v, centres):
    return min(range(len(centres)), key=lambda k: (dist(v, centres[k]), k))


def lloyd(points, centres, rounds):
    centres = [list(c) for c in centres]
    for _ in range(rounds):
        held = {}
        for v in points:
            held.setdefault(best(v, centres), []).append(v)
        for k, vs in held.items():
            centres[k] = [sum(col) // len(vs) for col in zip(*vs, strict=True)]
    return centres, [best(v, centres) for v in points]


def gaussian(n, dims, seed=3):
    rng = random.Random(seed)
    return [[rng.gauss(0, 0.125) for _ in range(dims)] for _ in range(n)]


def plain_codes(vectors, ids, labels, parts, entries, rounds, scale=1024):
    rows = whole(vectors, scale)
    w = len(rows[0]) // parts
    order = sorted(range(len(rows)), key=lambda k: (ids[k] is None, ids[k] or 0, rows[k]))
    codes, error, books = [""] * len(rows), [0] * len(rows), []
    for p in range(parts):
        mine = [r[p * w : (p + 1) * w] for r in rows]
        centres, at = lloyd(mine, [mine[k] for k in order[:entries]], rounds)
        books.append(centres)
        for k, c in enumerate(at):
            codes[k] += f"{c:02x}"
            error[k] += dist(mine[k], centres[c])
    total = {}
    for lab, e in zip(labels, error, strict=True):
        total[lab] = total.get(lab, 0) + e
    return [(i, lab, c, e, total[lab]) for i, lab, c, e in zip(ids, labels, codes, error, strict=True)], books


def key(row):
    return tuple((x is None, x or 0) for x in row)


@pytest.mark.parametrize(("entries", "cache"), [(16, 1 << 14), (256, 5)])
def test_codes(make_vectors, monkeypatch, entries, cache):
    monkeypatch.setattr(grid_codes, "CACHE", cache)
    vectors = gaussian(300, 8)
    vectors += vectors[:40] + [[0.0] * 8] * 100  # repeated rows, a group of a quarter
    ids = [None, None, *range(len(vectors) - 3, 0, -1), 5]
    labels = [None if k % 5 == 0 else (7 if k > 250 else k % 4) for k in range(len(vectors))]
    got, books = compress_vectors(make_vectors(vectors, ids, labels).repartition(3), 4, entries, 4)
    want, plain = plain_codes(vectors, ids, labels, 4, entries, 4)
    assert books.tolist() == plain
    rows = [(r.vec_id, r.label, r.code, r.error, r.label_error) for r in got.collect()]
    assert sorted(rows, key=key) == sorted(want, key=key)


def test_codes_of_odd_rows(make_vectors):
    good = gaussian(20, 6)  # 6 components: filled up to 8
    odd = [None, [], [0.1] * 5, [NAN, *good[0][1:]], [INF, *good[0][1:]], [*good[0][:5], None]]
    docs = make_vectors(good + odd)
    got, books = compress_vectors(docs, 4, 8, 2)
    want, plain = plain_codes([[*v, 0.0, 0.0] for v in good], list(range(20)), [k % 3 for k in range(20)], 4, 8, 2)
    assert books.tolist() == plain
    rows = [(r.vec_id, r.label, r.code, r.error, r.label_error) for r in got.collect()]
    assert sorted(rows) == sorted(want)
    for none in (docs.limit(0), make_vectors([None, [NAN]])):
        got, books = compress_vectors(none)
        assert got.count() == 0 and books.size == 0
    got, _ = compress_vectors(make_vectors([[], []]))
    assert [(r.code, r.error) for r in got.collect()] == [("00000000", 0)] * 2
    huge, _ = compress_vectors(make_vectors([[3e38] * 4, [-3e38] * 4, [0.0] * 4]))
    assert {r.vec_id: r.error for r in huge.collect()} == {0: 0, 1: 0, 2: 0}


def test_cells_keep_all_nearest():
    rng = np.random.default_rng(5)
    entries = rng.integers(-300, 300, (60, 5))
    entries[30:] = entries[:30]  # ties
    cells = Cells(entries, most=50)
    rows = rng.integers(-400, 400, (3000, 5))
    index, d = cells.nearest(rows)
    every = ((rows[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (index == every.argmin(axis=1)).all() and (d == every.min(axis=1)).all()
    assert cells.taken < every.size / 2 and len(cells.known) <= 50
    again = cells.missed
    cells = Cells(entries)
    cells.nearest(rows)
    cells.nearest(rows)
    assert cells.missed <= again and cells.asked == 6000 and cells.missed <= 3000


def plain_clusters(vectors, ids, k, rounds, scale):
    rows = whole(vectors, scale)
    hashed = [hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest() for i in ids]
    order = sorted(range(len(rows)), key=lambda j: (hashed[j], rows[j]))
    centres, at = lloyd(rows, [rows[j] for j in order[:k]], rounds)
    d = [dist(r, centres[c]) for r, c in zip(rows, at, strict=True)]
    by = {}
    for c, x in zip(at, d, strict=True):
        by[c] = by.get(c, 0) + x
    return [(i, c, x, by[c], sum(d), centres[c]) for i, c, x in zip(ids, at, d, strict=True)]


def test_clusters(make_vectors):
    vectors = gaussian(200, 6) + [[0.5] * 6] * 90
    vectors += vectors[:20]
    ids = [None, None, 7, 7, *range(100, 100 + len(vectors) - 4)]
    odd = [None, [], [0.1] * 5, [NAN] * 6, [-INF] * 6, [None] * 6]
    docs = make_vectors(vectors + odd, [*ids, *[9000] * 6])
    got = cluster_vectors(docs.repartition(3), k=16, rounds=3, dims=6)
    rows = [(r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, list(r.centroid)) for r in got.collect()]
    assert sorted(rows, key=lambda r: key(r[:3])) == sorted(
        plain_clusters(vectors, ids, 16, 3, 64), key=lambda r: key(r[:3])
    )


def test_clusters_of_few_and_none(make_vectors):
    got = cluster_vectors(make_vectors([[1.0, 2.0], [1.0, 2.0], [3.0, 3.0]]), k=16, rounds=2, dims=2).collect()
    assert {r.vec_id: r.distance for r in got} == {0: 0, 1: 0, 2: 0}
    none = cluster_vectors(make_vectors([[1.0]]), dims=2)
    assert none.count() == 0 and set(none.columns) == set(cluster_vectors(make_vectors([[1.0]]), dims=1).columns)


def test_pivots_skip_without_loss():
    rng = np.random.default_rng(2)
    centroids = rng.integers(-200, 200, (16, 12))
    centroids[9] = centroids[3]
    rows = centroids[rng.integers(0, 16, 2000)] + rng.integers(-20, 20, (2000, 12))
    pivots = choose_pivots(rows[:64])
    table = ((rows[:, None, :] - pivots[None]) ** 2).sum(axis=2)
    label, d, taken = nearest(rows, table, centroids, pivots)
    every = ((rows[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (label == every.argmin(axis=1)).all() and (d == every.min(axis=1)).all()
    assert taken < every.size / 2


def test_join_groups_splits_hot_and_cold(spark):
    rows = spark.range(4000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS g")
    groups = rows.groupBy("g").count()
    out = join_groups(rows, groups, ["g"], "count", 4000)
    assert out.count() == 4000 and out.filter("g = 0").select("count").distinct().collect()[0][0] == 1334 + 0
