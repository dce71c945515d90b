import hashlib
import math
import random

import numpy as np

from affinity.llm import clusters

KIND = "vec_id long, embedding array<double>"


def brute(rows, k, rounds, dims, scale=256, salt="2:"):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    sha = lambda i: hashlib.sha256(f"{salt}{'' if i is None else i}".encode()).hexdigest()
    cs = [v for _, _, v in sorted((sha(i), v, v) for i, v in kept)[:k]]
    d2 = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min((d2(v, c), n) for n, c in enumerate(cs))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        cs = [[sum(col) // len(groups[n]) for col in zip(*groups[n])] if n in groups else c for n, c in enumerate(cs)]
    out = [(i, near(v)) for i, v in kept]
    per = {}
    for _, (d, n) in out:
        per[n] = per.get(n, 0) + d
    return sorted(((i, n, d, per[n], sum(per.values()), cs[n]) for i, (d, n) in out), key=repr)


def got(df, **options):
    return sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, list(r.centroid))
                   for r in clusters.cluster(df, **options).collect()), key=repr)


def test_against_brute_force(rows_of):
    rnd = random.Random(5)
    rows = [(i, [rnd.gauss(i % 7, 0.4) for _ in range(6)]) for i in range(300)]
    rows += [(1000 + i, [1.5] * 6) for i in range(150)]  # copies: a third of all
    rows += [(7, rows[7][1]), (None, [0.1] * 6), (None, [0.2] * 6)]
    rows += [(2000, None), (2001, []), (2002, [1.0] * 5), (2003, [1.0, None] + [0.0] * 4), (2004, [math.nan] * 6), (2005, [math.inf] + [0.0] * 5)]
    df = rows_of(rows, KIND, parts=7)
    for k, rounds in ((12, 5), (1, 2), (40, 0)):
        assert got(df, k=k, rounds=rounds, dims=6) == brute(rows, k, rounds, 6)


def test_equal_distances_go_to_the_smaller_number(rows_of):
    grid = [(i, [float(i % 3), float(i // 3 % 3)]) for i in range(36)]  # every point four times: equal centroids
    assert got(rows_of(grid, KIND), k=9, rounds=3, dims=2, scale=2) == brute(grid, 9, 3, 2, scale=2)


def test_fewer_vectors_than_centroids_empty_table_and_other_columns(rows_of):
    rows = [(i, [float(i), 0.0]) for i in range(5)]
    df = rows_of([(*r, "x", 1) for r in rows], KIND + ", id string, v int")
    assert got(df, k=40, rounds=5, dims=2) == brute(rows, 40, 5, 2)
    assert clusters.cluster(df.limit(0), dims=2).count() == 0
    assert got(df, k=3, dims=64) == []


def test_components_too_large_for_exact_distances_take_no_part(rows_of):
    top = clusters.largest(64)
    assert top == 1 << 26
    rows = [(1, [top / 256] * 64), (2, [-top / 256] * 64), (3, [float(top)] * 64)]
    out = got(rows_of(rows, KIND), k=2, rounds=1)
    assert [r[0] for r in out] == [1, 2] and out == brute(rows[:2], 2, 1, 64)


def test_orchard_looks_at_few_centroids():
    rnd = np.random.default_rng(3)
    centroids = rnd.integers(-5000, 5000, (60, 2))
    points = centroids[rnd.integers(0, 60, 4000)] + rnd.integers(-40, 40, (4000, 2))
    order, gaps = clusters.neighbour_lists(centroids)
    best, dist = clusters.orchard(points, centroids, order, gaps)
    every = ((points[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (best == every.argmin(axis=1)).all() and (dist == every.min(axis=1)).all()
