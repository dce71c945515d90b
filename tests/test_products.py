"""Pruned top-k products, the residual of a fit, and the grid's ledger."""

import os
from types import SimpleNamespace

import numpy as np
import pytest

from affinity.operators import products, recommend


def frame(spark, factors, ids=None):
    rows = [(int(i), [float(x) for x in f]) for i, f in zip(range(len(factors)) if ids is None else ids, factors)]
    return spark.createDataFrame(rows, "id int, features array<float>").repartition(3)


def brute(users, items, k, ids=None):
    ids = np.arange(len(items)) if ids is None else np.asarray(ids)
    scores = (users.astype(np.float32).astype(float) @ items.astype(np.float32).astype(float).T).astype(np.float32)
    order = np.lexsort((np.broadcast_to(ids, scores.shape), -scores), axis=-1)[:, :k]
    return {u: [(int(ids[i]), float(scores[u, i])) for i in row] for u, row in enumerate(order)}


def lists(df):
    return {r.user: list(zip(r["items"], r.scores)) for r in df.collect()}


@pytest.mark.parametrize("chunk_bytes", [products.CHUNK_BYTES, 24_000, 4_000])
def test_lists_equal_brute_force(spark, chunk_bytes, monkeypatch):
    monkeypatch.setattr(products, "BLOCK", 64)
    rng = np.random.default_rng(1)
    users = rng.normal(size=(70, 6))
    items = rng.normal(size=(900, 6)) * rng.gamma(1.0, 1.0, size=(900, 1))
    items[200:260] = items[0]  # equal scores
    items[300:320] = 0
    users[3], users[4] = 0, -users[5]
    got = lists(products.best_products(frame(spark, users), frame(spark, items), 10, chunk_bytes))
    assert got == brute(users, items, 10)


def test_users_leave_off_early_and_no_product_is_planned(spark, monkeypatch):
    monkeypatch.setattr(products, "BLOCK", 50)
    rng = np.random.default_rng(2)
    users, items = np.abs(rng.normal(size=(40, 4))), np.abs(rng.normal(size=(2000, 4))) * (1 / np.arange(1, 2001))[:, None]
    df = products.best_products(frame(spark, users), frame(spark, items), 5, chunk_bytes=12_000)
    assert lists(df) == brute(users, items, 5)
    assert max(r.blocks for r in df.collect()) <= 10 < 2000 / 50
    whole = products.best_products(frame(spark, users), frame(spark, items), 5)
    assert "Cartesian" not in whole._jdf.queryExecution().toString() and "NestedLoop" not in whole._jdf.queryExecution().toString()


def test_few_items_and_empty_tables(spark):
    users, items = np.ones((3, 2)), np.array([[1.0, 2.0], [3.0, -9.0]])
    assert lists(products.best_products(frame(spark, users), frame(spark, items, [7, 5]), 10)) == brute(users, items, 10, [7, 5])
    none = frame(spark, items).limit(0)
    assert lists(products.best_products(frame(spark, users), none, 10)) == {0: [], 1: [], 2: []}
    assert lists(products.best_products(none, frame(spark, items), 10)) == {}


RATINGS = [(u, i, float(1 + (u * 7 + i * 3) % 5)) for u in range(30) for i in range(25) if (u + i) % 3]


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame(RATINGS, "user_id int, item_id int, rating double").persist()


def test_lists_of_a_fit_are_those_of_spark(spark, train):
    model = recommend.fit_als(train, rank=5, reg=0.05)
    got = {(r.user_id, r.item_id): (r["rank"], r.score) for r in recommend.recommend_als(model, 8).collect()}
    want = {(r.user_id, x.item_id): x.rating for r in model.recommendForAllUsers(8).collect() for x in r.recommendations}
    assert set(got) == set(want) and all(abs(got[p][1] - want[p]) < 1e-5 for p in want)
    some = recommend.recommend_als(model, 8, users=spark.createDataFrame([(3,), (4,), (99,)], "user_id int"))
    assert {r.user_id for r in some.collect()} == {3, 4}


@pytest.mark.parametrize("implicit", [False, True])
def test_residual_of_fits_and_of_other_models(train, spark, implicit):
    ratings = train.unionAll(spark.createDataFrame([(40, 1, -2.0), (41, 2, 0.0)], train.schema)) if implicit else train
    model = recommend.fit_als(ratings, rank=4, reg=0.1, implicit=implicit, alpha=3.0)
    worst = lambda m, reg: max(r.residual for r in recommend.fit_residuals(m, ratings, reg, implicit, 3.0).collect())
    assert worst(model, 0.1) < 1e-5
    assert worst(model, 0.12) > 1e-3
    rng = np.random.default_rng(5)
    other = SimpleNamespace(rank=4, itemFactors=model.itemFactors,
                            userFactors=frame(spark, np.abs(rng.normal(size=(42, 4)))))
    assert worst(other, 0.1) > 0.05


def test_a_grid_goes_on_where_it_was_ended(spark, train, tmp_path, monkeypatch):
    val = spark.createDataFrame([(u, i, 3.0) for u in range(30) for i in range(25) if (u + i) % 3 == 0], "user_id int, item_id int, rating double")
    fits, real = [], recommend.fit_als

    def counted(t, rank, reg, **options):
        fits.append((rank, reg))
        if len(fits) == 5:
            raise RuntimeError("driver lost")
        return real(t, rank=rank, reg=reg, **options)

    monkeypatch.setattr(recommend, "fit_als", counted)
    run = lambda folder: recommend.tune(train, val, (2, 3), (0.05, 0.1, 0.5), k=5, max_iter=3, parallel=1, ledger=folder)
    folder = str(tmp_path / "ledger")
    with pytest.raises(RuntimeError, match="driver lost"):
        run(folder)
    done = set(fits[:4])
    assert len([f for f in os.listdir(f"{folder}/points") if not f.startswith(".")]) >= 4
    fits[:] = [None] * 10
    best, results, model = run(folder)
    again = [f for f in fits if f]
    refitted = (best["rank"], best["reg"])
    assert all(f not in done or f == refitted for f in again) and len(again) <= 3
    monkeypatch.setattr(recommend, "fit_als", real)
    alone = recommend.tune(train, val, (2, 3), (0.05, 0.1, 0.5), k=5, max_iter=3, parallel=3)
    assert best == alone[0] | {"ndcg": pytest.approx(alone[0]["ndcg"])} and best["ndcg"] > 0 and model.rank == best["rank"]
    by = lambda df: {(r["rank"], r.reg): pytest.approx((r.n_users, r.precision_at_k, r.ndcg_at_k, r.map_at_k)) for r in df.collect()}
    assert {p: m.expected for p, m in by(results).items()} == by(alone[1])


def test_only_items_that_may_enter_a_list_are_sorted(monkeypatch):
    """Items of equal norm cannot be pruned: all are multiplied, few are sorted, and the lists are exact."""
    rng = np.random.default_rng(7)
    items = rng.gamma(1.0, 1.0, size=(40_000, 8)).astype(np.float32).astype(float)
    items = (items / np.sqrt((items ** 2).sum(axis=1))[:, None]).astype(np.float32).astype(float)
    items[500:540] = items[0]  # equal scores
    order = np.lexsort((np.arange(len(items)), -np.sqrt((items ** 2).sum(axis=1))))
    users = rng.gamma(1.0, 1.0, size=(40, 8)).astype(np.float32).astype(float)
    sorted_entries, lexsort = [], np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys, axis=-1: sorted_entries.append(np.asarray(keys[0]).size) or lexsort(keys, axis=axis))
    names, scores, blocks, done = products.best_of_chunk(
        users, np.full((40, 20), -1, np.int64), np.full((40, 20), -np.inf, np.float32), order, items[order], -1.0)
    monkeypatch.undo()
    assert {u: list(zip(names[u].tolist(), scores[u].tolist())) for u in range(40)} == brute(users, items, 20)
    assert sum(sorted_entries) < 0.2 * 40 * len(items) and blocks.min() == 40 and done.all()
