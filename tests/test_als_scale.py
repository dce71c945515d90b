"""What ALS fits, their lists and the grid write, shuffle and read again."""

import threading
import time
from types import SimpleNamespace

import numpy as np
import pytest

from affinity import session
from affinity.operators import metrics, products, recommend
from affinity.plans import recsys

from test_products import RATINGS, brute, frame, lists


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame(RATINGS, "user_id int, item_id int, rating double").persist()


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_code_is_shipped_once_by_threads_that_come_together():
    sent = []

    def add(path):
        sent.append(path)
        time.sleep(0.3)

    spark = SimpleNamespace(sparkContext=SimpleNamespace(addPyFile=add))
    threads = [threading.Thread(target=session.ship_code, args=(spark,)) for _ in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(sent) == 1


def test_points_of_a_grid_read_few_partitions(spark, train, monkeypatch):
    val = spark.createDataFrame([(u, i, 3.0) for u in range(30) for i in range(25) if (u + i) % 3 == 0], train.schema)
    seen, real = [], recommend.fit_als

    def noted(t, **options):
        seen.append((t.rdd.getNumPartitions(), t.count()))
        return real(t, **options)

    monkeypatch.setattr(recommend, "fit_als", noted)
    many = lambda df: df.repartition(40)
    recommend.tune(many(train), many(val), (2, 3), (0.1,), k=5, max_iter=2)
    assert len(seen) >= 2 and all(n <= 2 * spark.sparkContext.defaultParallelism and rows == len(RATINGS) for n, rows in seen)


def test_blocks_are_fewer_than_cores_until_they_would_be_large(spark, train, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    model = recommend.fit_als(train, rank=2, reg=0.1, max_iter=2)
    assert model.userFactors.rdd.getNumPartitions() == -(-cores // 2) < cores
    assert recommend.als_blocks(train, 1) == cores and recommend.als_blocks(train, 100) == 1
    monkeypatch.setattr(recommend, "RATINGS_PER_BLOCK", 50)
    assert recommend.als_blocks(train, 2) == -(-len(RATINGS) // 50) > cores


@pytest.mark.parametrize("per_user", [False, True])
def test_metrics_of_lists_are_those_of_rows(spark, per_user):
    rng = np.random.default_rng(3)
    got = {u: [int(i) for i in rng.permutation(60)[:rng.integers(1, 12)]] for u in range(40)} | {50: [1, 2], 51: []}
    as_lists = spark.createDataFrame([(u, x) for u, x in got.items()], "user_id int, items array<int>")
    as_rows = spark.createDataFrame([(u, r, i) for u, x in got.items() for r, i in enumerate(x, 1)], "user_id int, rank int, item_id int")
    seen = [(int(u), int(i)) for u in range(45) for i in rng.permutation(60)[:rng.integers(1, 30)]]
    truth = spark.createDataFrame(seen + seen[:50] + [(3, None), (None, 4), (51, 7)], "user_id int, item_id bigint")
    one = metrics.ranking_metrics_lists(as_lists, truth, 8, digits=None, per_user=per_user).collect()
    two = metrics.ranking_metrics(as_rows, truth, 8, digits=None, per_user=per_user).collect()
    key = lambda r: r[0]
    assert len(one) == len(two) == (40 if per_user else 1)
    for a, b in zip(sorted(one, key=key), sorted(two, key=key)):
        assert a.asDict() == pytest.approx(b.asDict())


@pytest.mark.parametrize("implicit", [False, True])
def test_lists_are_computed_once_for_their_metrics(spark, implicit):
    split = ["train", "train", "test"]
    s = spark.createDataFrame([(u, i, r, split[(u + 2 * i) % 3]) for u, i, r in RATINGS], "user_id int, item_id int, rating double, split string")
    df = recsys.als_quality(s, implicit, rank=3, reg=0.1, k=5)
    assert plan(df).count("MapInArrow") == 1
    assert df.first().n_users == s.filter("split = 'test'").select("user_id").distinct().count()


@pytest.mark.parametrize("group_bytes", [1, products.GROUP_BYTES])
def test_users_are_not_written_between_chunks(spark, monkeypatch, group_bytes):
    written, real = [], products.reliable_checkpoint
    monkeypatch.setattr(products, "reliable_checkpoint", lambda df: written.append(df.columns) or real(df))
    monkeypatch.setattr(products, "GROUP_BYTES", group_bytes, raising=False)
    rng = np.random.default_rng(4)
    users, items = rng.normal(size=(1300, 4)), rng.normal(size=(300, 4))
    got = lists(products.best_products(frame(spark, users), frame(spark, items), 7, chunk_bytes=4_000))
    assert got == brute(users, items, 7)
    assert all("user" not in c and "scores" not in c for c in written)


def test_recommendations_are_judged_without_a_window(spark, monkeypatch):
    rows = [(u, i, float(1 + (u * 3 + i) % 5), "train") for u in range(9) for i in range(7) if (u + i) % 4] + [(2, 99, 3.0, "test")]
    s = spark.createDataFrame(rows, "user_id int, item_id int, rating double, split string")
    monkeypatch.setattr(recsys, "fixture_splits", lambda spark, sf_dir: s)
    df = recsys.als_recommendations(spark, "")
    assert "Window" not in plan(df) and plan(df).count("MapInArrow") == 1
    got = df.collect()
    assert sorted(r.user_id for r in got) == list(range(9))
    assert {(r.n_items, r.first_rank, r.last_rank, r.n_distinct, r.n_from_train, r.ordered) for r in got} == {(7, 1, 7, 7, 7, True)}
    assert dict(df.dtypes) == {"user_id": "int", "n_items": "bigint", "first_rank": "int", "last_rank": "int", "n_distinct": "bigint",
                               "n_from_train": "bigint", "ordered": "boolean"}
