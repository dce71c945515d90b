"""Ranking metrics against values computed with Spark's RankingMetrics."""

import pytest

from affinity.operators import metrics, recommend

CASES = [
    (list(range(1, 11)), [3, 9, 50]),
    ([1, 2, 3], [2, 3, 1, 7, 8]),
    ([1, 2], [9]),
    (list(range(4, 10)), [6, 4]),
]
# (k, precision, recall, ndcg, map)
EXPECTED = [
    (2, 0.375, 0.225, 0.4032868, 0.375),
    (5, 0.3, 0.4833333, 0.4692717, 0.3861111),
    (100, 0.0175, 0.5666667, 0.5045884, 0.4046296),
]


def frames(spark):
    recs = [(u, i + 1, it) for u, (p, _) in enumerate(CASES) for i, it in enumerate(p)]
    rel = [(u, it) for u, (_, l) in enumerate(CASES) for it in l]
    return (spark.createDataFrame(recs, "user_id int, rank int, item_id int"),
            spark.createDataFrame(rel, "user_id int, item_id int"))


@pytest.mark.parametrize("k,p,r,n,m", EXPECTED)
def test_metrics_values(spark, k, p, r, n, m):
    recs, rel = frames(spark)
    got = metrics.ranking_metrics(recs, rel, k, digits=None).first()
    assert got.n_users == 4
    assert got.precision_at_k == pytest.approx(p, abs=1e-7)
    assert got.recall_at_k == pytest.approx(r, abs=1e-7)
    assert got.ndcg_at_k == pytest.approx(n, abs=1e-7)
    assert got.map_at_k == pytest.approx(m, abs=1e-7)


def test_shared_list_equals_per_user_lists(spark):
    ranked = spark.createDataFrame([(it, i + 1) for i, it in enumerate([5, 3, 9, 1, 7])],
                                   "item_id int, rank int")
    rel = spark.createDataFrame([(1, 3), (1, 7), (2, 8), (3, 5), (3, 1), (3, 2)],
                                "user_id int, item_id int")
    users = rel.select("user_id").distinct()
    ranked2 = ranked.withColumn("popularity", ranked["rank"])
    recs = recommend.recommend_popular(users, ranked2, k=5)
    a = metrics.ranking_metrics_shared(ranked, rel, 5).first()
    b = metrics.ranking_metrics(recs, rel, 5).first()
    assert a == b


def test_duplicates_in_relevant_collapse(spark):
    recs = spark.createDataFrame([(1, 1, 10), (1, 2, 11)], "user_id int, rank int, item_id int")
    rel = spark.createDataFrame([(1, 10), (1, 10), (1, 12)], "user_id int, item_id int")
    got = metrics.ranking_metrics(recs, rel, 2).first()
    assert got.recall_at_k == 0.5


def test_mllib_ranking_metrics_agree(spark):
    from pyspark.mllib.evaluation import RankingMetrics
    recs, rel = frames(spark)
    rm = RankingMetrics(spark.sparkContext.parallelize([(p, l) for p, l in CASES]))
    got = metrics.ranking_metrics(recs, rel, 5, digits=None).first()
    assert got.ndcg_at_k == pytest.approx(rm.ndcgAt(5), abs=1e-12)
    assert got.map_at_k == pytest.approx(rm.meanAveragePrecisionAt(5), abs=1e-12)
    assert got.precision_at_k == pytest.approx(rm.precisionAt(5), abs=1e-12)


def test_popular_list_is_used_whole(spark):
    ranked = spark.createDataFrame([(i, i + 1) for i in range(200)], "item_id long, rank int")
    users = spark.createDataFrame([(1,), (2,), (2,)], "user_id int")
    got = recommend.recommend_popular(users, ranked)
    assert got.count() == 400 and dict(got.dtypes)["item_id"] == "bigint"
    assert recommend.recommend_popular(users, ranked, k=3).count() == 6


def test_excluded_items_leave_full_lists(spark):
    rows = [(u, i, float(1 + (u * i) % 5)) for u in range(12) for i in range(60) if (u + i) % 3]
    train = spark.createDataFrame(rows, "user_id int, item_id int, rating double")
    model = recommend.fit_als(train, rank=3, max_iter=2)
    seen = train.filter("user_id < 8")
    got = {}
    for r in recommend.recommend_als(model, 15, exclude=seen).collect():
        got.setdefault(r.user_id, []).append((r.rank, r.item_id, r.score))
    drop = {(r.user_id, r.item_id) for r in seen.collect()}
    assert set(got) == set(range(12))
    for u, items in got.items():
        items.sort()
        assert [x[0] for x in items] == list(range(1, 16))
        assert not any((u, x[1]) in drop for x in items)
        assert [x[2] for x in items] == sorted((x[2] for x in items), reverse=True)
    few = recommend.recommend_als(model, 50, exclude=seen, users=seen.select("user_id").distinct())
    assert {r["count"] for r in few.groupBy("user_id").count().collect()} == {20}  # all that is left of 60
