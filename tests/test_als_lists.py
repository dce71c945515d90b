from affinity.plans import recsys


def test_users_without_a_test_row_have_a_list(spark, monkeypatch):
    rows = [(u, i, float(1 + (u + i) % 5), "train") for u in range(6) for i in range(4)] + [(u, 9, 3.0, "test") for u in range(4)]
    s = spark.createDataFrame(rows, "user_id int, item_id int, rating double, split string")
    monkeypatch.setattr(recsys, "fixture_splits", lambda spark, sf_dir: s)
    got = recsys.als_recommendations(spark, "").collect()
    assert sorted(r.user_id for r in got) == list(range(6))
    assert all((r.n_items, r.n_distinct, r.n_from_train, r.ordered) == (4, 4, 4, True) for r in got)
