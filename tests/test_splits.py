"""Sparse filter, time split, hot-key numbering and split checks."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from affinity.operators import skew, splits
from affinity.plans import recsys
from affinity.sources import io
from tables import SF01


def ts(i):
    return dt.datetime(2020, 1, 1) + dt.timedelta(days=i)


def test_five_ratings_split_4_1_0(spark):
    df = spark.createDataFrame([(1, i, 3.0, ts(i)) for i in range(5)],
                               "user_id int, item_id int, rating double, ts timestamp")
    got = {r.split: r.n_rows for r in splits.split_sizes(splits.time_split(df)).collect()}
    assert got == {"train": 4, "val": 1}


def test_equal_times_ordered_by_item(spark):
    df = spark.createDataFrame([(1, i, 3.0, ts(0)) for i in (9, 3, 7, 1, 5, 2, 8, 4, 6, 0)],
                               "user_id int, item_id int, rating double, ts timestamp")
    s = {r.item_id: r.split for r in splits.time_split(df).collect()}
    assert [s[i] for i in range(10)] == ["train"] * 7 + ["val"] * 2 + ["test"]


def test_filter_sparse_one_pass(spark):
    # item 9 has 1 rating -> dropped; user 2 then has 4 < 5 ratings -> dropped
    rows = [(u, i) for u in (1, 3, 4, 5, 6) for i in range(5)] + [(2, i) for i in (0, 1, 2, 3, 9)]
    df = spark.createDataFrame(rows, "user_id int, item_id int")
    out = splits.filter_sparse(df)
    assert sorted(r.user_id for r in out.select("user_id").distinct().collect()) == [1, 3, 4, 5, 6]
    assert out.filter("item_id = 9").count() == 0


def test_hot_key_numbering_equals_window(spark):
    rows = [(1, i, ts(i % 17)) for i in range(3000)] + [(u, i, ts(i)) for u in range(2, 40)
                                                         for i in range(u)]
    df = spark.createDataFrame(rows, "user_id int, item_id int, ts timestamp")
    df = df.union(spark.createDataFrame([(None, 1, ts(0)), (None, 2, ts(0))], df.schema))
    w = Window.partitionBy("user_id")
    a = df.withColumn("row_num", F.row_number().over(w.orderBy("ts", "item_id"))).withColumn("group_size", F.count("*").over(w))
    key = ["user_id", "item_id", "row_num", "group_size"]
    want = sorted(map(tuple, a.select(key).collect()), key=repr)
    for partitions in (1, 7, None):
        b = skew.number_within(df, "user_id", ["ts", "item_id"], partitions=partitions)
        assert dict(b.dtypes)["row_num"] == dict(b.dtypes)["group_size"] == "bigint"
        assert sorted(map(tuple, b.select(key).collect()), key=repr) == want


def test_checks_see_a_leak_and_a_broken_order(spark):
    s = spark.createDataFrame([(1, 1, ts(0), "train"), (1, 2, ts(5), "train"), (1, 3, ts(3), "val"), (1, 1, ts(9), "test"),
                               (2, 1, ts(0), "train"), (2, 2, ts(1), "val"), (2, 2, ts(1), "test"), (3, 1, ts(4), "train"), (3, 2, ts(2), "test")],
                              "user_id int, item_id int, ts timestamp, split string")
    assert splits.split_overlap(s).first().asDict() == {"train_val": 0, "train_test": 1, "val_test": 1}
    assert sorted(r.user_id for r in splits.split_order_violations(s).collect()) == [1, 3]


def test_filter_report(spark):
    before = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (None, 3)], "user_id int, item_id int")
    got = splits.filter_report(before, before.filter("user_id = 1")).first().asDict()
    assert got == {"rows_before": 4, "users_before": 2, "items_before": 3, "rows_after": 2, "users_after": 1, "items_after": 2,
                   "rows_dropped": 2, "users_dropped": 1, "items_dropped": 1}
    assert splits.filter_report(before, before.limit(0)).first()["rows_after"] == 0
    assert "Expand" not in splits.filter_report(before, before)._jdf.queryExecution().optimizedPlan().toString()


def test_split_checks_on_fixture(spark):
    s = recsys.fixture_splits(spark, SF01)
    sizes = {r.split: r.n_rows for r in splits.split_sizes(s).collect()}
    assert sizes == {"train": 36518, "val": 11894, "test": 10973}
    assert splits.split_overlap(s).first().asDict() == {"train_val": 0, "train_test": 0,
                                                        "val_test": 0}
    assert splits.split_order_violations(s).count() == 0
    assert splits.split_ranges(s).count() == 3


def test_write_splits_one_pass(spark, tmp_path):
    df = spark.createDataFrame([(u, i, 3.0, ts(i)) for u in (1, 2) for i in range(10)],
                               "user_id int, item_id int, rating double, ts timestamp")
    s = splits.time_split(df)
    out = str(tmp_path / "splits")
    splits.write_splits(s, out)
    back = {sp: io.read_parquet(spark, out).filter(f"split = '{sp}'").count() for sp in splits.SPLITS}
    assert back == {"train": 14, "val": 4, "test": 2}
    frames = splits.split_frames(s)
    assert {k: v.count() for k, v in frames.items()} == back
