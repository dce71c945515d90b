"""Pair validation, profiling and I/O."""

import pytest
from pyspark.sql import functions as F

from affinity.operators import pairs, profile
from affinity.sources import io, fixtures
from tables import SF, SF01


def test_correlation_guard(spark):
    shared = spark.createDataFrame(
        [(1, 2, 1, 3.0, 1.0), (1, 2, 2, 3.0, 2.0),      # constant side, 2 rows
         (3, 4, 1, 1.0, 2.0),                           # one shared item
         (5, 6, 1, 1.0, 2.0), (5, 6, 2, 2.0, 4.0)],     # perfect correlation
        "user1 int, user2 int, item_id int, rating1 double, rating2 double")
    got = {(r.user1, r.user2): (r.rating_correlation, r.overlap_count)
           for r in pairs.pair_correlation(shared).collect()}
    assert got[(1, 2)] == (None, 2)
    assert got[(3, 4)] == (None, 1)
    assert got[(5, 6)][0] == pytest.approx(1.0)
    z = {(r.user1, r.user2): (r.n_shared, r.constant1, r.constant2) for r in pairs.constant_sides(shared).collect()}
    assert z == {(1, 2): (2, True, False), (3, 4): (1, True, True)}


@pytest.mark.parametrize("users,n,want", [(40, 150, 150), (40, 500, 500), (40, 5000, 780), (2, 10, 1), (1, 10, 0), (0, 10, 0), (3000, 100, 100)])
def test_random_pairs_are_complete(spark, users, n, want):
    r = spark.range(users).select(F.col("id").alias("user_id"), F.lit(1).alias("item_id"))
    rows = [tuple(x) for x in pairs.random_pairs(r, n).collect()]
    assert len(rows) == len(set(rows)) == want and all(a < b for a, b in rows)
    assert sorted(map(tuple, pairs.random_pairs(r, n).collect())) == sorted(rows)  # reproducible


def test_random_pairs_are_no_lattice(spark):
    r = spark.range(2000).select(F.col("id").alias("user_id"))
    gaps = {b - a for a, b in pairs.random_pairs(r, 400).collect()}
    assert len(gaps) > 300


def test_pair_status(spark):
    allp = spark.createDataFrame([(1, 2), (3, 4), (5, 6)], "user1 int, user2 int")
    shared = spark.createDataFrame([(1, 2, 1, 1.0, 2.0), (1, 2, 2, 2.0, 4.0), (3, 4, 1, 1.0, 1.0)],
                                   "user1 int, user2 int, item_id int, rating1 double, rating2 double")
    status = pairs.pair_status(allp, shared)
    assert {(r.user1, r.user2): r.status for r in status.collect()} == {(1, 2): "defined", (3, 4): "undefined", (5, 6): "disjoint"}
    assert {(r.user1, r.user2): r.overlap_count for r in pairs.dropped_pairs(status).collect()} == {(3, 4): 1, (5, 6): None}
    assert [(r.user1, r.user2, r.overlap_count) for r in pairs.defined_pairs(status).collect()] == [(1, 2, 2)]


def test_shared_ratings_drop_other_users_before_any_shuffle(spark):
    r = spark.range(50_000).select(
        (F.col("id") % 5000).cast("int").alias("user_id"), (F.col("id") % 97).cast("int").alias("item_id"), F.lit(1.0).alias("rating"))
    two = spark.createDataFrame([(1, 2), (3, 5000)], "user1 int, user2 int")
    plan = pairs.shared_ratings(two, r)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan
    got = pairs.shared_ratings(two, r).groupBy("user1", "user2").count().collect()
    items = lambda u: {i % 97 for i in range(u, 50_000, 5000)}
    want = {(1, 2): len(items(1) & items(2))}
    assert {(x.user1, x.user2): x["count"] for x in got} == {k: v for k, v in want.items() if v}


def test_profile_ops(spark):
    df = spark.createDataFrame([(1, "a|b", None), (2, "b", 2.0), (3, None, 4.0)],
                               "id int, g string, x double")
    assert profile.null_counts(df).first().asDict() == {"id": 0, "g": 1, "x": 1}
    assert [tuple(r) for r in profile.exploded_counts(df, "g", "\\|").collect()] == [("b", 2), ("a", 1)]
    d = profile.describe(df, ["x"], exact=True).first()
    assert (d["count"], d["mean"], d["min"], d["p50"], d["max"]) == (2, 3.0, 2.0, 3.0, 4.0)
    assert [tuple(r) for r in profile.value_counts(df, "id").collect()] == [(1, 1), (2, 1), (3, 1)]
    assert [tuple(r) for r in profile.column_types(df).collect()] == [
        (0, "id", "int", True, 3), (1, "g", "string", True, 2), (2, "x", "double", True, 2)]
    assert profile.null_counts(df.limit(0)).first().asDict() == {"id": 0, "g": 0, "x": 0}
    both = profile.describe(df, ["x", "id"]).collect()
    assert [(r.column, r["count"], r.p50) for r in both] == [("x", 2, 2.0), ("id", 3, 2.0)]
    assert profile.table_profile(df, ["id"], approx=True).first().n_id == 3


def test_describe_is_one_pass(spark):
    df = spark.read.parquet(f"{SF}/part.parquet")
    plan = profile.describe(df, ["p_partkey", "p_size"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1


def test_csv_parquet_roundtrip(spark, tmp_path):
    csv = tmp_path / "ratings.csv"
    csv.write_text("userId,movieId,rating,timestamp\n1,10,4.0,100\n2,,3.5,200\n3,30,5.0,300\n")
    pq = str(tmp_path / "ratings.parquet")
    df = io.load_or_convert(spark, pq, str(csv), io.RATINGS_SCHEMA)
    assert sorted(tuple(r) for r in df.collect()) == [(1, 10), (3, 30)]
    again = io.load_or_convert(spark, pq, "/nonexistent.csv", io.RATINGS_SCHEMA)
    assert again.count() == 2
    io.write_csv(df, str(tmp_path / "out_csv"))
    assert spark.read.csv(str(tmp_path / "out_csv"), header=True).count() == 2


TEXTS = [(1, 'say "hi", ok', 1.5), (2, "two\nlines", None), (3, "", 2.0), (4, None, 3.0), (5, "a\\b,c", 1.0), (6, '"', 0.5), (7, " pad ", 2.5)]


def test_csv_text_round_trip(spark, tmp_path):
    df = spark.createDataFrame(TEXTS, "id int, t string, x double")
    io.write_csv(df, str(tmp_path / "t"))
    assert sorted(map(tuple, io.read_csv(spark, str(tmp_path / "t"), df.schema).collect())) == TEXTS


def test_broken_rows_are_reported_and_left_out(spark, tmp_path):
    csv = tmp_path / "r.csv"
    csv.write_text("userId,movieId,rating,timestamp\n1,10,4.0,100\nx,20,3.5,200\n3,30,5.0,300\n")
    with pytest.warns(UserWarning, match="1 rows"):
        df = io.load_or_convert(spark, str(tmp_path / "p"), str(csv), io.RATINGS_SCHEMA, columns=("userId", "rating"))
    assert sorted(map(tuple, df.collect())) == [(1, 4.0), (3, 5.0)]
    assert io.load_or_convert(spark, str(tmp_path / "p"), "none", io.RATINGS_SCHEMA, columns=("rating",)).columns == ["rating"]


def test_words_are_not_merged(spark):
    """Sets are sets of words: as many items as distinct words, at sf0.1."""
    sf = "/root/testdata/sf0.1"
    words = fixtures.doc_words(spark, sf)
    n = spark.read.parquet(f"{sf}/documents.parquet").select(F.explode(F.split(F.lower("text"), " ")).alias("w"))
    assert words.select("item_id").distinct().count() == n.distinct().count()


def test_entry_and_registry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
