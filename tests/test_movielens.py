"""The MovieLens-format studies on a directory written from the test tables."""

import pytest
from pyspark.sql import functions as F

from affinity.plans import movielens as ML
from affinity.sources import fixtures
from tables import SF


@pytest.fixture(scope="module")
def ml_dir(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("ml")
    r = fixtures.ratings(spark, SF).select(
        F.col("user_id").alias("userId"), F.col("item_id").alias("movieId"), "rating",
        F.unix_timestamp(F.col("ts").cast("timestamp")).alias("timestamp"))
    part = fixtures.table(spark, SF, "part")
    movies = part.select(F.col("p_partkey").cast("int").alias("movieId"),
                         F.col("p_name").alias("title"),
                         F.concat_ws("|", F.col("p_brand"), F.col("p_type")).alias("genres"))
    tags = r.limit(50).select("userId", "movieId", F.lit("nice, \"quoted\"").alias("tag"),
                              "timestamp")
    links = part.select(F.col("p_partkey").cast("int").alias("movieId"),
                        F.col("p_size").alias("imdbId"),
                        F.when(F.col("p_size") > 10, F.col("p_size")).alias("tmdbId"))
    for name, df in {"ratings": r, "movies": movies, "tags": tags, "links": links}.items():
        pdf = df.toPandas()
        pdf.to_csv(root / f"{name}.csv", index=False)
    return str(root)


def test_eda(spark, ml_dir):
    t = ML.load(spark, ml_dir)
    out = ML.eda(t)
    assert out["ratings_count"].first()[0] == fixtures.ratings(spark, SF).count()
    assert out["tags_nulls"].first()["tag"] == 0
    assert out["links_nulls"].first()["tmdbId"] > 0
    assert out["genre_distribution"].count() > 1
    assert out["ratings_schema"].count() == 4 and out["ratings_sample"].count() == 5


def test_twins_split_evaluate_validate(spark, ml_dir, tmp_path):
    ratings = ML.ratings_parquet(spark, ml_dir, str(tmp_path / "ratings.parquet"))
    t = ML.twins(ratings, k=20)
    top = t["top_pairs"].collect()
    assert len(top) == 20 and all(0.0 <= r.jaccard <= 1.0 for r in top)
    assert t["signature_counts"].first().n_signatures > 0
    sizes, before = t["set_size_summary"].first(), t["set_size_summary_before"].first()
    assert before["count"] >= sizes["count"] and before["min"] <= sizes["min"]
    largest = t["signature_clusters"].first()
    assert {r.userId for r in t["largest_cluster_members"].select("userId").distinct().collect()} >= {largest.rep}
    assert t["largest_cluster_members"].select("userId").distinct().count() == largest.n_users
    assert ML.filter_report(ratings).first().rows_dropped >= 0
    s = ML.split(ratings)
    checks = ML.split_checks(s)
    assert checks["order_violations"].count() == 0
    assert checks["overlap"].first().asDict() == {"train_val": 0, "train_test": 0, "val_test": 0}
    b = ML.baseline(s).first()
    assert 0.0 <= b.ndcg_at_k <= 1.0
    lists = ML.list_samples(s, k=10, n=3)
    assert {r.source for r in lists.select("source").distinct().collect()} == {"predicted", "actual"}
    assert lists.select("userId").distinct().count() == 3
    v = ML.validate(t["top_pairs"], ratings, n_random=200)
    assert v["comparison"].count() == 2


def test_cli_eda(spark, ml_dir, capsys):
    ML.main(["eda", "--data", ml_dir, "--show", "3"])
    assert "genre_distribution" in capsys.readouterr().out
