"""Property tests: exact top-k pairs vs brute force on random data; tuning."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from affinity.operators import minhash as M
from affinity.operators import recommend
from affinity.plans import recsys
from tables import SF
from test_minhash import brute_pairs, ordered_top


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(seed=st.integers(0, 10_000), n_users=st.integers(20, 70), n_items=st.integers(6, 30),
       copies=st.integers(0, 12), k=st.sampled_from([1, 10, 50, 400]))
def test_top_pairs_exact_random(spark, seed, n_users, n_items, copies, k):
    import numpy as np
    rng = np.random.default_rng(seed)
    rows = []
    base = [int(i) for i in rng.choice(n_items, 4, replace=False)]
    for u in range(n_users):
        size = int(rng.integers(3, min(n_items, 9) + 1))
        rows += [(u, int(i)) for i in rng.choice(n_items, size, replace=False)]
    for c in range(copies):                       # a cluster of exact copies
        rows += [(1000 + 3 * c, i) for i in base]
    df = spark.createDataFrame(rows, "user_id int, item_id int")
    sigs = M.signatures(df, min_items=3).persist()
    brute = brute_pairs(sigs)
    got = [((r.user1, r.user2), r["count"]) for r in M.top_pairs(sigs, k).collect()]
    assert got == ordered_top(brute, k)
    sigs.unpersist()


def test_tune_picks_first_best(spark):
    s = recsys.fixture_splits(spark, SF)
    train = s.filter(F.col("split") == "train")
    val = s.filter(F.col("split") == "val")
    best, results, model = recommend.tune(train, val, ranks=[2, 3], regs=[0.1], k=10, max_iter=3)
    rows = results.collect()
    assert len(rows) == 2
    top = max(r.ndcg_at_k for r in rows)
    first = next(r for r in rows if r.ndcg_at_k == top)
    assert (best["rank"], best["ndcg"]) == (first.rank, first.ndcg_at_k)
    recs = recommend.recommend_als(model, 10)
    assert recs.groupBy("user_id").agg(F.max("rank")).agg(F.max("max(rank)")).first()[0] <= 10
