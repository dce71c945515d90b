"""MinHash, banding and pair search against golden values and brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from affinity.functions.hashing import PRIME, hash_params
from affinity.operators import minhash as M
from affinity.sources import fixtures
from tables import SF, SF01


def test_hash_params_golden():
    a, b = hash_params()
    assert a[:4] == (774252442, 293375680, 83645521, 707468380)
    assert b[:4] == (360237898, 148090862, 982644643, 858277525)
    assert (a[-1], b[-1]) == (890826373, 731822785)


GOLDEN = [
    ([318], (572512732, 441556451)),
    ([592, 153, 150, 165, 590, 296, 344, 380, 588, 349], (111889932, 34569587)),
    ([1, 648, 17, 32, 780, 736, 141, 25, 62, 95], (75816800, 18780266)),
]


@pytest.mark.parametrize("engine", ["numpy", "sql"])
def test_signature_golden_prefixes(spark, engine):
    rows = [(u, it) for u, (items, _) in enumerate(GOLDEN) for it in items]
    df = spark.createDataFrame(rows, "user_id int, item_id int")
    got = {r.user_id: tuple(r.sig[:2]) for r in M.signatures(df, engine=engine).collect()}
    assert got == {u: pref for u, (_, pref) in enumerate(GOLDEN)}


@pytest.mark.parametrize("engine", ["numpy", "sql"])
def test_signature_empty_and_null_items(spark, engine):
    df = spark.createDataFrame([(1, None), (2, 5), (2, 5), (2, None), (3, -5), (3, 7)], "user_id int, item_id int")
    got = {r.user_id: r for r in M.signatures(df, engine=engine).collect()}
    assert set(got) == {1, 2, 3}
    assert (got[1].n_items, got[1].sig) == (0, [PRIME] * 128)  # the empty set
    assert got[2].n_items == 1
    a, b = hash_params()
    assert got[2].sig == [(a[i] * 5 + b[i]) % PRIME for i in range(128)]
    assert got[3].sig == [min((a[i] * x + b[i]) % PRIME for x in (-5, 7)) for i in range(128)]
    assert [r.user_id for r in M.signatures(df, engine=engine, min_items=2).collect()] == [3]


def test_too_large_item_numbers_are_an_error(spark):
    df = spark.createDataFrame([(1, 2**62)], "user_id int, item_id long")
    for engine in ("numpy", "sql"):
        with pytest.raises(Exception, match="item numbers|overflow"):
            M.signatures(df, engine=engine).collect()


def test_numpy_engine_equals_sql(spark):
    df = fixtures.doc_words(spark, SF)
    both = [{r.doc_id: (r.n_items, r.sig) for r in M.signatures(df, "doc_id", engine=e, number=fixtures.WORD_NUMBER).collect()}
            for e in ("numpy", "sql")]
    assert both[0] == both[1] and len(both[0]) > 0


def test_signature_counts(spark):
    df = spark.createDataFrame([(u, i) for u in (1, 2, 3) for i in (1, 2, 3)] + [(4, 1), (5, 1), (6, 9), (7, None)], "user_id int, item_id int")
    assert tuple(M.signature_counts(df).first()) == (7, 4, 3, 1)


def brute_pairs(sigs, n_bands=32, rows=4):
    """All user pairs sharing a band, counted, from the driver (tiny inputs)."""
    s = {r[0]: r.sig for r in sigs.collect()}
    users = sorted(s)
    out = {}
    for i, u in enumerate(users):
        for v in users[i + 1:]:
            c = sum(s[u][j * rows:(j + 1) * rows] == s[v][j * rows:(j + 1) * rows]
                    for j in range(n_bands))
            if c:
                out[(u, v)] = c
    return out


def ordered_top(pairs, k):
    return sorted(pairs.items(), key=lambda kv: (-kv[1], kv[0][0], kv[0][1]))[:k]


@pytest.mark.parametrize("src", ["events", "docs"])
def test_pairs_match_brute_force(spark, src):
    build, user = {"events": (fixtures.event_items, "user_id"),
                   "docs": (fixtures.doc_words, "doc_id")}[src]
    sigs = M.signatures(build(spark, SF01 if src == "events" else SF), user, min_items=3,
                        number=fixtures.WORD_NUMBER if src == "docs" else None).persist()
    brute = brute_pairs(sigs)
    cand = {(r.user1, r.user2): r["count"] for r in M.candidate_pairs(sigs, 1, user=user).collect()}
    assert cand == brute
    for k in (1, 7, 100):
        top = [((r.user1, r.user2), r["count"]) for r in M.top_pairs(sigs, k, user=user).collect()]
        assert top == ordered_top(brute, k)
    groups = M.candidate_groups(sigs, 1, user=user).collect()
    assert sum(r.n1 * r.n2 if r.rep1 != r.rep2 else r.n1 * (r.n1 - 1) // 2 for r in groups) == len(brute)
    for t in (2, 5, 16):
        got = {(r.user1, r.user2): r["count"]
               for r in M.candidate_pairs(sigs, t, user=user).collect()}
        assert got == {p: c for p, c in brute.items() if c >= t}


def test_top_pairs_with_large_clusters(spark):
    """Many identical sets (a copy cluster): the within-cluster path must give
    the lexicographically smallest pairs without listing the cluster."""
    rng = np.random.default_rng(3)
    rows = []
    for u in range(60):                      # cluster A: users 0..59 share a set
        rows += [(u, it) for it in (1, 2, 3, 4, 5)]
    for u in range(100, 140):                # cluster B, interleaved ids
        rows += [(u, it) for it in (7, 8, 9)]
    for u in range(200, 260):                # distinct random sets
        rows += [(u, int(it)) for it in rng.choice(50, 6, replace=False)]
    df = spark.createDataFrame(rows, "user_id int, item_id int")
    sigs = M.signatures(df, min_items=3).persist()
    brute = brute_pairs(sigs)
    for k in (5, 100, 1770, 2600, 5000):
        top = [((r.user1, r.user2), r["count"]) for r in M.top_pairs(sigs, k).collect()]
        assert top == ordered_top(brute, k), k


@pytest.mark.parametrize("t", [17, 20, 24, 28, 31])
def test_every_pigeonhole_level(spark, t):
    """Near copies of a few sets: each level gives exactly the pairs with that many bands."""
    rng = np.random.default_rng(t)
    rows = []
    for u in range(80):
        base = set(range(1000 * (u % 8), 1000 * (u % 8) + 120))
        drop = rng.choice(sorted(base), int(rng.integers(0, 4)), replace=False)
        rows += [(u, int(i)) for i in base - set(drop.tolist())]
    sigs = M.signatures(spark.createDataFrame(rows, "user_id int, item_id int"), min_items=3).persist()
    cl = M.clusters(sigs).persist()
    got = {(min(r.rep1, r.rep2), max(r.rep1, r.rep2)): r["count"] for r in M._rep_pairs_grouped(cl, t, 32, 4).collect()}
    reps = {r.rep for r in cl.collect()}
    assert got == {p: c for p, c in brute_pairs(sigs).items() if t <= c < 32 and set(p) <= reps} and got


def test_levels_out_of_reach_are_not_joined(spark, monkeypatch):
    calls = {"grouped": [], "counted": 0}
    grouped, counted = M._rep_pairs_grouped, M._rep_pairs_counted
    monkeypatch.setattr(M, "_rep_pairs_grouped", lambda cl, t, *a: calls["grouped"].append(t) or grouped(cl, t, *a))
    monkeypatch.setattr(M, "_rep_pairs_counted", lambda *a: calls.__setitem__("counted", calls["counted"] + 1) or counted(*a))
    sigs = M.signatures(fixtures.event_items(spark, SF01), min_items=3).persist()
    brute = brute_pairs(sigs)
    for k, levels, bands in ((100, [], 1), (1, None, None)):
        calls.update(grouped=[], counted=0)
        top = [((r.user1, r.user2), r["count"]) for r in M.top_pairs(sigs, k).collect()]
        assert top == ordered_top(brute, k)
        bounds = M.level_bounds(M.clusters(sigs), [31, 28, 24, 20, 17], 32, 4)
        assert all(t in calls["grouped"] or bounds[t] < k or min(calls["grouped"], default=0) > t for t in bounds)
        assert levels is None or (calls["grouped"], calls["counted"]) == (levels, bands)


@pytest.mark.parametrize("seed", [1, 2])
def test_level_bounds_are_not_below_the_pairs(spark, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for u in range(120):
        base = set(range(1000 * (u % 5), 1000 * (u % 5) + 60))
        drop = rng.choice(sorted(base), int(rng.integers(0, 3)), replace=False)
        rows += [(u, int(i)) for i in base - set(drop.tolist())]
    sigs = M.signatures(spark.createDataFrame(rows, "user_id int, item_id int"), min_items=3).persist()
    cl = M.clusters(sigs).persist()
    cluster_of = {r.user_id: r.rep for r in M.members(sigs, cl).collect()}
    between = [c for (u, v), c in brute_pairs(sigs).items() if cluster_of[u] != cluster_of[v]]
    levels = [31, 28, 24, 20, 17]
    bounds = M.level_bounds(cl, levels, 32, 4)
    assert all(bounds[t] >= sum(c >= t for c in between) for t in levels) and bounds[17] > 0
    assert M.level_bounds(cl.limit(0), levels, 32, 4) == dict.fromkeys(levels, 0)


def _one_bucket(spark, m, other=300):
    """``m`` signatures in one bucket, and some in buckets of their own."""
    return spark.range(m + other).selectExpr("id AS rep", "id % 3 + 1 AS n_users", "0 AS g", "array(IF(id < {0}, 1L, id)) AS key".format(m)).withColumn(
        "gk", F.xxhash64("g", "key"))


def test_hot_bucket_is_spread_over_pairs_of_blocks(spark):
    m, block = 50_000, 2000
    low, high = M._deal(_one_bucket(spark, m), block)
    for side in (low, high):
        sizes = [r["count"] for r in side.filter("key[0] = 1").groupBy("lo", "hi").count().collect()]
        assert len(sizes) == 25 * 26 // 2 and max(sizes) < 1.2 * block
    assert low.filter("key[0] <> 1").count() == 300


def test_triangular_join_gives_each_pair_once(spark):
    got = [tuple(r) for r in M._bucket_pairs(_one_bucket(spark, 250), 30).collect()]
    assert sorted(got) == [(i, j, i % 3 + 1, j % 3 + 1) for i in range(250) for j in range(i + 1, 250)]


def test_bands_and_buckets(spark):
    df = fixtures.event_items(spark, SF)
    sigs = M.signatures(df, min_items=3)
    b = M.bands(sigs)
    assert b.groupBy("user_id").count().agg(F.min("count"), F.max("count")).first() == (32, 32)
    assert b.agg(F.min(F.size("band")), F.max(F.size("band"))).first() == (4, 4)
    st = M.bucket_stats(b).first()
    bk = M.buckets(b).collect()
    assert st.n_buckets == len(bk)
    assert st.max_size == max(r.n_users for r in bk)


def test_jaccard_exact(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (2, 4), (3, 9)],
                               "user_id int, item_id int")
    pairs = spark.createDataFrame([(1, 2, 5), (1, 3, 1)], "user1 int, user2 int, count long")
    got = {(r.user1, r.user2): (r.n_shared, r.jaccard) for r in M.jaccard(pairs, df).collect()}
    assert got == {(1, 2): (2, 0.5), (1, 3): (0, 0.0)}
    got = {(r.user2, r.item_id): (r.in1, r.in2) for r in M.with_sets(pairs, df).collect()}
    both, one, two = (True, True), (True, False), (False, True)
    assert got == {(2, 1): one, (2, 2): both, (2, 3): both, (2, 4): two, (3, 1): one, (3, 2): one, (3, 3): one, (3, 9): two}


def test_signature_clusters_and_members(spark):
    df = spark.createDataFrame([(u, it) for u in (5, 6, 7) for it in (1, 2, 3)]
                               + [(9, 4), (9, 5), (9, 6)], "user_id int, item_id int")
    sigs = M.signatures(df)
    top = M.signature_clusters(sigs, 2).collect()
    assert [(r.rep, r.n_users) for r in top] == [(5, 3), (9, 1)]
    mem = M.cluster_members(sigs, df, 1).collect()
    assert sorted((r.user_id, r.item_id) for r in mem) == [(u, it) for u in (5, 6, 7) for it in (1, 2, 3)]


def test_hot_user_signature_spread(spark):
    """One user holds about a third of all rows: both engines agree, and the
    numpy fold leaves partial rows from many tasks for that user (no single
    task sees the whole set)."""
    rows = [(0, i) for i in range(30000)] + [(u, (u * 7 + j) % 5000) for u in range(1, 2000)
                                             for j in range(30)]
    df = spark.createDataFrame(rows, "user_id int, item_id int").repartition(8)
    a = {r.user_id: (r.n_items, r.sig) for r in M.signatures(df, engine="numpy").collect()}
    b = {r.user_id: (r.n_items, r.sig) for r in M.signatures(df, engine="sql").collect()}
    assert a == b and a[0][0] == 30000
    # AQE would coalesce this tiny shuffle into one task; keep the partitions.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        partial = M._numpy_partials(df.distinct(), "user_id", "item_id", 128)
        assert partial.filter("user_id = 0").count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_fold_hands_on_a_row_per_run_and_keeps_a_batch(spark, monkeypatch):
    """Rows that come user by user give one partial row per user and task, and a
    user in the middle of a task is handed on at once."""
    rows = [(u, u * 31 + j) for u in range(3000) for j in range(9)] + [(None, 7), (None, 8)]
    df = spark.createDataFrame(rows, "user_id long, item_id long").coalesce(1)
    got = M._numpy_partials(df, "user_id", "item_id", 4).collect()
    a, b = hash_params(4)
    assert {r.user_id: (r._n, r._s) for r in got} == {
        u: (len(x), [min((a[i] * v + b[i]) % PRIME for v in x) for i in range(4)])
        for u, x in [(u, range(u * 31, u * 31 + 9)) for u in range(3000)] + [(None, (7, 8))]} and len(got) == 3001
    spread = spark.createDataFrame([(i % 3000, i) for i in range(27000)], "user_id long, item_id long").repartition(6, "item_id")
    plan = M.signatures(spread, distinct_input=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan


def _documents(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_words_of_documents_need_no_shuffle(spark, tmp_path):
    sf = _documents(spark, tmp_path, [(1, "A b a"), (2, None), (3, ""), (4, "c c")])
    words = fixtures.doc_words(spark, sf)
    assert sorted(map(tuple, words.collect())) == [(1, "a"), (1, "b"), (3, ""), (4, "c")]
    assert "Exchange" not in words._jdf.queryExecution().executedPlan().toString()


def test_words_of_repeated_and_missing_ids_are_distinct(spark, tmp_path):
    sf = _documents(spark, tmp_path, [(1, "a b"), (1, "b c"), (2, "a a"), (None, "x"), (None, "x y"), (3, None), (3, "z")])
    got = sorted(map(tuple, fixtures.doc_words(spark, sf).collect()), key=str)
    assert got == sorted([(1, "a"), (1, "b"), (1, "c"), (2, "a"), (None, "x"), (None, "y"), (3, "z")], key=str)


def test_similar_documents_are_not_kept_in_memory(spark, tmp_path, monkeypatch):
    from affinity.plans import twins
    sf = _documents(spark, tmp_path, [(i, f"a b c d {i % 3}") for i in range(12)])
    kept = []
    monkeypatch.setattr(type(spark.range(1)), "persist", lambda df, *level, f=type(spark.range(1)).persist: kept.append(df.columns) or f(df, *level))
    rows = twins.similar_pairs(spark, sf, "docs").collect()
    assert len(rows) == 66 and ["doc_id", "item_id"] not in kept


@pytest.mark.parametrize("t", [1, 2, 3, 5, 8, 10, 16])
def test_subsets_of_bands_meet_every_pair(t):
    rng = np.random.default_rng(t)
    for c in range(1, min(t, 4) + 1):
        subsets = [set(s) for s in M._subsets(32, t, c)]
        for _ in range(200):
            shared = set(rng.choice(32, t, replace=False).tolist())
            assert any(s <= shared for s in subsets), (t, c)


def test_top_pairs_of_sets_that_share_few_bands(spark, monkeypatch):
    """Independent sets of few items: no level is reached, single bands meet too often to be counted."""
    rng = np.random.default_rng(5)
    rows = [(u, int(i)) for u in range(220) for i in rng.choice(40, 18, replace=False)]
    sigs = M.signatures(spark.createDataFrame(rows, "user_id int, item_id int"), min_items=3).persist()
    brute = brute_pairs(sigs)
    monkeypatch.setattr(M, "COUNTED", 100)
    monkeypatch.setattr(M, "_rep_pairs_counted", lambda *a: pytest.fail("single bands were joined"))
    top = [((r.user1, r.user2), r["count"]) for r in M.top_pairs(sigs, 25).collect()]
    assert top == ordered_top(brute, 25) and 2 <= top[-1][1] <= 16


def test_levels_whose_buckets_are_too_full_are_not_joined(spark, monkeypatch):
    """A bound lets level 17 reach k, but its groups meet in more pairs than wanted."""
    rng = np.random.default_rng(6)
    rows = [(u, int(i)) for u in range(300) for i in rng.choice(40, 18, replace=False)]
    sigs = M.signatures(spark.createDataFrame(rows, "user_id int, item_id int"), min_items=3).persist()
    brute = brute_pairs(sigs)
    assert M.level_bounds(M.clusters(sigs), [17], 32, 4)[17] >= 10
    monkeypatch.setattr(M, "COUNTED", 5)
    monkeypatch.setattr(M, "LEVEL_ROWS", 0, raising=False)
    joined, grouped = [], M._rep_pairs_grouped
    monkeypatch.setattr(M, "_rep_pairs_grouped", lambda cl, t, *a: joined.append(t) or grouped(cl, t, *a))
    top = [((r.user1, r.user2), r["count"]) for r in M.top_pairs(sigs, 10).collect()]
    assert top == ordered_top(brute, 10) and 17 not in joined


def test_sketches_are_carried_as_plain_columns(spark):
    """Arrays read in the join's condition made every pair some 30 times as dear."""
    rows = [(u, (u * 7 + j * (1 + u % 3)) % 60) for u in range(40) for j in range(20)]
    cl = M.clusters(M.signatures(spark.createDataFrame(rows, "user_id int, item_id int")))
    sketched = M._sketched(cl, 32, 4)
    assert [t for c, t in sketched.dtypes if c not in ("rep", "n_users", "_h")] == ["bigint"] * 4
    most = {(r.rep1, r.rep2): r.most for r in M._subset_pairs(sketched, [(j,) for j in range(32)], 32).collect()}
    exact = {(r.rep1, r.rep2): r["count"] for r in M._rep_pairs_counted(cl, 32, 4).collect()}
    assert exact and exact.keys() == most.keys() and all(most[p] >= n for p, n in exact.items())


def _dense(spark, users=240, items=30, size=16, seed=8):
    rng = np.random.default_rng(seed)
    rows = [(u, int(i)) for u in range(users) for i in rng.choice(items, size, replace=False)]
    return M.signatures(spark.createDataFrame(rows, "user_id int, item_id int"), min_items=3).persist()


@pytest.mark.parametrize("block, tile, tiled_from", [(None, 1 << 18, 32), (20, 64, 4), (7, 1 << 18, 1000), (None, 100, 2)])
def test_counted_pairs_match_brute_force_by_any_tiles(spark, monkeypatch, block, tile, tiled_from):
    monkeypatch.setattr(M, "TILE", tile)
    monkeypatch.setattr(M, "TILED_FROM", tiled_from)
    sigs = _dense(spark)
    cl = M.clusters(sigs).persist()
    reps = {r.rep for r in cl.collect()}
    got = [((r.rep1, r.rep2), r["count"]) for r in M._rep_pairs_counted(cl, 32, 4, block).collect()]
    assert len(got) == len(dict(got)) > 1000
    assert dict(got) == {p: c for p, c in brute_pairs(sigs).items() if set(p) <= reps}


def test_pairs_are_counted_where_they_meet_and_not_shuffled(spark):
    """The last exchange moves signatures with their bands; no aggregate follows that would shuffle pairs."""
    plan = M._rep_pairs_counted(M.clusters(_dense(spark)), 32, 4)._jdf.queryExecution().optimizedPlan().toString()
    above = plan[:plan.index("MapInArrow")]
    assert "Aggregate" not in above and "Join" not in above


def test_bands_that_share_a_hash_are_hashed_anew(spark, monkeypatch):
    real, salts = M._band_hash, []

    def poor(sig, j, rows, salt):
        salts.append(salt)
        return F.pmod(real(sig, j, rows, salt), F.lit(5)) if salt == 0 else real(sig, j, rows, salt)

    sigs = _dense(spark, 60)
    monkeypatch.setattr(M, "_band_hash", poor)
    cl = M.clusters(sigs).persist()
    reps = {r.rep for r in cl.collect()}
    got = {(r.rep1, r.rep2): r["count"] for r in M._rep_pairs_counted(cl, 32, 4).collect()}
    assert set(salts) == {0, 1} and got == {p: c for p, c in brute_pairs(sigs).items() if set(p) <= reps}


def test_counted_pairs_of_text_ids_and_none(spark):
    assert M._rep_pairs_counted(M.clusters(_dense(spark, 5)).limit(0), 32, 4).count() == 0
    cl = M.clusters(_dense(spark, 50))
    ids = cl.withColumn("rep", F.concat(F.lit("u"), F.col("rep").cast("string")))
    got = M._rep_pairs_counted(ids, 32, 4).collect()
    assert got and all(r.rep1 < r.rep2 for r in got) and len(got) == M._rep_pairs_counted(cl, 32, 4).count()
