import random

import pytest

from affinity.operators import bounds, minhash, overlaps


def build(spark, seed, sizes, items, text=False):
    rnd = random.Random(seed)
    sets = {u: set(rnd.sample(range(items), n)) for u, n in enumerate(sizes)}
    rows = [(u, f"w{i}" if text else i) for u, s in sets.items() for i in s]
    return sets, spark.createDataFrame(rows, "user_id int, item_id string" if text else "user_id int, item_id int").repartition(4)


@pytest.mark.parametrize("few,chunk", [(512, 32768), (5, 32768), (0, 128), (20, 128)])
def test_overlaps_of_sparse_and_dense_sets(spark, monkeypatch, few, chunk):
    monkeypatch.setattr(overlaps, "FEW", few)
    monkeypatch.setattr(overlaps, "CHUNK", chunk)
    monkeypatch.setattr(overlaps, "WORDS", chunk // 64)
    sets, df = build(spark, few, [0, 1, 3, 20, 64, 200, 400, 700, 900, 900], 1000, text=chunk == 128)
    want = {(a, b): len(sets[a] & sets[b]) for a in sets for b in sets if a < b and sets[a] & sets[b]}
    pairs = spark.createDataFrame([(a, b) for a in sets for b in sets if a < b], "user1 int, user2 int")
    got = {(r.user1, r.user2): r.n_shared for r in overlaps.chunked_overlaps(pairs, df, "user_id", "item_id").collect()}
    assert got == want


def test_jaccard_is_the_same_beyond_the_broadcast_bound(spark, monkeypatch):
    sets, df = build(spark, 9, [5, 30, 80, 300, 1000, 1000], 1500)
    df = df.union(spark.createDataFrame([(1, None), (3, None)], df.schema)).union(df.limit(20))
    pairs = spark.createDataFrame([(a, b, 1) for a in range(6) for b in range(a + 1, 8)], "user1 int, user2 int, count long")
    near = sorted(map(tuple, minhash.jaccard(pairs, df).collect()))
    calls = []
    real = minhash.chunked_overlaps
    monkeypatch.setattr(bounds, "BROADCAST_ROWS", 3)
    monkeypatch.setattr(minhash, "chunked_overlaps", lambda *a: calls.append(1) or real(*a))
    far = sorted(map(tuple, minhash.jaccard(pairs, df).collect()))
    assert calls and near == far and {(r[0], r[1]): r[5] for r in far if r[1] < 6} == {
        (a, b): len(sets[a] & sets[b]) for a in range(6) for b in range(a + 1, 6)}


def test_many_pairs_carry_chunks_and_not_items(spark):
    """A quarter of a million pairs of sets of 200 items: rows per pair and chunk, not per item."""
    sets, df = build(spark, 3, [200] * 710, 3000)
    pairs = spark.createDataFrame([(a, b) for a in range(710) for b in range(a + 1, 710)], "user1 int, user2 int")
    packed = overlaps.packed_sets(df, "user_id", "item_id")
    assert packed.count() == 710
    out = overlaps.chunked_overlaps(pairs, df, "user_id", "item_id")
    assert out.agg({"n_shared": "sum"}).first()[0] == sum(
        n * (n - 1) // 2 for n in [sum(i in s for s in sets.values()) for i in range(3000)])
