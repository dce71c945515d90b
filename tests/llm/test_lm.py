import binascii
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from affinity.llm import lm
from affinity.llm.elias_fano import STEP, BigramTrie, EliasFano
from affinity.llm.queries import op6_lm_scoring

END = object()


def tokens(text):
    return [*(text or "").encode().lower().split(), END]


def brute(rows, trained, backoff):
    """Base score and quantised model score of each row by plain counting."""
    uni, pairs, ctx = Counter(), Counter(), Counter()
    for (_, t), used in zip(rows, trained):
        if used:
            seq = tokens(t)
            uni.update(seq)
            for a, b in zip([None, *seq], seq):
                pairs[a, b] += 1
                ctx[a] += 1
    n, v = sum(uni.values()), len(uni)
    base = lambda w: math.log10((uni[w] + 1) / (n + v + 1))
    out = []
    for d, t in rows:
        seq, score = tokens(t), 0.0
        for a, b in zip([None, *seq], seq):
            if pairs[a, b]:
                score -= round(-math.log10((1 - backoff) * pairs[a, b] / ctx[a]) * STEP) / STEP
            else:
                score += base(b) + (math.log10(backoff) if ctx[a] else 0)
        out.append((d, len(seq), sum(uni[w] > 0 for w in seq), n, sum(map(base, seq)), score))
    return out


def same(got, want):
    got, want = sorted(got, key=repr), sorted(want, key=repr)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    for g, w in zip(got, want):
        assert g[4:] == pytest.approx(w[4:], abs=1e-6 * max(1, w[1]))


ROWS = [(i, " ".join(np.random.default_rng(i).choice(["the", "The", "cat", "sat", "Straße", "on", "É", "mat" + str(i % 7)], 5 + i))) for i in range(60)] + [
    (100, None), (101, ""), (102, " \t\x0b"), (3, "the cat"), (3, "the cat"), (104, "the " * 5000), (105, "unknown words only"), (None, "the cat sat")]


@pytest.mark.parametrize("shard_bytes,block_bytes", [(24 << 20, 6 << 20), (300, 200)])
def test_scores_equal_brute_force(rows_of, monkeypatch, shard_bytes, block_bytes):
    monkeypatch.setattr(lm, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(lm, "SAMPLE", 2)
    used = [d is not None and d % 3 != 1 for d, _ in ROWS]
    got = lm.score_texts(rows_of(ROWS), train=F.col("doc_id") % 3 != 1).collect()
    same(map(tuple, got), brute(ROWS, used, 0.4))


def test_nothing_to_learn_and_empty_table(rows_of):
    got = lm.score_texts(rows_of(ROWS[:5]), train=F.lit(False)).collect()
    same(map(tuple, got), brute(ROWS[:5], [False] * 5, 0.4))
    schema = "doc_id long, text string, row long, word string"
    assert lm.score_texts(rows_of([(1, "a b", 7, "w")], schema)).count() == 1
    assert lm.score_texts(rows_of([(1, "a b", 7, "w")], schema).limit(0)).count() == 0


def test_better_than_the_base_on_held_out_texts(spark):
    got = op6_lm_scoring(spark, "/root/testdata/sf0.01")
    held = got.filter("held_out").agg(F.sum("score"), F.sum("base_score"), F.count("*")).first()
    assert held[2] > 100 and held[0] > held[1]
    first = got.filter("held_out").orderBy("doc_id").first()
    assert binascii.crc32(str(first.doc_id).encode()) % 7 == 2


@pytest.mark.parametrize("n,u", [(0, 10), (1, 1), (5, 6), (1000, 1 << 64), (3000, 4000), (70_000, 1 << 48)])
def test_elias_fano_round_trip(n, u):
    rng = np.random.default_rng(n)
    v = np.unique(rng.integers(0, min(u, 1 << 63), n, dtype=np.uint64))
    e = EliasFano.build(v, u)
    q = np.concatenate([v, rng.integers(0, min(u, 1 << 63), 2000, dtype=np.uint64)])
    assert (e.successor(q) == np.searchsorted(v, q)).all()
    assert (e.values(np.arange(len(v))) == v).all()
    assert ((e.find(q) >= 0) == np.isin(q, v)).all()
    if n > 50_000:
        assert sum(p.nbytes for p in e.parts()) * 8 / n < 40


def test_trie_round_trip():
    rng = np.random.default_rng(2)
    c, w = rng.integers(0, 1 << 63, 300, dtype=np.uint64), rng.integers(0, 1 << 48, 500, dtype=np.uint64)
    pairs = np.unique(np.stack([rng.choice(c, 4000), rng.choice(w, 4000)], 1), axis=0)
    logs = -rng.random(len(pairs)) * 5
    trie = BigramTrie.mapped(pairs[:, 0], pairs[:, 1], logs)
    assert (trie.lookup(pairs[:, 0], pairs[:, 1]) == np.rint(-logs * STEP)).all()
    known = {tuple(p) for p in pairs.tolist()}
    a, b = rng.choice(c, 2000), rng.choice(w, 2000)
    assert all((x >= 0) == (p in known) for x, p in zip(trie.lookup(a, b), zip(a.tolist(), b.tolist())))
    shuffled = rng.permutation(len(pairs))
    assert (trie.lookup(*pairs[shuffled].T) == np.rint(-logs * STEP)[shuffled]).all()
    begin, end = trie.successors(np.unique(pairs[:, 0]))
    assert begin[0] == 0 and (begin[1:] == end[:-1]).all() and end[-1] == len(pairs)


def test_lookup_goes_through_the_pointers():
    rng = np.random.default_rng(4)
    pairs = np.unique(np.stack([rng.integers(1, 50, 900, dtype=np.uint64), rng.integers(1, 60, 900, dtype=np.uint64)], 1), axis=0)
    trie = BigramTrie.build(pairs[:, 0], pairs[:, 1], -rng.random(len(pairs)))
    want = trie.lookup(pairs[:, 0], pairs[:, 1])
    assert (want >= 0).all()
    first = np.flatnonzero(np.append(True, pairs[1:, 0] != pairs[:-1, 0]))
    trie.pointers = EliasFano.build(np.append(first[1:], len(pairs)), len(pairs) + 1)  # every context leads to its neighbour's range
    assert (trie.lookup(pairs[:, 0], pairs[:, 1]) < 0).all()


@pytest.mark.parametrize("seed", range(4))
def test_search_within_a_range(seed):
    rng = np.random.default_rng(seed)
    v = np.unique(rng.integers(0, 5000, 700, dtype=np.uint64))
    e = EliasFano.build(v, 5000)
    a = rng.integers(0, len(v) + 1, 500)
    b = np.minimum(a + rng.integers(0, 90, 500), len(v))
    q = rng.integers(0, 5000, 500, dtype=np.uint64)
    want = [i + int(np.searchsorted(v[i:j], x)) for i, j, x in zip(a, b, q)]
    assert e.successor(q, a, b).tolist() == want


def test_rows_of_a_shard_carry_their_own_texts_only(monkeypatch):
    from types import SimpleNamespace
    import pandas as pd
    monkeypatch.setattr(lm, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    texts = [f"a{i} b{i}".encode() for i in range(400)]
    part = pd.DataFrame({"id": range(400), "body": texts, "trained": True})
    dealt = pd.concat(lm._dealer(200, lm.MARKS[:1])(iter([part])))
    dealt = dealt[dealt["context"].notna()]
    postings = dealt["word"].str.len().sum() // 6
    assert len(dealt) > 100 and dealt["trained"].str.len().sum() <= postings
    assert (dealt["trained"].str.len() <= dealt["word"].str.len() // 6).all()


def test_sums_by_slice_equal_sums_by_shard(monkeypatch):
    monkeypatch.setattr(lm, "HELD_TEXTS", 0, raising=True)
    used = [d is not None and d % 3 != 1 for d, _ in ROWS]
    shards = 40
    import pandas as pd
    from types import SimpleNamespace
    monkeypatch.setattr(lm, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    part = pd.DataFrame({"id": range(len(ROWS)), "body": [(t or "").encode() for _, t in ROWS], "trained": used})
    dealt = pd.concat(lm._dealer(shards, lm.MARKS[:1])(iter([part]))).sort_values("shard")
    hot = {int(lm.MARKS[0]): sum(used)}
    by_slice = pd.concat(lm._scorer(hot, 0.4)(iter([dealt])))
    monkeypatch.setattr(lm, "HELD_TEXTS", 1 << 18)
    whole = pd.concat(lm._scorer(hot, 0.4)(iter([dealt])))
    a, b = (x[x.kind == lm.SUMS].groupby("row")[list(lm.SUMMED)].sum() for x in (by_slice, whole))
    assert len(a) == len(ROWS) and np.allclose(a, b)


def test_frequent_contexts_of_a_group_of_copies_are_found(rows_of):
    for copy in ("aa bb", "cc dd ee", "ff gg hh ii", "jj kk"):  # whatever the hash of the text
        rows = [(i, copy if i % 3 == 0 else " ".join(f"w{i}x{j}" for j in range(4))) for i in range(900)]
        slim = rows_of(rows).selectExpr("doc_id AS id", "CAST(text AS binary) AS body", "true AS trained")
        hot = lm._hot_words(slim, 40)
        want = dict(zip((int(h) for h in lm._hash([w.encode() for w in copy.split()])), [300] * 9))
        assert hot == {**want, int(lm.MARKS[0]): 900}


def test_trimmed_counts():
    c = Counter({f"w{i}": i for i in range(1, 101)})
    got = lm._trimmed(c, 10)
    assert len(got) <= 10 and all(0 <= c[w] - got[w] <= sum(c.values()) / 11 for w in c)
