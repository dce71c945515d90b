import random

import xxhash

from affinity.llm.graph import connected_components
from affinity.llm.simhash import keep_one_of_each, near_duplicates, simhash


def brute_print(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(rows, bits=3):
    prints = [brute_print(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, f"{prints[i]:016x}", low.get(find(i))) for i, (d, _) in enumerate(rows)), key=repr)


def corpus(seed=1, n=120):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rnd.choices(words, k=rnd.randint(20, 200))) for _ in range(12)]
    rows = []
    for i in range(n):
        w = rnd.choice(base).split()
        for _ in range(rnd.choice([0, 0, 1, 2])):
            w[rnd.randrange(len(w))] = rnd.choice(words)
        rows.append((i, " ".join(w)))
    return rows


def test_prints_equal_brute_force():
    for text in ("", "  \t", "One", "one two", "A b C", "x  y\x0bz q w", "é É è " * 9, "a b c " * 70_000):
        assert simhash(text.encode()) & (2**64 - 1) == brute_print(text)


def test_components_equal_brute_force(rows_of):
    rows = corpus() + [(200, None), (201, ""), (202, " "), (5, "the same id with other text"), (None, "no id at all"), (203, "no id at all"), (3, corpus()[3][1])]
    got = near_duplicates(rows_of(rows, parts=5)).collect()
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=repr) == brute(rows)


def test_one_of_each_stays(rows_of):
    rows = [(i, t, "s", i) for i, t in corpus(2)] + [(0, corpus(2)[0][1], "s", 0), (300, None, None, None)]
    kept = keep_one_of_each(rows_of(rows, "doc_id long, text string, source string, fp long"))
    ids = sorted(r.doc_id for r in kept.collect())
    assert ids == sorted({c for _, _, c in brute([(a, b) for a, b, *_ in rows])})
    assert kept.columns == ["doc_id", "text", "source", "fp"]
    assert keep_one_of_each(rows_of(rows, "doc_id long, text string, source string, fp long").limit(0)).count() == 0


def test_dense_group_stays_linear():
    import numpy as np

    from affinity.llm.simhash import _forest

    rng = np.random.default_rng(0)
    near = np.unique(np.array([sum(1 << int(b) for b in rng.choice(32, rng.integers(0, 4), False)) for _ in range(3000)], np.int64))
    links = _forest(near, 3)
    assert len(links) == len(near) - 1


def test_chain_components(spark):
    links = [(i, i + 1) for i in range(60)] + [(-5, 100), (100, 101), (7, 7)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{x: -5 for x in (-5, 100, 101)}}
