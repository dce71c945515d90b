import numpy as np

from affinity.llm.ann import nearest
from affinity.llm.queries import op8_nearest_neighbours


def exact(ids, vecs, query_ids, k):
    out = {}
    norm = np.sqrt(np.einsum("ij,ij->i", vecs, vecs))
    for q in query_ids:
        i = ids.index(q)
        cos = vecs @ vecs[i] / (norm * norm[i])
        out[q] = sorted(((-c, v) for c, v in zip(cos, ids) if v != q))[:k]
    return out


def test_recall_on_the_test_table(spark):
    sf = "/root/testdata/sf0.1"
    got = op8_nearest_neighbours(spark, sf).collect()
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, vecs = [r.vec_id for r in rows], np.array([r.embedding for r in rows], np.float64)
    want = exact(ids, vecs, [i for i in ids if i % 50 == 0], 5)
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(found) == set(want)
    hits = 0
    for q, ranked in found.items():
        ranked.sort()
        assert [r[0] for r in ranked] == [1, 2, 3, 4, 5]
        assert [(-s, v) for _, v, s in ranked] == sorted((-s, v) for _, v, s in ranked)
        hits += len({v for _, v, _ in ranked} & {v for _, v in want[q]})
    assert hits / sum(map(len, want.values())) >= 0.95


def test_edge_rows(spark):
    rng = np.random.default_rng(0)
    nan, inf = float("nan"), float("inf")
    rows = [(i, rng.standard_normal(4).tolist(), "x") for i in range(30)]
    rows += [(100 + i, [1.0, 2.0, 3.0, 4.0], "copy") for i in range(40)]
    rows += [(200, None, ""), (201, [], ""), (202, [0.0] * 4, ""), (203, [1.0, None, 1.0, 1.0], ""), (204, [nan, 1.0, 1.0, 1.0], ""),
             (205, [inf, 1.0, 1.0, 1.0], ""), (206, [1.0, 2.0], ""), (None, [1.0] * 4, ""), (3, rows[3][1], "again"), (300, [1e200, 0.0, 0.0, 1e200], "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, node string")
    got = nearest(df, k=5).collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(by) == {*range(30), *range(100, 140), 300}
    assert [v for _, v, _ in sorted(by[100])] == [101, 102, 103, 104, 105] and [v for _, v, _ in sorted(by[103])] == [100, 101, 102, 104, 105]
    assert all(abs(s - 1) < 1e-12 for _, _, s in by[120])
    few = nearest(df.filter("vec_id < 3"), k=5).collect()
    assert len(few) == 6
    assert nearest(df.limit(0), k=5).count() == 0 and nearest(df.filter("vec_id = 1"), k=5).count() == 0
