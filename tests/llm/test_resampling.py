import binascii
import hashlib
import math
import random
import re

import numpy as np

from affinity.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def buckets_of(text, size):
    w = words(text)
    return [binascii.crc32(" ".join(w[i:i + n]).encode()) % size for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute(docs, target, percent, min_words, size):
    s, t = [0] * size, [0] * size
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for x in texts:
            for b in buckets_of(x, size):
                counts[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + size) / ((s[b] + 1) * (sum(t) + size)))) for b in range(size)]
    out = []
    for i, x in docs:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        found = buckets_of(x, size)
        weight = sum(gain[b] for b in found)
        out.append((i, len(words(x)), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0]))
    drawn = [(*r, n + 1) for n, r in enumerate(able[:percent * len(able) // 100])]
    rest = [(*r, None) for r in able[len(drawn):]] + [(*r, None) for r in out if r[1] < min_words]
    return sorted(drawn + rest, key=repr)


def texts(n, seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}é" if i % 3 else f"W{i}" for i in range(60)]
    return [" ".join(rnd.choices(vocabulary, k=rnd.randint(0, 40))) + rnd.choice(["", "!", "\n"]) for _ in range(n)]


def got(df, target, **options):
    return sorted((tuple(r) for r in resampling.resample(df, target, **options).collect()), key=repr)


def test_against_brute_force(rows_of, spark):
    docs = list(enumerate(texts(400, 1)))
    docs += [(1000 + i, docs[7][1]) for i in range(200)]  # copies: a third of all
    docs += [(2000, None), (2001, ""), (2002, "word " * 30_000), (None, docs[3][1]), (-5, "a-b_c\x00d\x7fe Ünï")]
    wanted = texts(30, 2) + [None, ""]
    df = rows_of(docs, parts=9)
    target = spark.createDataFrame([(x,) for x in wanted], "text string")
    for percent, size, samples, segments in ((5, 997, 1 << 16, 4), (60, 50, 16, 7), (100, 997, 64, 3), (0, 997, 64, 3), (1, 997, 3, 11)):
        assert got(df, target, percent=percent, buckets=size, samples=samples, segments=segments) == brute(docs, wanted, percent, 20, size)


def test_equal_ids_and_scores_get_ranks_without_gaps(rows_of, spark):
    docs = [(1, "same words " * 15)] * 300 + [(None, "same words " * 15)] * 100 + [(i, t) for i, t in enumerate(texts(200, 4), 10)]
    out = got(rows_of(docs, parts=8), spark.createDataFrame([("same words",)], "text string"), percent=80, samples=40, segments=6)
    assert out == brute(docs, ["same words"], 80, 20, 10000)


def test_segments_hold_about_equal_shares(rows_of):
    df = rows_of([(i % 3, "x") for i in range(4000)], parts=16).selectExpr("true AS eligible", "42L AS score", "doc_id AS key")
    runs = resampling.sorted_runs(df)
    splitters = resampling.regular_splitters(runs, 4000, 400, 8)
    sizes = [r["count"] for r in runs.groupBy(resampling.segment_of(splitters).alias("s")).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 4000 / 8  # one score only, three ids


def test_empty_tables_and_other_columns(rows_of, spark):
    target = spark.createDataFrame([("a b c",)], "text string")
    df = rows_of([(i, "a b c d e", "x", 3) for i in range(50)], "doc_id long, text string, score string, id int")
    out = got(df, target, percent=50, min_words=5)
    assert out == brute([(i, "a b c d e") for i in range(50)], ["a b c"], 50, 5, 10000)
    assert resampling.resample(df.limit(0), target).count() == 0
    assert got(df, target.limit(0), percent=50, min_words=5) == brute([(i, "a b c d e") for i in range(50)], [], 50, 5, 10000)


def test_codes_of_runs_are_those_of_joined_words():
    n, codes = resampling.feature_codes("Ab cÉ-d".encode())
    joined = ["ab", "cÉ", "d", "ab cÉ", "cÉ d", "ab cÉ d"]
    assert n == 3 and codes.tolist() == [binascii.crc32(x.encode()) for x in joined]
    assert resampling.feature_codes(None)[1].dtype == np.uint32
