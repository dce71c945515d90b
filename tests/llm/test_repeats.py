import random
from collections import Counter

import numpy as np
import pytest

from affinity.llm import repeats
from affinity.llm.repeats import remove_repeats


def brute(texts, w):
    c = Counter(t[i:i + w] for t in texts for i in range(len(t) - w + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - w + 1):
            if c[t[i:i + w]] > 1:
                gone[i:i + w] = b"\1" * w
        spans = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), spans, bytes(x for x, g in zip(t, gone) if not g)))
    return out


def fixture(seed):
    rnd = random.Random(seed)
    txt = lambda n: "".join(rnd.choice("abcdefgh é") for _ in range(n))
    p, q = txt(700), txt(450)
    changed = p[:300] + "X" + p[301:]
    docs = [txt(500) + p + txt(300), txt(100) + p, p, p, changed, q[:230] + txt(90) + q[200:], q + txt(10) + q, "a" * 1000,
            "ab" * 400 + txt(50), None, "", txt(150), p[:250], p[100:301] + "zz" + p[400:640], "x" + "a" * 199, "y" + "a" * 199 + "z",
            "line of text here " * 30 + txt(40), q[:199], q[1:201] + txt(30)]
    docs += [txt(rnd.randint(0, 80)) + p[rnd.randint(0, 400):][:rnd.randint(100, 400)] + txt(rnd.randint(0, 120)) for _ in range(60)]
    return list(enumerate(docs)) + [(3, p), (None, p[:333]), (None, txt(260))]


@pytest.mark.parametrize("seed,width,hot", [(5, 200, None), (6, 200, 3), (7, 40, None)])
def test_against_brute_force(rows_of, seed, width, hot, monkeypatch):
    if hot:  # every key of more than so many rows counts as hot
        monkeypatch.setattr(repeats, "HOT_KEYS", 1 << 40)
        monkeypatch.setattr(repeats, "HOT_PARTS", hot)
    rows = fixture(seed)
    got = remove_repeats(rows_of(rows), width).collect()
    want = [(i, *e) for (i, _), e in zip(rows, brute([(t or "").encode() for _, t in rows], width))]
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got), key=repr) == sorted(want, key=repr)


def test_long_text_and_extra_columns(rows_of, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK", 1000)
    rnd = random.Random(1)
    long = "".join(rnd.choice("abcdefghij") for _ in range(5000))
    rows = [(1, long + long[500:900], 1, "x"), (2, long[3000:3300], 2, "y")]
    texts = [r[1].encode() for r in rows]
    runs = list(repeats.text_runs(texts, 200))
    assert sum((r["far"] - r["near"] + 1).sum() for r in runs) == sum(len(t) - 199 for t in texts)
    got = remove_repeats(rows_of(rows, "doc_id long, text string, place int, bucket string")).collect()
    assert sorted((r.doc_id, r.n_removed, r.n_spans) for r in got) == [(i, e[1], e[2]) for (i, *_), e in zip(rows, brute(texts, 200))]
    assert remove_repeats(rows_of(rows[:0], "doc_id long, text string, place int, bucket string")).count() == 0


def test_refined_buckets_are_those_of_equal_bytes():
    """At every depth two places share a bucket exactly if their bytes are equal."""
    rnd = random.Random(3)
    buf = bytes(rnd.choice(b"ab") for _ in range(1500)) + b"a" * 900 + b"ab" * 300
    grams = repeats._gram_buckets(np.frombuffer(buf, np.uint8))
    bytes_of, bucket_of = {}, {}
    for size in (32, 33, 63, 64, 65, 127, 128, 158, 190, 200, 255, 256, 257, 368):
        place = np.arange(len(buf) - size + 1)
        for at, bucket in enumerate(repeats._refined(grams, place, np.full(len(place), size)).tolist()):
            own = buf[at:at + size]
            assert bytes_of.setdefault(bucket, own) == own
            assert bucket_of.setdefault(own, bucket) == bucket
