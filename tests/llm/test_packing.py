import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from affinity.llm.packing import OpenBins, pack

PATH = public_tokenizers.path("byte_bpe_50k.json")


def expected_pieces(rows, cap):
    t = Tokenizer.from_file(PATH)
    out = []
    for i, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        first = len(ids) % cap or cap
        cuts = [0, *range(first, len(ids) + 1, cap)]
        out += [(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    return sorted(out, key=repr)


def check_layout(got, cap):
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= cap
    return len(bins)


def rows():
    rnd = random.Random(4)
    words = ["the", "cat", "Straße", "naïve", "x1", "don't", "hello,", "漢字", " ", "a\nb", "\t", "<|endoftext|>", "***", "1234567", "A" * 90]
    out = [(i, " ".join(rnd.choices(words, k=rnd.randint(0, 60)))) for i in range(80)]
    out += [(100, None), (101, ""), (102, " "), (103, "   three  and two \n\n lines \r\n x"), (104, "word " * 400), (0, out[0][1]),
            (None, "no id"), (105, "\x1c \x85 x"), (106, "é" * 500), (107, "  lead"), (108, "trail  ")]
    return out


@pytest.mark.parametrize("cap,open_bins", [(64, 1024), (2048, 4), (7, 3)])
def test_pieces_and_layout(rows_of, cap, open_bins):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken") if cap > 7 else None
    got = pack(rows_of(rows()), PATH, capacity=cap, open_bins=open_bins, ranks=ranks).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == expected_pieces(
        [(i, t) for i, t in rows()], cap)
    n = check_layout(got, cap)
    total = sum(r.length for r in got)
    if open_bins > 100:
        assert n <= 1.1 * total / cap + 2


def test_few_sequences(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").repartition(6)
    got = pack(docs, PATH).collect()
    assert check_layout(got, 2048) <= 1.02 * sum(r.length for r in got) / 2048 + 1


def test_both_encoders_agree(spark):
    from affinity.llm.packing import ChunkEncoder

    rnd = random.Random(9)
    alphabet = "abcdefgh EéßÄñ'sdt.,!?*0123456789\n()\"@ʼ漢\u2003"
    texts = ["".join(rnd.choices(alphabet, k=rnd.randint(1, 60))) for _ in range(3000)]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    plain, quick = ChunkEncoder(PATH), ChunkEncoder(PATH, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    whole = Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)
    for a, b, c in zip(plain.batch(texts), quick.batch(texts), whole):
        assert a.tolist() == b.tolist() == c.ids


def test_empty_table(rows_of):
    assert pack(rows_of(rows()).limit(0), PATH).count() == 0


def test_open_bins_closes_the_fullest():
    bins = OpenBins(10, 2)
    assert list(bins.put("a", 6)) == [] and list(bins.put("b", 7)) == []
    assert list(bins.put("c", 9)) == [["c"]]  # three open: the fullest closes
    assert list(bins.put("d", 3)) == [["b", "d"]]  # best fit, and full
    assert list(bins.rest()) == [["a"]] and list(bins.rest()) == []
