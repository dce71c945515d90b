import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer, models

from affinity.llm.token_counts import MARK, PieceCounter, count_tokens, read_vocabulary

PATH = public_tokenizers.path("piece_bpe_32k.model")


def tokens_of(vocabulary, fallback):
    bytes_ = [(f"<0x{i:02X}>", -1e12) for i in range(256)] if fallback else []
    model = Tokenizer(models.Unigram([("<unk>", 0.0), *vocabulary, *bytes_], 0, fallback))
    return lambda text: len(model.encode(text, add_special_tokens=False).ids)


def texts(seed, n=150):
    rnd = random.Random(seed)
    parts = ["the", "Straße", "  ", "\n", "naïve", "漢", "字", "supercalifragilistic", "🙂", "of", "a", "x" * 30, "1234", "\t", "...", "ing", "ſ", "▁"]
    return ["".join(rnd.choice([p, p + " "]) for p in rnd.choices(parts, k=rnd.randint(1, 40))) for _ in range(n)] + ["a", " ", "   ", " a b ", "🙂🙂🙂"]


@pytest.fixture(scope="module")
def vocabulary():
    return read_vocabulary(PATH)


def test_counts_equal_the_tokenizer(vocabulary):
    # byte pieces never match as text in the reference: none of the texts spells one
    counter = PieceCounter(vocabulary)
    low = [(p, s) for p, s in vocabulary]
    reference = tokens_of(low, True)
    for t in texts(1):
        # the reference's unknown cost is below its lowest score, which the byte pieces would shift
        assert counter.count(t)[0] == pytest.approx(counter.segment(MARK + t.replace(" ", MARK))[0])
    for t in texts(2):
        if all(c in counter.single or c == " " for c in t):
            assert counter.count(t)[0] == reference(MARK + t.replace(" ", MARK)), t


@pytest.mark.parametrize("seed", range(6))
def test_ties_and_unknown_runs_on_small_vocabularies(seed):
    rnd = random.Random(seed)
    pieces = {c for c in "abc" + MARK}
    while len(pieces) < 25:
        pieces.add("".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 4))))
    pieces.discard("d")
    voc = [(p, -float(rnd.randint(1, 4))) for p in sorted(pieces)]
    reference, counter = tokens_of(voc, False), PieceCounter(voc, byte_fallback=False)
    for _ in range(300):
        t = "".join(rnd.choice("abcd z ") for _ in range(rnd.randint(1, 25)))
        marked = MARK + t.replace(" ", MARK)
        assert counter.count(t)[0] == reference(marked), (t, voc)
        assert counter.segment(marked) == counter.count(t)


def test_edge_rows(rows_of):
    rows = [(1, None, "a"), (2, "", "b"), (3, "word " * 50_000, "c"), (3, "word " * 50_000, "c"), (None, "é漢", None)]
    got = count_tokens(rows_of(rows, "doc_id long, text string, n_tokens string"), PATH)
    assert got.columns == ["doc_id", "text", "n_tokens", "n_unknown", "best_score"]
    by = {r.doc_id: (r.n_tokens, r.best_score) for r in got.collect()}
    word = PieceCounter(read_vocabulary(PATH)).count("word")[0]
    assert by[1] == by[2] == (0, 0.0) and by[3][0] == 50_000 * word + 1 and by[None][0] >= 2
    assert count_tokens(rows_of(rows, "doc_id long, text string, x string").limit(0), PATH).count() == 0
