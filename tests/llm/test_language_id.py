import numpy as np
import pytest
from pyspark.sql import functions as F

from affinity.llm import language_id as L
from affinity.llm.queries import op2_language_id


def phrases(sample, text):
    """Greedy longest matches, by brute force."""
    n, i = 0, 0
    while i < len(text):
        j = i + 1
        while j <= len(text) and text[i:j] in sample:
            j += 1
        i = max(j - 1, i + 1)
        n += 1
    return n


def test_costs_equal_brute_force():
    rng = np.random.default_rng(3)
    sample = (("aa", "abracadabra hocus"), ("bb", "simsalabim zzz"), ("cc", "lorem ipsum dolor sit amet"))
    parser = L.CrossParser(sample)
    texts = ["", None, "12 34!", "abra simsala", "lorem", "q", "zzzzzz", "ÄÖ ab"] + [
        "".join(rng.choice(list("abcdrsimlz hou"), 300)) for _ in range(20)]
    cost, sizes = parser.costs(texts)
    for text, own, size in zip(texts, cost, sizes):
        clean = " ".join("".join(c if c.isalpha() else " " for c in (text or "").lower()).split())
        assert size == len(clean)
        for (lang, s), got in zip(sample, own):
            assert got == pytest.approx(phrases(s, clean) * np.log2(len(s) + 1) / max(len(clean), 1))


def test_long_text_is_read_whole():
    parser = L.CrossParser((("aa", "aaaa aaab"), ("bb", "bbbb bbba")))
    text = "a" * 3000 + " " + "b" * 40_000
    cost, sizes = parser.costs([text])
    assert sizes[0] == len(text) and parser.predict([text])[0] == ["bb"]


@pytest.mark.parametrize("lane,few,table", [(1, 0, 0), (3, 0, 1 << 25), (7, 0, 0), (7, 5, 1 << 25), (1024, 0, 0), (50, 24, 0), (50, 24, 1 << 25)])
def test_phrases_cross_lanes(lane, few, table, monkeypatch):
    for name, value in (("LANE", lane), ("FEW", few), ("TABLE_BYTES", table)):
        monkeypatch.setattr(L, name, value)
    rng = np.random.default_rng(lane)
    sample = (("aa", "abababab aaaaaaa bbab"), ("bb", "the quick brown fox " * 3), ("cc", "xyz"))
    parser = L.CrossParser(sample)
    texts = ["a" * 500, "ab" * 300, "the quick brown fox " * 40, "x", "", "aaab" * 90 + "the quick", "12 " * 5] + [
        "".join(rng.choice(list("abthequick fox"), rng.integers(1, 400))) for _ in range(12)]
    cost, sizes = parser.costs(texts)
    for text, own in zip(texts, cost):
        clean = " ".join("".join(c if c.isalpha() else " " for c in text).split())
        assert list(own) == [pytest.approx(phrases(s.strip(), clean) * np.log2(len(s.strip()) + 1) / max(len(clean), 1)) for _, s in sample]


def test_text_of_twenty_thousand_symbols_equals_brute_force():
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("abcdefgh"), rng.integers(1, 9))) for _ in range(60)]
    sample = " ".join(rng.choice(words, 400))
    text = " ".join(rng.choice(words, 4200))[:20_000].strip()
    cost, _ = L.CrossParser((("aa", sample),)).costs([text])
    assert cost[0, 0] == pytest.approx(phrases(sample, text) * np.log2(len(sample) + 1) / len(text))


def test_large_alphabet_stays_small():
    rng = np.random.default_rng(9)
    letters = [chr(0x4E00 + i) for i in range(3000)]
    parser = L.CrossParser(tuple((f"l{k}", "".join(rng.choice(letters, 65_000))) for k in range(4)))
    held = sum(e.nbytes for e in parser.parsers) + parser.table.nbytes
    assert held < 100e6 and parser.predict(["".join(rng.choice(letters, 500)), "xyz"])[0][0] in {"l0", "l1", "l2", "l3"}


def test_edge_rows(rows_of):
    schema = "doc_id long, text string, lang string, score string, sample int"
    rows = [(i, "the cat sat on the mat " * 3, "en", "x", 1) for i in range(5)] + [
        (9 + i, "le chat est sur la table " * 3, "fr", "x", 1) for i in range(5)] + [
        (20, None, "en", None, 1), (21, "", "fr", None, 1), (22, "123 ++", "de", None, 1), (None, "the mat", None, None, None),
        (23, "le chat", None, None, None), (23, "le chat", None, None, None), (24, "Привет", None, None, None)]
    got = L.identify(rows_of(rows, schema))
    assert got.columns == ["doc_id", "text", "lang", "sample", "lang_pred", "score"]
    by = {}
    for r in got.collect():
        by.setdefault(r.doc_id, set()).add((r.lang_pred, r.score >= 0 and r.score <= 1))
    assert by[20] == by[21] == by[22] == {("und", True)} and by[None] == {("en", True)} and by[23] == {("fr", True)}
    assert by[24] in ({("en", True)}, {("fr", True)})
    nothing = L.identify(rows_of(rows, schema), learn=F.lit(False)).select("lang_pred").distinct().collect()
    assert [r[0] for r in nothing] == ["und"]
    assert L.identify(rows_of(rows, schema).limit(0)).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = op2_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert held[1] > 200 and held[0] > 0.98


def test_sample_reads_the_whole_text_not_its_header(rows_of):
    words = {"en": "the cat sat on the mat and looked at a bird in the old garden ", "fr": "le chat est sur la table et regarde un oiseau dans le vieux jardin "}
    header = "Allgemeine Hinweise zur Nutzung dieser Sammlung und ihrer Quellen im Netz. " * 4
    rows = [(i, header + words[lang] * 60, lang) for i in range(40) for lang in [["en", "fr"][i % 2]]] + [
        (100 + i, words[lang], None) for i in range(6) for lang in [["en", "fr"][i % 2]]]
    frame = rows_of(rows, "doc_id long, text string, lang string")
    sample = dict(L.labelled_sample(frame, docs_per_lang=8))
    assert all(words[lang][:20].strip() in text and max(map(len, text.split("\n"))) == 256 for lang, text in sample.items())
    assert sample == dict(L.labelled_sample(frame.repartition(5), docs_per_lang=8))
    got = {r.doc_id: r.lang_pred for r in L.identify(frame).filter("lang IS NULL").collect()}
    assert got == {100 + i: ["en", "fr"][i % 2] for i in range(6)}
