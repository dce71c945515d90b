import random
import re

from affinity.llm.decontaminate import TestIndex as Index
from affinity.llm.decontaminate import drop_contaminated

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, size=10):
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for item, text in items:
            iw = words(text)
            n = min(size, len(iw))
            wins = {tuple(iw[s:s + n]) for s in range(len(iw) - n + 1)} if n and item is not None else set()
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in wins:
                    hit.update(range(s, s + n))
                    found.add(str(item))
        out.append((d, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


def fixture(seed=7):
    rnd = random.Random(seed)
    voc = [f"w{i}" for i in range(60)] + ["the"] * 30 + ["Écoute", "Straße", "x9"]
    say = lambda n: " ".join(rnd.choices(voc, k=n))
    items = [(i, say(rnd.randint(11, 30))) for i in range(12)] + [(50, "short Item"), (51, None), (52, ""), (53, "..."), (54, "the " * 25),
                                                                  (55, "short Item"), (None, "the"), (56, say(10)), (3, "repeated id entirely other words here")]
    docs = [(i, say(rnd.randint(0, 60))) for i in range(40)]
    for i in range(40, 80):
        w = rnd.choice([t for _, t in items if t]).split()
        a = rnd.randint(0, max(0, len(w) - 10))
        part = " ".join(w[a:a + rnd.randint(5, 20)])
        docs.append((i, say(rnd.randint(0, 20)) + rnd.choice([" ", ", ", "\n--"]) + part.upper() + "; " + say(5)))
    docs += [(90, None), (91, ""), (92, "THE the, the " * 60), (40, docs[40][1]), (41, "the same id, but short item here"), (None, items[0][1]),
             (93, "straSSe " + items[1][1])]
    return docs, items


def test_against_brute_force(rows_of):
    docs, items = fixture()
    for size in (10, 3, 1):
        index = Index(rows_of(docs), rows_of(items, "item_id long, text string"), size)
        got = index.contamination().select("doc_id", "n_words", "n_hit", "items").collect()
        assert sorted(map(tuple, got), key=repr) == brute(docs, items, size)


def test_rows_that_stay_and_clashing_columns(rows_of):
    docs, items = fixture(8)
    schema = "doc_id long, text string, tag int, win int, pos string, term string"
    kept = drop_contaminated(rows_of([(d, t, 1, 2, "p", "q") for d, t in docs], schema), rows_of(items, "item_id long, text string"))
    assert kept.columns == ["doc_id", "text", "tag", "win", "pos", "term"]
    clean = [(d, t) for d, t in docs if brute([(d, t)], items)[0][2] == 0]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(clean, key=repr)


def test_empty_tables(rows_of):
    docs, items = (rows_of(x, s) for x, s in zip(fixture(), ("doc_id long, text string", "item_id long, text string")))
    assert Index(docs.limit(0), items, 10).contamination().count() == 0
    assert Index(docs, items.limit(0), 10).contamination().filter("n_hit > 0").count() == 0


def test_proximity(rows_of):
    filler = " ".join(["and"] * 30)
    docs = [(1, f"alpha {filler} beta x gamma"), (2, f"beta {filler} {filler} alpha {filler} gamma"), (3, "alpha beta")]
    index = Index(rows_of(docs), rows_of([(7, "alpha beta gamma and")], "item_id long, text string"), 4)
    assert {(r.item_id, r.doc_id) for r in index.proximity_matches(rare=3, span=40).collect()} == {("7", 1)}
    assert {r.doc_id for r in index.proximity_matches(rare=3, span=200).collect()} == {1, 2}
