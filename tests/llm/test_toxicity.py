import random

import pytest

from affinity.llm import queries, toxicity

SF01 = "/root/testdata/sf0.01"

INSULTS = ["grumblewort", "snorkface", "blatherskite", "numpty"]


def corpus(n, seed, toxic_share=0.25, insult=lambda rnd: rnd.choice(INSULTS)):
    rnd = random.Random(seed)
    plain = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "pu") for b in ("ra", "to", "shi", "ven", "dor", "lle")]
    docs, labels = [], []
    for i in range(n):
        words = rnd.choices(plain, k=rnd.randint(15, 60))
        toxic = int(rnd.random() < toxic_share)
        for _ in range(rnd.randint(1, 4) if toxic else 0):
            words.insert(rnd.randrange(len(words)), insult(rnd))
        docs.append((i, " ".join(words) + rnd.choice([".", "!", ""])))
        labels.append((i, toxic))
    return docs, labels


@pytest.fixture(scope="module")
def learned(spark):
    docs, labels = corpus(600, 1)
    return toxicity.fit(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"),
                        trees=8)


def test_lexicon_holds_the_insults_alone(learned):
    assert set(learned.lexicon.weights) == set(INSULTS)


def test_held_out_texts(learned, rows_of):
    docs, labels = corpus(300, 2)
    out = {r.doc_id: (r.score, r.predicted) for r in learned.score(rows_of(docs)).collect()}
    assert len(out) == 300 and all(0 <= s <= 1 and p == (s >= 0.7) for s, p in out.values())
    right = sum(out[i][1] == t for i, t in labels)
    assert right >= 295


def test_disguised_insults(learned, rows_of):
    ways = [lambda w: w.replace("o", "0").replace("e", "3"), lambda w: w.replace("u", "uuuu").replace("a", "aaaa"),
            lambda w: w[0] + "*" * (len(w) - 2) + w[-1], lambda w: " ".join(w), str.upper, lambda w: w + "###"]
    for way in ways:
        lexicon = learned.lexicon
        for word in ("snorkface", "grumblewort"):
            values = dict(zip(toxicity.FEATURES, toxicity.measure(f"kara {way(word)} miven", lexicon)))
            assert values["lexicon_hits"] > 0, way(word)
    clean = dict(zip(toxicity.FEATURES, toxicity.measure("kara 100% mi-ven l'ora a@b.de 3rd n*m", learned.lexicon)))
    assert clean["lexicon_hits"] == 0


def test_nulls_empty_and_long_texts_and_other_columns(learned, spark):
    rows = [(1, None, "a", 5), (2, "", "b", 6), (None, "kara " * 50_000 + "numpty", "c", 7), (4, "numpty " * 20_000, None, None), (4, "x" * 300_000, "", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string, probability int")
    out = learned.score(df)
    assert out.columns == ["doc_id", "text", "probability", "score", "predicted"]
    got = out.collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    by = {(r.doc_id, r.probability): r.score for r in got}
    assert by[1, 5] == by[2, 6] and by[4, None] > 0.9
    assert learned.score(df.limit(0)).count() == 0


def test_one_label_or_none(spark):
    docs, _ = corpus(20, 3)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for labels, score in (([], 0.0), ([(1, 0), (2, 0)], 0.0), ([(1, 1), (2, 1), (3, None), (None, 0)], 1.0)):
        model = toxicity.fit(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert {(r.score, r.predicted) for r in model.score(df).collect()} == {(score, int(score))}


def test_sample_is_bounded_and_a_text_teaches_once(spark):
    docs, labels = corpus(200, 4)
    docs += [(1000 + i, "one copied text") for i in range(100)]
    labels += [(1000 + i, 1) for i in range(100)]
    df, known = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    every = toxicity.labelled_sample(df, known, "toxic", "doc_id", "text", 1000, 4).collect()
    assert sum(r.text == "one copied text" for r in every) == 1 and len(every) == 201
    assert len(toxicity.labelled_sample(df, known, "toxic", "doc_id", "text", 30, 4).collect()) <= 30


def test_query_on_held_out_documents(spark):
    out = {r.doc_id: r for r in queries.op12_toxicity(spark, SF01).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    assert len(out) == spark.read.parquet(f"{SF01}/documents.parquet").count()
    pairs = [(out[i].score, t) for i, t in labels.items() if i in out and out[i].held_out and t is not None]
    toxic, clean = [s for s, t in pairs if t], [s for s, t in pairs if not t]
    auc = sum((a > b) + 0.5 * (a == b) for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert auc > 0.85, auc
