import random
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))

import test_decontaminate  # noqa: E402
import test_line_dedup  # noqa: E402
import test_packing  # noqa: E402
import test_simhash  # noqa: E402

import corpus_pipeline  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rnd = random.Random(3)
    voc = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    say = lambda n: " ".join(rnd.choices(voc, k=n))
    line = "A license line, found in many documents"
    items = [(i, say(20)) for i in range(5)]
    rows = [(i, say(rnd.randint(30, 120)) + "\n" + (line if i % 4 == 0 else say(5))) for i in range(60)]
    rows += [(60 + i, rows[i][1]) for i in range(10)]  # exact copies
    rows += [(70 + i, say(40) + " " + items[i % 5][1].upper() + " " + say(3)) for i in range(6)]
    rows += [(80, None), (81, ""), (82, "123 456 --"), (83, line), (84, " " + line.lower()), (85, "Ok"), (5, rows[5][1]), (86, say(5000))]
    return [(d, t, "en", "s", len(t or "")) for d, t in rows], items


def brute(rows, items):
    docs = [(d, t) for d, t, *_ in rows if any(c.isalpha() for c in t or "")]
    deduped = test_line_dedup.brute(docs)
    docs = [(d, t) for d, _, _, t in deduped]
    stays = {c for _, _, c in test_simhash.brute(docs)}
    docs = list(dict(x for x in docs if x[0] in stays).items())
    clean = {d for d, _, n, _ in test_decontaminate.brute(docs, items) if n == 0}
    return [x for x in docs if x[0] in clean]


def test_stages_and_run(spark, tmp_path):
    rows, items = corpus()
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert out.columns == columns
        out.write.parquet(f"{tmp_path}/stage{k}")
        docs = spark.read.parquet(f"{tmp_path}/stage{k}")
    want = test_packing.expected_pieces(brute(rows, items), 2048)
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    for got in (docs.collect(), whole):
        assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == want
        test_packing.check_layout(got, 2048)


def test_lengths_follow_the_text(spark, tmp_path):
    rows, items = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    out = corpus_pipeline.dedup_lines(spark, docs, str(tmp_path)).collect()
    assert all(r.n_chars == len(r.text) for r in out)


def test_empty_table(spark, tmp_path):
    _, items = corpus()
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
