from collections import defaultdict

from affinity.llm import line_dedup
from affinity.llm.line_dedup import dedup_lines

BLANK = " \t\n\x0b\x0c\r"


def ascii_lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def brute(rows, min_chars=20, min_docs=3):
    key = lambda line: ascii_lower(line.strip(BLANK))
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars and i is not None:
                holders[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(holders[key(x)]) < min_docs or max(holders[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def test_against_brute_force(rows_of):
    shared = "This LINE is shared by documents"
    umlaut = "ÄÖÜ" * 7
    rows = [(1, shared + "\nown line that is quite long one"), (2, "  " + shared.lower() + "\t\nx"), (3, shared + "\n" + shared + "\r"),
            (4, None), (5, ""), (6, "\n\n"), (7, "short line\n" + umlaut[:19]), (8, "short line\n" + umlaut), (9, "short line\n" + umlaut),
            (10, umlaut + "\n" + umlaut.lower()), (11, "a" * 100_000 + "\n" + shared), (12, shared), (12, shared), (None, shared), (13, " " + shared)]
    got = dedup_lines(rows_of(rows)).select("doc_id", "n_lines", "n_dropped", "text").collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_clashing_columns_and_empty_table(rows_of, spark):
    schema = "doc_id long, text string, n_lines string, h1 int, id string, kept int, keeper int"
    df = rows_of([(i, "the very same long line here\nx", "a", i, "b", 7, 8) for i in range(4)], schema)
    got = dedup_lines(df)
    assert {"h1", "id", "kept", "keeper", "n_lines", "n_dropped"} <= set(got.columns)
    assert sorted((r.doc_id, r.n_dropped, r.h1, r.id, r.kept) for r in got.collect()) == [
        (i, int(i < 3), i, "b", 7) for i in range(4)]
    assert dedup_lines(df.limit(0)).count() == 0


def test_hot_line_keeps_only_the_largest(rows_of):
    rows = [(i, f"one line that every document holds\nown {i}") for i in range(500)]
    got = {r.doc_id: r.text for r in dedup_lines(rows_of(rows, parts=7)).collect()}
    assert got[499].startswith("one line") and all(got[i] == f"own {i}" for i in range(499))


def test_hot_lines_and_others_by_the_same_rule(rows_of, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT_PARTS", 5)
    rows = [(i, f"one line that every document holds\nline of a third number {i % 3}, long\nrare line of some {i % 70} documents\nown {i}, not shared")
            for i in range(200)] + [(5, "one line that every document holds"), (None, "one line that every document holds")]
    got = dedup_lines(rows_of(rows, parts=6)).select("doc_id", "n_lines", "n_dropped", "text").collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)
