"""Token counts of a unigram tokenizer, without the tokens.

An Aho-Corasick automaton over the vocabulary enumerates every piece that
occurs in a text; dynamic programming over the positions carries the best
score and the number of pieces on the best path, nothing else. The tie rules
are the tokenizer's: at each end the piece with the earlier start is tried
first and only a strictly better score replaces it; a character that is no
piece of its own is an unknown step costing ten below the lowest score, and is
counted by its UTF-8 bytes (byte fallback), or as one token for a run of
unknown characters.

Spaces become the marker U+2581 and one marker is put before the text. If no
piece has the marker after another character, the best path of a text is the
best paths of its words side by side, so words are counted once and remembered
in a bounded cache. Scores are added as doubles; whole-number scores, as in
the public vocabulary, add exactly.

Defined results: a null or empty text has no tokens and score 0; every row has
a result, repeated rows alike; other columns pass through, ``n_tokens``,
``n_unknown`` and ``best_score`` are replaced if present.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import ship_code

MARK = "▁"
UNKNOWN_COST = 10.0
CACHE, CHUNK_CHARS = 500_000, 64
WORDS = re.compile(f"{MARK}+[^{MARK}]*")


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) of the ordinary pieces of a sentencepiece model file."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(m.id_to_piece(i), m.get_score(i)) for i in range(m.get_piece_size())
            if not (m.is_unknown(i) or m.is_control(i) or m.is_byte(i) or m.is_unused(i))]


class PieceCounter:
    def __init__(self, vocabulary: list[tuple[str, float]], byte_fallback: bool = True):
        self.automaton, self.byte_fallback = ahocorasick.Automaton(), byte_fallback
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p, _ in vocabulary if len(p) == 1}
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_COST
        self.by_word = MARK in self.single and not any(MARK in p.lstrip(MARK) for p, _ in vocabulary)
        self.reach = max((len(p) for p, _ in vocabulary), default=1) + 1
        self.seen: dict[str, tuple[int, int, float]] = {}

    def segment(self, text: str) -> tuple[int, int, float]:
        """(tokens, unknown characters, score) of one stretch of marked text.
        Position p lives at p modulo the longest piece, so memory is constant."""
        size, single, unk, fuse = self.reach, self.single, self.unknown, not self.byte_fallback
        best, count, odd, open_run = [None] * size, [0] * size, [0] * size, [False] * size
        best[0], final, n = 0.0, 0, len(text)

        def settle(upto: int):
            # ends final+1..upto have all their pieces: try the unknown step, then free the next slot
            for e in range(final + 1, upto + 1):
                c = text[e - 1]
                if c not in single:
                    a, b = (e - 1) % size, e % size
                    score = best[a] + unk
                    if best[b] is None or score > best[b]:
                        best[b], odd[b], open_run[b] = score, odd[a] + 1, True
                        count[b] = count[a] + ((0 if open_run[a] else 1) if fuse else len(c.encode("utf-8", "replace")))
                best[(e + 1) % size] = None

        best[1 % size] = None
        for end, (length, score) in self.automaton.iter(text):
            e = end + 1
            if e - 1 > final:
                settle(e - 1)
                final = e - 1
            a, b = (e - length) % size, e % size
            score += best[a]
            if best[b] is None or score > best[b]:
                best[b], count[b], odd[b], open_run[b] = score, count[a] + 1, odd[a], False
        settle(n)
        return count[n % size], odd[n % size], best[n % size]

    def count(self, text: str | None) -> tuple[int, int, float]:
        if not text:
            return 0, 0, 0.0
        if not self.by_word:
            return self.segment(MARK + text.replace(" ", MARK))
        if "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
            words = WORDS.findall(MARK + text.replace(" ", MARK))
        else:
            words = [MARK + w for w in text.split(" ")]
        if len(self.seen) > CACHE:
            self.seen = {}
        tokens, unknown, score, seen = 0, 0, 0.0, self.seen
        for w in words:
            found = seen.get(w)
            if found is None:
                found = self.segment(w)
                if len(w) <= CHUNK_CHARS:
                    seen[w] = found
            tokens += found[0]
            unknown += found[1]
            score += found[2]
        return tokens, unknown, score


@lru_cache(2)
def _counter(path: str, byte_fallback: bool) -> PieceCounter:
    return PieceCounter(read_vocabulary(path), byte_fallback)


def count_tokens(docs: DataFrame, vocabulary: str, text_col: str = "text", byte_fallback: bool = True) -> DataFrame:
    """``docs`` with ``n_tokens``, ``n_unknown`` (characters outside the
    vocabulary) and ``best_score``. ``vocabulary`` is the path of a piece file
    on every machine; its pieces and scores are read as a unigram model."""
    ship_code(docs.sparkSession)

    @F.pandas_udf("n_tokens long, n_unknown long, best_score double")
    def count(text: pd.Series) -> pd.DataFrame:
        counter = _counter(vocabulary, byte_fallback)
        return pd.DataFrame([counter.count(t if isinstance(t, str) else None) for t in text],
                            columns=["n_tokens", "n_unknown", "best_score"])

    own = ("n_tokens", "n_unknown", "best_score")
    plain = [c for c in docs.columns if c not in own]
    out = docs.select(*plain).withColumn("__t", count(F.col(text_col)))
    return out.select(*plain, *[f"__t.{c}" for c in own])
