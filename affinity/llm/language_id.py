"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built. A text is
parsed against an automaton into the fewest phrases that each occur in the
labelled text (greedy longest matches; a symbol the language never shows is a
phrase of its own). The number of phrases times log2 of the size of the
language's sample, over the number of symbols, estimates the cross-entropy;
the language with the smallest estimate wins, ties by name.

Symbols are lower-cased letters; every run of other characters is one space.
The labelled sample is bounded by two parameters, ``docs_per_lang`` and
``chars_per_doc``: per language and hash bucket of the id, a stretch of the
document with the smallest id hash, at a hashed place of its text. Its size depends on the number of languages only, so it
is bounded: the automata are built once, on the driver, and broadcast, as
tables of all (state, symbol) where these are small and else as hash tables of
their edges (at most three per symbol of the sample, whatever the alphabet). Everything that is classified is parsed whole: texts are laid out
in lanes of ``LANE`` symbols and all lanes of a batch advance together, one
look-up per symbol and language. A lane is first parsed as if a phrase began
with it; then lanes are parsed again from the state in which the lane before
ended, up to the place where both parses agree, which is mostly near. Where
they do not agree within a lane, the text goes on symbol by symbol. So the
phrases are those of the text parsed in one go.

Defined results: ``und`` with score 0 if a text is null or has no letter, or
if nothing could be learned; a label whose sample has no letter is not
learned; rows with a null id are classified but never learned from; repeated
rows are classified alike; other columns pass through, ``lang_pred`` and
``score`` are replaced if present.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import ship_code

LANE = 1024     # symbols of a lane
BATCH = 1 << 22  # symbols parsed at once, or one text
FEW = 24        # so few lanes are parsed one by one
TABLE_BYTES = 32 << 20  # a language's table of all (state, symbol) may be so large
SPACE, UNKNOWN = 1, 2  # codes of the two symbols every alphabet has; 0 pads


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)


def _fold(text: str, table: np.ndarray) -> np.ndarray:
    """Symbol codes of a text, a run of non-letters as one space, none at the ends."""
    parts, last = [], SPACE
    for a in range(0, len(text), BATCH):
        codes = table[_points(text[a:a + BATCH])]
        before = np.concatenate([np.array([last], codes.dtype), codes[:-1]])
        parts.append(codes[(codes != SPACE) | (before != SPACE)])
        last = codes[-1]
    codes = np.concatenate(parts) if parts else np.empty(0, table.dtype)
    return codes[:-1] if len(codes) and codes[-1] == SPACE else codes


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of ``codes``; state 0 is the start."""
    go, link, length, last = [{}], [-1], [0], 0
    for c in codes:
        cur = len(go)
        go.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in go[p]:
            go[p][c] = cur
            p = link[p]
        if p != -1:
            q = go[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(go)
                go.append(dict(go[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and go[p].get(c) == q:
                    go[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return go


class Table:
    """An automaton's transitions for every (state, symbol): the next state, as
    the offset of its row, and the phrases closed on the way, in one number."""

    def __init__(self, go: list[dict[int, int]], width: int):
        step = np.full((len(go), width), -1, np.int32)
        for s, out in enumerate(go):
            if out:
                step[s, list(out)] = list(out.values())
        opened, miss = np.maximum(step[0], 0), step < 0
        closed = miss.astype(np.int8) + (miss & (opened == 0))
        closed[0] = opened == 0  # at the start no phrase is open
        self.cells = (np.where(miss, opened, step) * (width * 4) + closed).astype(np.int32).ravel()

    def step(self, at: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(next state, phrases closed): a symbol that does not go on closes the
        open phrase and opens the next one, or, unseen, is one itself."""
        cells = self.cells[at + symbols]
        return cells >> 2, cells & 3

    def one_by_one(self, symbols: list[int], true: int, guess: int) -> tuple[int, int | None]:
        """Parse from two states at once until they agree: (phrases that the
        first closes beyond the second, its state at the end or None if they met)."""
        more, cells = 0, self.cells
        for c in symbols:
            a, b = int(cells[true + c]), int(cells[guess + c])
            true, guess = a >> 2, b >> 2
            more += (a & 3) - (b & 3)
            if true == guess:
                return more, None
        return more, true

    @property
    def nbytes(self) -> int:
        return self.cells.nbytes


class Edges:
    """The same as an open-addressing table of the edges, some 20 bytes each."""

    EMPTY = -1

    def __init__(self, go: list[dict[int, int]], width: int):
        self.width = width
        keys = np.fromiter((s * width + c for s, out in enumerate(go) for c in out), np.int64)
        ends = np.fromiter((t for out in go for t in out.values()), np.int64)
        self.bits = max(4, int(len(keys) * 1.6).bit_length())
        self.keys = np.full(1 << self.bits, self.EMPTY, np.int64)
        self.ends = np.zeros(1 << self.bits, np.int32)
        slot = self._slot(keys)
        while len(keys):  # one key at a time takes an empty slot, the others move on
            place, first = np.unique(slot, return_index=True)
            first = first[self.keys[place] == self.EMPTY]
            self.keys[slot[first]], self.ends[slot[first]] = keys[first], ends[first]
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, ends, slot = keys[rest], ends[rest], (slot[rest] + 1) & (len(self.keys) - 1)
        self.start = np.zeros(width, np.int32)  # where a phrase that opens with the symbol stands; 0: unseen
        self.start[list(go[0])] = list(go[0].values())

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def step(self, at: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = at.astype(np.int64) * self.width + symbols
        slot = self._slot(keys)
        found = self.keys[slot]
        more = np.flatnonzero((found != keys) & (found != self.EMPTY))
        while len(more):
            slot[more] = (slot[more] + 1) & (len(self.keys) - 1)
            found[more] = self.keys[slot[more]]
            more = more[(found[more] != keys[more]) & (found[more] != self.EMPTY)]
        miss = found != keys
        opened = self.start[symbols]
        closed = (miss & (at != 0)).astype(np.int64) + (miss & (opened == 0))
        return np.where(miss, opened, self.ends[slot]), closed

    def one_by_one(self, symbols: list[int], true: int, guess: int) -> tuple[int, int | None]:
        if not hasattr(self, "table"):
            some = self.keys != self.EMPTY
            self.table = dict(zip(self.keys[some].tolist(), self.ends[some].tolist()))
        more, start = 0, self.start
        for c in symbols:
            to = self.table.get(true * self.width + c)
            if to is None:
                to = int(start[c])
                more += (true != 0) + (to == 0)
            true = to
            to = self.table.get(guess * self.width + c)
            if to is None:
                to = int(start[c])
                more -= (guess != 0) + (to == 0)
            guess = to
            if true == guess:
                return more, None
        return more, true

    @property
    def nbytes(self) -> int:
        return self.keys.nbytes + self.ends.nbytes + self.start.nbytes


class Lanes:
    """Stretches of texts side by side, longest first: ``codes`` (symbol, lane),
    the lane before in the same text (-1 for a first one) and its text."""

    def __init__(self, stretches: list[tuple[int, np.ndarray]]):
        """(text, codes) in the order of the texts and within them."""
        order = sorted(range(len(stretches)), key=lambda i: -len(stretches[i][1]))
        where = {i: k for k, i in enumerate(order)}
        self.number = np.array(order)
        self.owner = np.array([stretches[i][0] for i in order])
        self.before = np.array([where[i - 1] if i and stretches[i - 1][0] == stretches[i][0] else -1 for i in order])
        self.last = np.ones(len(order), bool)
        self.last[self.before[self.before >= 0]] = False
        self.size = np.array([len(stretches[i][1]) for i in order])
        by_lane = np.zeros((len(order), int(self.size.max())), stretches[0][1].dtype)
        for k, i in enumerate(order):
            by_lane[k, :self.size[k]] = stretches[i][1]
        self.codes = np.ascontiguousarray(by_lane.T)

    def phrases(self, edges: Edges, n: int) -> np.ndarray:
        """Phrases of each of n texts."""
        lanes = len(self.size)
        end, closed = np.zeros(lanes, np.int32), np.zeros(lanes, np.int32)
        active = np.searchsorted(-self.size, -np.arange(len(self.codes)), "left")  # lanes longer than r
        for r, m in enumerate(active):
            end[:m], more = edges.step(end[:m], self.codes[r, :m])
            closed[:m] += more
        true_end = end.copy()
        live = np.flatnonzero(self.before >= 0)
        true, guess = end[self.before[live]], np.zeros(len(live), np.int32)
        open_before = true != 0  # after a closed phrase both parses are one
        live, true, guess = live[open_before], true[open_before], guess[open_before]
        apart: dict[int, int] = {}
        extra = np.zeros(lanes, np.int64)
        for r in range(len(self.codes)):
            ended = self.size[live] <= r
            apart.update(zip(live[ended].tolist(), true[ended].tolist()))
            live, true, guess = live[~ended], true[~ended], guess[~ended]
            if len(live) < FEW:
                for lane, a, b in zip(live.tolist(), true.tolist(), guess.tolist()):
                    more, state = edges.one_by_one(self.codes[r:self.size[lane], lane].tolist(), a, b)
                    extra[lane] += more
                    if state is not None:
                        apart[lane] = state
                live = live[:0]
                break
            symbols = self.codes[r, live]
            true, a = edges.step(true, symbols)
            guess, b = edges.step(guess, symbols)
            extra[live] += a - b
            differ = true != guess
            live, true, guess = live[differ], true[differ], guess[differ]
        apart.update(zip(live.tolist(), true.tolist()))  # as long as the longest lane
        if apart:
            self._go_on(edges, apart, end, true_end, extra)
        closed += extra + (self.last & (true_end != 0))
        return np.bincount(self.owner, closed, n)

    def _go_on(self, edges: Edges, apart: dict[int, int], end: np.ndarray, true_end: np.ndarray, extra: np.ndarray) -> None:
        """Lanes whose parses did not meet: the lane after one starts in another state than was assumed."""
        after = {int(b): k for k, b in enumerate(self.before) if b >= 0}
        done = set()
        for lane in sorted(apart, key=self.number.__getitem__):  # in the order of the texts
            if lane in done:
                continue
            state = apart[lane]
            while True:
                true_end[lane] = state
                done.add(lane)
                following = after.get(lane)
                if following is None:
                    break
                if state == end[lane]:  # as was assumed
                    if following not in apart:
                        break
                    state = apart[following]
                else:
                    extra[following], met = edges.one_by_one(self.codes[:self.size[following], following].tolist(), state, 0)
                    state = int(end[following]) if met is None else met
                    done.add(following)  # what was found from the assumed state no longer counts
                    if met is None and after.get(following) not in apart:
                        break
                lane = following


class CrossParser:
    """The automata of all languages."""

    def __init__(self, sample: tuple[tuple[str, str], ...]):
        letters = _letters()
        texts = [(lang, _points(text)) for lang, text in sample]
        seen = np.unique(np.concatenate([t for _, t in texts] or [np.empty(0, np.uint32)]))
        seen = seen[letters[seen]]
        self.table = np.where(letters, UNKNOWN, SPACE).astype(np.uint16 if len(seen) < 65_000 else np.uint32)
        self.table[seen] = np.arange(3, 3 + len(seen))
        self.langs, self.parsers, self.weights = [], [], []
        for lang, text in sample:
            codes = _fold(text, self.table)
            if len(codes):
                self.langs.append(lang)
                go, width = suffix_automaton(codes.tolist()), 3 + len(seen)
                self.parsers.append((Table if len(go) * width * 4 <= TABLE_BYTES else Edges)(go, width))
                self.weights.append(np.log2(len(codes) + 1))

    def costs(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(estimate per text and language, number of symbols per text)."""
        phrases, sizes = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), np.int64)
        held, stretches = 0, []

        def flush():
            nonlocal held, stretches
            if stretches:
                lanes = Lanes(stretches)
                for k, edges in enumerate(self.parsers):
                    phrases[:, k] += lanes.phrases(edges, len(texts))
            held, stretches = 0, []

        for i, text in enumerate(texts):
            codes = _fold(text or "", self.table)
            sizes[i] = len(codes)
            stretches += [(i, codes[b:b + LANE]) for b in range(0, len(codes), LANE)]
            held += len(codes)
            if held >= BATCH:  # whole texts: a phrase may go on in the next lane
                flush()
        flush()
        return phrases * np.array(self.weights)[None, :] / np.maximum(sizes, 1)[:, None], sizes

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score: the share of the second-best estimate by which
        the best one is smaller (1 if only one language is known)."""
        cost, sizes = self.costs(texts)
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts))
        best = cost.argmin(axis=1)
        if len(self.langs) > 1:
            two = np.partition(cost, 1, axis=1)[:, :2]
            score = np.where(two[:, 1] > 0, 1 - two[:, 0] / np.where(two[:, 1] > 0, two[:, 1], 1), 0)
        else:
            score = np.ones(len(texts))
        return ([self.langs[b] if n else "und" for b, n in zip(best, sizes)],
                np.clip(np.where(sizes > 0, score, 0), 0, 1))


def _stretch(body: str, h: str, chars: int) -> Column:
    """``chars`` characters from a hashed place of the whole text."""
    places = F.greatest(F.char_length(body) - F.lit(chars), F.lit(0)) + 1
    return F.substr(F.col(body), (F.pmod(F.xxhash64(h), places) + 1).cast("int"), F.lit(chars))


def labelled_sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    docs_per_lang: int = 256, chars_per_doc: int = 256) -> tuple[tuple[str, str], ...]:
    """(language, text) pairs, at most ``docs_per_lang * chars_per_doc``
    characters each: per language and id-hash bucket the smallest id hash, and
    of its text a stretch at a place hashed from the id, so that a header which
    many texts share is not all that is learned. The
    first pass moves two numbers per bucket; the second finds those documents."""
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(lang_col).alias("lang"),
                       F.col(text_col).alias("body")).filter("id IS NOT NULL AND lang IS NOT NULL AND body IS NOT NULL")
    rows = rows.withColumn("h", F.xxhash64("id"))
    picked = rows.groupBy("lang", F.pmod("h", F.lit(docs_per_lang)).alias("bucket")).agg(F.min("h").alias("h"))
    # rows of one hash (repeated ids): the smallest text, so the sample never depends on their order
    text = rows.join(F.broadcast(picked.select("lang", "h")), ["lang", "h"]).groupBy("lang", "h").agg(
        F.min(_stretch("body", "h", chars_per_doc)).alias("body"))
    by_lang: dict[str, list[str]] = {}
    for r in text.orderBy("lang", "h").collect():  # bounded by languages * docs_per_lang
        by_lang.setdefault(r["lang"], []).append(r["body"])
    return tuple((lang, "\n".join(parts)) for lang, parts in sorted(by_lang.items()))


def identify(docs: DataFrame, learn: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", docs_per_lang: int = 256, chars_per_doc: int = 256) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1). Labels are read from
    the rows where ``learn`` holds (default: all) and the label is not null."""
    ship_code(docs.sparkSession)
    sample = labelled_sample(docs if learn is None else docs.filter(learn), id_col, text_col, lang_col,
                             docs_per_lang, chars_per_doc)

    shared = docs.sparkSession.sparkContext.broadcast(CrossParser(sample))  # some MB per language, see Edges

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        parser = shared.value
        for text in texts:
            lang, score = parser.predict([t if isinstance(t, str) else None for t in text])
            yield pd.DataFrame({"lang_pred": lang, "score": score})

    plain = [c for c in docs.columns if c not in ("lang_pred", "score")]
    out = docs.select(*plain).withColumn("__p", predict(F.col(text_col)))
    return out.select(*plain, "__p.lang_pred", "__p.score")
