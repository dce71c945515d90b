"""Language-model scoring with an Elias-Fano n-gram trie.

The model is a bigram model over whole texts: words (runs of other than the
six ASCII white-space characters, A-Z lower-cased) and an end. A pair seen in
training has (1 - backoff) * count(pair) / count(context), any other
backoff * base(word), and base(word) alone after an unknown context; base is
the add-one unigram estimate. The probabilities of a context sum to at most 1.
Pair probabilities are quantised to 1/64 of a decade and held in the trie.

Texts are cut into blocks; a block's pairs are combined, sorted by context and
dealt to shards by a hash of the context, as arrays and not as rows, with the
numbers and flags of the texts that occur in them only. So a shard holds the
postings of about ``SHARD_BYTES`` of text however large the corpus is. Its task
counts the training pairs, builds the two-level trie (monotone pointers,
quantised probabilities) in a memory-mapped file and looks up every pair of
the shard: its context's pointers give a range, and the word is searched there. So model and queries meet in
one shuffle. What is broadcast and collected is the list of spread contexts
(below), which grows with the number of shards.

A context that would outgrow a shard (the start of a text, frequent words) is
spread over all shards by its successor. Which contexts these are is counted
over all texts, copies too: each task keeps a summary of its words' counts
(Misra-Gries) of ``SAMPLE`` counters per shard, which is short of a word's
count by at most 1 / (``SAMPLE`` * shards) of all words, so that no frequent
word is missed. Their training counts, needed by every shard, are exact. The
list is bounded by the number of shards.

Pairs not seen in training need base(word), which is counted in the shard of
that word: they are summed by word and text there, joined with the counts and
added up by text.

Defined results: a null text is empty, and an empty one has the end alone;
without training text every count is 0 and base is 1 / 1 (log10 0 for V = 0);
each row is scored, repeated rows alike; rows with a null id are held out of
training only if the given condition says so; other columns are not read.
Words are told apart by 64-bit hashes (successors by 48 bits of them).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import shared_table, ship_code
from affinity.llm.elias_fano import STEP, BigramTrie

SHARD_BYTES = 16 << 20  # of text, per shard
BLOCK_BYTES = 3 << 20   # of text that is combined before it is dealt out
SLICES = 8              # slices of a shard's contexts, taken one after the other
HELD_TEXTS = 1 << 18    # texts of a shard whose sums are held over its slices
SAMPLE = 64             # counters per shard in a task's summary of the words
HOT_SHARE = 2.0         # a context is spread if its share of the words is over HOT_SHARE / shards
START, END = 1, 2       # stand for hashes of words
TOP48 = np.uint64(16)   # a successor is the upper 48 bits of its hash


def words_of(text: bytes) -> list[bytes]:
    """``bytes.lower`` maps A-Z only; ``bytes.split`` splits at x20 and x09-x0D only."""
    return text.lower().split()


def _hash(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_digest
    h = np.frombuffer(b"".join([digest(w) for w in words]), ">u8").astype(np.uint64)
    # keep clear of the stand-ins; START and END differ in their upper 48 bits too
    return np.maximum(h, np.uint64(1 << 40))


MARKS = np.array([START << 20, END << 20], np.uint64)


def _pairs(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """The distinct (context, word, text) of a block with counts: hash of the
    context, hash of the word, index of the text, count, words per text."""
    number = count()
    ids: dict[bytes, int] = {}
    seqs, sizes = [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        own = words_of(text)
        sizes[i] = len(own)
        for w in own:
            if w not in ids:
                ids[w] = next(number) + 2
        seqs.append(np.fromiter(map(ids.__getitem__, own), np.int64, len(own)))
    hashes = np.concatenate([MARKS, _hash(list(ids))])
    one = np.ones(1, np.int64)
    context = np.concatenate([x for s in seqs for x in (0 * one, s)] or [one[:0]])
    word = np.concatenate([x for s in seqs for x in (s, one)] or [one[:0]])
    text = np.repeat(np.arange(len(texts)), sizes + 1)
    n, m = len(hashes), max(len(texts), 1)
    key, k = np.unique((context * n + word) * m + text, return_counts=True)
    pair = key // m
    return hashes[pair // n], hashes[pair % n], key % m, k, sizes


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        size = pdf["body"].str.len().fillna(0).to_numpy().cumsum()
        for _, part in pdf.groupby((size // BLOCK_BYTES).astype(np.int64), sort=True):
            yield part


DEALT = "shard int, row long, texts binary, trained binary, context binary, posts binary, word binary, text binary, k binary"
SCORED = "kind int, row long, word long, n long, known long, base double, seen long, extra long"
SUMMED = ("n", "known", "base", "seen", "extra")
IDENTITY, SUMS, UNSEEN, COUNT = range(4)  # kinds of rows of the second schema


def _dealer(shards: int, spread: np.ndarray):
    """Blocks of texts to rows of arrays: one row for each block and shard, and one
    per text that carries its id."""

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        row = TaskContext.get().partitionId() << 36
        for part in _blocks(batches):
            texts = [b if isinstance(b, bytes) else b"" for b in part["body"]]
            trained = part["trained"].to_numpy().astype(np.uint8)
            context, word, text, k, _ = _pairs(texts)
            hot = np.isin(context, spread)
            shard = (np.where(hot, context ^ (word >> TOP48) * np.uint64(0x9E3779B97F4A7C15), context) % np.uint64(shards)).astype(np.int64)
            order = np.lexsort((text, word, context, shard))
            context, word, text, k, shard = (x[order] for x in (context, word, text, k, shard))
            cuts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else np.empty(0, np.int64)
            out = []
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(shard)]):
                new = np.flatnonzero(np.append(True, context[a + 1:b] != context[a:b - 1]))
                met, local = np.unique(text[a:b], return_inverse=True)
                out.append((int(shard[a]), row, met.astype("<u4").tobytes(), trained[met].tobytes(), context[a:b][new].tobytes(),
                            np.diff(np.append(new, b - a)).astype("<u4").tobytes(), _six(word[a:b] >> TOP48),
                            local.astype("<u2").tobytes() if len(met) < 65536 else local.astype("<u4").tobytes(),
                            k[a:b].astype("<u1").tobytes() if k[a:b].max() < 256 else k[a:b].astype("<u4").tobytes()))
            ids = part["id"].to_numpy()
            out.append((int(row % shards), row, None, trained.tobytes(), None, ids.astype("<i8").tobytes(), None, None, None))
            row += len(texts)
            yield pd.DataFrame(out, columns=[f.split()[0] for f in DEALT.split(", ")])

    return deal


def _six(x: np.ndarray) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel().astype(np.uint64)


def _sized(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, {1: "<u1", 2: "<u2", 4: "<u4"}[len(raw) // max(n, 1)]).astype(np.int64)


def _frame(kind: int, size: int, **cols) -> pd.DataFrame:
    names = [f.split()[0] for f in SCORED.split(", ")]
    return pd.DataFrame({c: cols.get(c, kind if c == "kind" else np.zeros(size)) for c in names})


def _slice(rows: list[tuple], low: int, high: int) -> tuple[np.ndarray, ...]:
    """Postings of the contexts from ``low`` to below ``high``: context, word,
    text (as an index over the texts of the rows), count, learned from."""
    parts, at = [], 0
    for _, _, flags, context, posts, word, text, k in rows:
        ctx, n = np.frombuffer(context, np.uint64), np.frombuffer(posts, "<u4")
        i = np.searchsorted(ctx, np.uint64(low))
        j = np.searchsorted(ctx, np.uint64(high - 1), side="right")
        reach = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
        a, b = int(reach[i]), int(reach[j])
        size = len(word) // 6
        t = _sized(text, size)[a:b]
        parts.append((np.repeat(ctx[i:j], n[i:j]), _from_six(word[6 * a:6 * b]), (t + at).astype(np.int32),
                      _sized(k, size)[a:b].astype(np.int32), np.frombuffer(flags, np.uint8)[t].astype(bool)))
        at += len(flags)
    return tuple(np.concatenate(x) for x in zip(*parts))


def _score_shard(rows: list[tuple], hot: dict[int, int], backoff: float) -> Iterator[pd.DataFrame]:
    """Tries, look-ups and counts of one shard, a slice of its contexts at a time."""
    ids = np.concatenate([row + np.frombuffer(texts, "<u4").astype(np.int64) for row, texts, *_ in rows])
    few = len(ids) <= HELD_TEXTS  # else each slice has its own sums
    sums = {c: np.zeros(len(ids)) for c in SUMMED} if few else {}
    cuts = [(i << 64) // SLICES for i in range(SLICES + 1)]
    hot_names = np.fromiter(hot, np.uint64, len(hot))
    for low, high in zip(cuts, cuts[1:]):
        context, word, text, k, learned = _slice(rows, low, high)
        if not len(context):
            continue
        order = np.lexsort((word, context))
        context, word, text, k, learned = context[order], word[order], text[order], k[order], learned[order]
        new = np.append(True, (context[1:] != context[:-1]) | (word[1:] != word[:-1]))
        pair = np.cumsum(new, dtype=np.int32) - 1
        pair_context, pair_word = context[new], word[new]
        del order, context, word
        first = np.append(True, pair_context[1:] != pair_context[:-1])
        group = np.cumsum(first, dtype=np.int32) - 1
        n_pair = np.bincount(pair, k * learned, len(pair_context)).astype(np.int64)
        del learned
        n_context = np.bincount(group, n_pair, int(first.sum())).astype(np.int64)
        names = pair_context[first]
        spread = np.isin(names, hot_names)
        for i in np.flatnonzero(spread):
            n_context[i] = hot[int(names[i])]
        has = n_pair > 0
        trie = BigramTrie.mapped(pair_context[has], pair_word[has],
                                 np.log10((1 - backoff) * n_pair[has] / n_context[group[has]]))
        code = trie.lookup(pair_context, pair_word)

        # by text: the words themselves (a context is a word of its text), and the pairs
        c, is_word = n_context[group], pair_context != MARKS[0]
        by_pair = {"n": np.ones(len(code)), "known": is_word & (c > 0), "base": is_word * np.log10(c + 1.0),
                   "seen": np.where(code >= 0, code, 0), "extra": (code < 0) & (c > 0)}
        if few:
            for name, value in by_pair.items():
                sums[name] += np.bincount(text, k * value[pair], len(ids))
        else:
            met, local = np.unique(text, return_inverse=True)
            yield _frame(SUMS, len(met), row=ids[met], **{c: np.bincount(local, k * v[pair], len(met)) for c, v in by_pair.items()})
        lost = np.flatnonzero(code[pair] < 0)
        if len(lost):
            yield _frame(UNSEEN, len(lost), row=ids[text[lost]], word=pair_word[pair[lost]].view(np.int64), n=k[lost])
        own = (names != MARKS[0]) & ~spread & (n_context > 0)
        yield _frame(COUNT, int(own.sum()), word=(names[own] >> TOP48).view(np.int64), n=n_context[own])
    if few:
        met = np.flatnonzero(sums["n"])
        yield _frame(SUMS, len(met), row=ids[met], **{c: x[met] for c, x in sums.items()})


def _scorer(hot: dict[int, int], backoff: float):
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rows = None, []
        for pdf in batches:
            for shard, row, texts, flags, context, posts, word, text, k in pdf.itertuples(index=False, name=None):
                if shard != held:
                    if rows:
                        yield from _score_shard(rows, hot, backoff)
                    held, rows = shard, []
                if context is None:
                    ids = np.frombuffer(posts, "<i8")
                    yield _frame(IDENTITY, len(ids), row=row + np.arange(len(ids)), word=ids, known=np.frombuffer(flags, np.uint8))
                else:
                    rows.append((row, texts, flags, context, posts, word, text, k))
        if rows:
            yield from _score_shard(rows, hot, backoff)

    return score


def _trimmed(c: Counter, held: int) -> Counter:
    """The counts less the one of rank ``held`` + 1: at most ``held`` are left,
    each short by at most 1 / (held + 1) of all that was counted."""
    if len(c) <= held:
        return c
    least = int(-np.partition(-np.fromiter(c.values(), np.int64, len(c)), held)[held])
    return Counter({w: n - least for w, n in c.items() if n > least})


def _hot_words(slim: DataFrame, shards: int) -> dict[int, int]:
    """Hash and training count of the contexts that are spread over all shards:
    the start of a text, and words whose share in the sample is over the bound."""

    held = SAMPLE * shards

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c: Counter = Counter()
        total = 0
        for part in _blocks(batches):
            for b in part["body"]:
                if isinstance(b, bytes):
                    own = words_of(b)
                    c.update(own)
                    total += len(own)
            c = _trimmed(c, held)
        yield pd.DataFrame({"word": [b"", *c], "n": [total, *c.values()]}).astype({"n": "int64"})

    # a word is never empty: the empty one stands for the number of all words
    n = slim.select("body").mapInPandas(summed, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    n = shared_table(n)
    total = n.filter("word = X''").agg(F.sum("n")).first()[0] or 0
    names = [bytes(r["word"]) for r in n.filter("word != X''").filter((F.col("n") + total / held) * shards > HOT_SHARE * total).select("word").collect()]
    table = set(names)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c: Counter = Counter()
        for pdf in batches:
            for b in pdf["body"]:
                c.update(w for w in words_of(b or b"") if w in table)
                c[b""] += 1  # the start, and the end, of a text
        yield pd.DataFrame({"word": list(c), "n": list(c.values())}).astype({"n": "int64"})

    exact = slim.filter("trained").select("body").mapInPandas(counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {bytes(r["word"]): r["n"] for r in exact.collect()}
    out = {int(h): found.get(w, 0) for h, w in zip(_hash(names), names)}
    out[int(MARKS[0])] = found.get(b"", 0)
    return out


def score_texts(docs: DataFrame, train: Column | None = None, backoff: float = 0.4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_tokens, n_known, train_tokens,
    base_score and score (log10). ``train``: condition of the rows to learn
    from (default: all)."""
    ship_code(docs.sparkSession)
    learn = F.lit(True) if train is None else F.coalesce(train, F.lit(False))
    slim = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text_col).cast("binary").alias("body"),
                       learn.alias("trained"))
    size = slim.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    hot = _hot_words(slim, shards)
    n_train = hot[int(MARKS[0])]
    dealt = slim.mapInPandas(_dealer(shards, np.fromiter(hot, np.uint64, len(hot))), DEALT)
    dealt = dealt.repartitionById(int(shards), F.col("shard")).sortWithinPartitions("shard")  # a shard is a task
    out = shared_table(dealt.mapInPandas(_scorer(hot, backoff), SCORED))

    spark = docs.sparkSession
    named = [(w >> 16, n) for w, n in hot.items() if n and w != int(MARKS[0])] + ([(int(MARKS[1]) >> 16, n_train)] if n_train else [])
    fixed = spark.createDataFrame([(w, n) for w, n in named], "word long, n long")
    counts = out.filter(F.col("kind") == COUNT).select("word", "n").union(fixed)
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    shift = float(np.log10(total + distinct + 1))

    lost = out.filter(F.col("kind") == UNSEEN).groupBy("word", "row").agg(F.sum("n").alias("u"))
    fallback = lost.join(counts, "word", "left").select("row", (F.col("u") * F.log10(F.coalesce("n", F.lit(0)) + 1.0)).alias("base_lost"),
                                                        F.col("u"))
    fallback = fallback.groupBy("row").agg(F.sum("base_lost").alias("base_lost"), F.sum("u").alias("u"))
    sums = out.filter(F.col("kind") == SUMS).groupBy("row").agg(*[F.sum(c).alias(c) for c in ("n", "known", "base", "seen", "extra")])
    rows = out.filter(F.col("kind") == IDENTITY).select("row", F.col("word").alias("id"))
    end_known, end_base = int(n_train > 0), float(np.log10(n_train + 1))
    both = rows.join(sums, "row").join(fallback, "row", "left")
    return both.select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias(id_col), F.col("n").alias("n_tokens"),
        (F.col("known") + end_known).alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + end_base - F.col("n") * shift).alias("base_score"),
        (-F.col("seen") / float(STEP) + F.col("extra") * float(np.log10(backoff)) + F.coalesce("base_lost", F.lit(0.0))
         - F.coalesce("u", F.lit(0)) * shift).alias("score"))


NO_ID = -(1 << 63)
