"""Best-fit packing of token sequences into bins of a fixed capacity.

Bounded-space online best fit: a fixed number of bins stays open, in a bitset
keyed by free space. A piece goes to the open bin it fills best; if none has
room a new one opens, and beyond the limit the fullest closes. The state is at
most ``open_bins`` numbers, so memory does not grow with the input.

Texts are cut at the white space after which the tokenizer always starts
anew, and the ids of such chunks are remembered in a bounded cache.

Tasks pack their own pieces, longest first within a batch, and close all bins
but those that are far from full. The pieces of the bins left open move to
fewer, larger tasks and are packed again; only they are shuffled, as numbers
without ids.

Defined results: a null or empty text is the separator alone; every row is
packed, repeated ones too; pieces of one document are numbered from 0; extra
columns are not read. Sequence ids are any numbers, each used once.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import shared_table, ship_code

CACHE = 400_000      # chunks a Python worker remembers at most, beyond those of one group
CHUNK_CHARS = 64     # longer chunks are not remembered
GROUP_CHARS = 2 << 20
# Fixed value: the pre-tokens of the public byte-level vocabulary.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Chunks that the rank table may encode: short, of characters whose class no Unicode version changes.
PLAIN_CHUNK = re.compile(f"[\n -~\u00a1-\u024f]{{1,{CHUNK_CHARS}}}")
ODD_BLANK = re.compile(r"\s ")  # a space after white space does not always start a token


@lru_cache(2)
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(2)
def _rank_encoder(path: str):
    """The same byte-level vocabulary as a table of merge ranks, which encodes short chunks faster."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class ChunkEncoder:
    """Token ids of whole texts. The byte-level pre-tokenizer never joins a
    non-blank with the space after it, so the chunks between such spaces have
    the ids they have in the text. Ids are kept as packed 32-bit numbers."""

    def __init__(self, path: str, ranks: str | None = None):
        self.tokenizer, self.seen = _tokenizer(path), {}
        self.quick = _rank_encoder(ranks) if ranks else None
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _encode(self, texts: list[str]) -> Iterator[bytes]:
        for at in range(0, len(texts), 4096):
            for e in self.tokenizer.encode_batch_fast(texts[at:at + 4096], add_special_tokens=False):
                yield array("I", e.ids).tobytes()

    def _learn(self, chunks: list[str]) -> None:
        if self.quick:
            encode, plain = self.quick, PLAIN_CHUNK.fullmatch
            quick = [c for c in chunks if plain(c)]
            self.seen.update((c, array("I", encode(c)).tobytes()) for c in quick)
            chunks = [c for c in chunks if c not in self.seen]
        self.seen.update(zip(chunks, self._encode(chunks)))

    def batch(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text; chunks are looked up for ``GROUP_CHARS`` of text at a time."""
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= GROUP_CHARS:
                yield from self._group(held)
                held, size = [], 0
        yield from self._group(held)

    def _group(self, texts: list[str]) -> Iterator[np.ndarray]:
        seen, parts = self.seen, []
        for text in texts:
            if ODD_BLANK.search(text) or any(s in text for s in self.special):
                parts.append(None)
                continue
            first, *rest = text.split(" ")
            parts.append([first, *[" " + x for x in rest]] if first else [" " + x for x in rest])
        new = list({c for p in parts if p for c in p if c not in seen})
        self._learn(new)
        for text, p in zip(texts, parts):
            yield np.frombuffer(b"".join(map(seen.__getitem__, p)) if p is not None else next(self._encode([text])), "<u4")
        for c in new:
            if len(c) > CHUNK_CHARS:
                del seen[c]
        if len(seen) > CACHE:
            seen.clear()


class OpenBins:
    """At most ``limit`` bins with room, found by free space through a bitset."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit, self.count, self.bits = capacity, limit, 0, 0
        self.by_free: dict[int, list[list]] = {}

    def _take(self, free: int) -> list:
        stack = self.by_free[free]
        found = stack.pop()
        self.count -= 1
        if not stack:
            self.bits &= ~(1 << free)
        return found

    def put(self, item, size: int) -> Iterator[list]:
        """Place one item; yields the bins (lists of items) that close."""
        fits = self.bits >> size
        free = size + (fits & -fits).bit_length() - 1 if fits else self.capacity
        held = self._take(free) if fits else []
        held.append(item)
        free -= size
        if free == 0:
            yield held
            return
        self.by_free.setdefault(free, []).append(held)
        self.bits |= 1 << free
        self.count += 1
        if self.count > self.limit:  # the fullest closes
            yield self._take((self.bits & -self.bits).bit_length() - 1)

    def rest(self) -> Iterator[list]:
        while self.count:
            yield self._take((self.bits & -self.bits).bit_length() - 1)


FIELDS = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = FIELDS + ", sequence_id long, offset long, settled boolean"
LEFT_PER_TASK = 100_000  # pieces of open bins that one task of the second round packs


def _placed(bins: list[list], first: int, settled: bool) -> pd.DataFrame:
    rows = []
    for n, items in enumerate(bins):
        at = 0
        for item in items:
            rows.append((*item, first + n, at, settled))
            at += item[3]
    return pd.DataFrame(rows, columns=[f.split()[0] for f in PLACED.split(", ")])


def _round(batches: Iterator[pd.DataFrame], pieces_of, capacity: int, open_bins: int, mark: int,
           last: bool) -> Iterator[pd.DataFrame]:
    """Pack each batch's pieces, longest first; ids are unique by task."""
    bins, number = OpenBins(capacity, open_bins), mark + (TaskContext.get().partitionId() << 36)
    for pdf in batches:
        closed = []
        for item in sorted(pieces_of(pdf), key=lambda x: (-x[3], x[0], x[1])):
            closed.extend(bins.put(item, item[3]))
        yield _placed(closed, number, True)
        number += len(closed)
    left = list(bins.rest())
    yield _placed(left, number, last)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, separator: int = 0, open_bins: int = 1024,
         ranks: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset. A document is its token ids, then ``separator``; one longer than
    ``capacity`` is cut into pieces of that size, of which the first may be
    shorter. ``tokenizer`` is the path of a tokenizer file on every machine;
    ``ranks``, if given, that of the same vocabulary as merge ranks, used for
    the short chunks for which both agree by construction.
    """

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = ChunkEncoder(tokenizer, ranks)

        def pieces_of(pdf: pd.DataFrame):
            texts = [t if isinstance(t, str) else "" for t in pdf["body"]]
            for doc, ids in zip(pdf["id"], encoder.batch(texts)):
                ids = np.append(ids, np.uint32(separator)).astype("<u4")
                short = len(ids) % capacity
                cuts = [0, *range(short or capacity, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    yield (doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes()))

        yield from _round(batches, pieces_of, capacity, open_bins, 0, False)

    def again(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _round(batches, lambda pdf: pdf.itertuples(index=False, name=None), capacity, open_bins, 1 << 62, True)

    ship_code(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("body"))
    once = shared_table(slim.mapInPandas(first, PLACED))
    left = once.filter("NOT settled").select(*[f.split()[0] for f in FIELDS.split(", ")])
    tasks = max(1, -(-left.count() // LEFT_PER_TASK))
    dealt = left.repartition(tasks, "doc_id", "piece").sortWithinPartitions(F.desc("length"), "doc_id", "piece")
    return once.filter("settled").union(dealt.mapInPandas(again, PLACED)).drop("settled")
