"""Removal of long repeated substrings by bucket-pointer refinement.

A byte goes if it lies in a string of ``width`` bytes that starts at another
place too. Places are dealt into buckets by the bucket of a q-gram and refined
by the buckets of later offsets, as in bucket-pointer suffix sorting; a bucket
with one member is finished and never looked at again. Two properties of the
problem are used. Only the first ``width`` bytes of a suffix matter, so a
bucket identifier can be a number that follows from the bytes it stands for: the
refinement to the next depth - the pair (own bucket, bucket at a later offset) -
needs the identifiers of one text only, and equal bytes meet by sorting on it.
And neighbouring places have nearly the same bytes, so places are kept as runs.

1. Buckets of 8-grams are refined to 16 and 32 bytes through the buckets at
   offsets 8 and 16. Each window of ``width`` bytes joins the smallest bucket
   identifier of the q-grams inside it; windows are equal only if these are.
   Consecutive windows with one identifier are a run (85 windows on average),
   the only thing that is shuffled: bucket, and the bucket of all bytes of the
   run, refined on from 32 bytes to 64, 128 and 256 and to the run's own length
   by the bucket at the offset that is missing (``_refined``).
2. A bucket with one run is finished: no repeat. A bucket whose runs all have
   the same bytes is finished: all its windows repeat.
3. The other buckets are refined. Equal runs are one class with a count. The
   windows of a class are split into parts by their distance to the q-gram,
   the new bucket of a part is that of the bytes that all of its windows
   contain, again the pair of the buckets of lesser depth at its start and at a
   later offset, and step 2 is applied to the parts; what stays open is refined
   again, 158, 190, 198 and 200 bytes deep for a width of 200, down to single
   windows. The bytes of a class, at most a window and a run, are kept in a table
   of their own, so no text is read again and only identifiers are dealt out.

Counts are partial aggregates and verdicts come back through equi-joins, so
copies in any number, or a passage in a third of all documents, cost one row
each and are never gathered or paired. The rows of a bucket or class that holds
more than its share are dealt over many tasks (``_met``).

Defined results: a null text is empty; texts shorter than ``width`` bytes keep
everything; matches never cross documents; each row counts as a document of its
own, also when it repeats an id (rows with equal id and text get the same
answer); a cut inside a multi-byte character keeps its remaining bytes; columns
other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import shared_table, ship_code

Q = 32            # bytes of the q-gram that names a bucket
BLOCK = 1 << 20   # window starts that are laid out at once
SPLIT = 4         # parts into which an open part is split
HOT_KEYS = 512    # a key is hot if it holds over 1 / HOT_KEYS of the rows: fewer than that can be
HOT_PARTS = 64    # tasks that the rows of a hot key are dealt to
K1, K2, K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _refine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The identifier of the pair (own bucket, bucket at a later offset)."""
    r = a * K1
    r ^= r >> np.uint64(29)
    r += b * K2
    r *= K3
    r ^= r >> np.uint64(32)
    return r


def _gram_buckets(buf: np.ndarray) -> np.ndarray:
    """Bucket identifier of the ``Q`` bytes from each place of ``buf``."""
    raw = np.ndarray((len(buf) - 7,), "<u8", buf, strides=(1,)).copy()
    raw = _refine(raw, raw)
    raw = _refine(raw[:-8], raw[8:])
    return _refine(raw[:-16], raw[16:])


def _bucket(grams: np.ndarray, place: np.ndarray, depth: int) -> np.ndarray:
    """Bucket identifiers of the ``depth`` bytes (``Q`` doubled any number of
    times) from each place: the pairs of those of half the depth."""
    if depth == Q:
        return grams[place]
    half = depth // 2
    return _refine(_bucket(grams, place, half), _bucket(grams, place + half, half))


def _refined(grams: np.ndarray, place: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Bucket identifiers of the ``length`` bytes (at least ``Q``) from each
    place: the bucket of the largest depth that fits, refined by the bucket of
    that depth which ends where the bytes end, and by the length."""
    out = np.empty(len(place), np.uint64)
    depth, left = Q, np.arange(len(place))
    while len(left):
        here = left[length[left] < 2 * depth]
        at, size = place[here], length[here]
        out[here] = _refine(_refine(_bucket(grams, at, depth), _bucket(grams, at + size - depth, depth)), size.astype(np.uint64))
        left = left[length[left] >= 2 * depth]
        depth *= 2
    return out


def _sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of each ``n`` consecutive values."""
    step = 1
    while step * 2 <= n:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    return np.minimum(x[:len(x) - (n - step)], x[n - step:]) if n > step else x


def _layout(texts: list[bytes], width: int) -> Iterator[tuple[bytes, np.ndarray]]:
    """Buffers of about ``BLOCK`` window starts with, per stretch of a text in it,
    (text index, start in the text, start in the buffer, number of windows). A
    long text is laid out in stretches that overlap by ``width - 1`` bytes."""
    parts, marks, used = [], [], 0
    for i, text in enumerate(texts):
        for at in range(0, len(text) - width + 1, BLOCK):
            piece = text[at:at + BLOCK + width - 1]
            marks.append((i, at, used, len(piece) - width + 1))
            parts.append(piece)
            used += len(piece)
            if used >= BLOCK:
                yield b"".join(parts), np.array(marks, np.int64)
                parts, marks, used = [], [], 0
    if parts:
        yield b"".join(parts), np.array(marks, np.int64)


def text_runs(texts: list[bytes], width: int) -> Iterator[pd.DataFrame]:
    """The runs of all windows: text index, place of the q-gram, smallest and
    largest distance from a window's start to it, bucket, bucket of all bytes.
    The q-gram of a window is that of the smallest identifier (its upper 40
    bits), the leftmost of equals; both depend on the window's bytes alone."""
    low24 = np.uint64(0xFFFFFF)
    for raw, marks in _layout(texts, width):
        grams = _gram_buckets(np.frombuffer(raw, np.uint8))
        best = _sliding_min((grams & ~low24) | np.arange(len(grams), dtype=np.uint64), width - Q + 1)
        edge = np.zeros(len(best) + 1, bool)
        edge[1:-1] = best[1:] != best[:-1]
        edge[marks[:, 2]] = edge[marks[:, 2] + marks[:, 3]] = True
        cut = np.flatnonzero(edge)
        owner = np.searchsorted(marks[:, 2], cut, side="right") - 1
        ok = np.flatnonzero(cut < marks[owner, 2] + marks[owner, 3])
        begin, end, owner = cut[ok], cut[ok + 1], owner[ok]
        place = (best[begin] & low24).astype(np.int64)
        yield pd.DataFrame({"text": marks[owner, 0], "place": place - marks[owner, 2] + marks[owner, 1],
                            "near": (place - end + 1).astype(np.int32), "far": (place - begin).astype(np.int32),
                            "bucket": grams[place].view(np.int64), "own": _refined(grams, begin, end - begin + width - 1).view(np.int64)})


RUN = "id long, tag long, place int, near int, far int, bucket long, own long"
BYTES = "run_bucket long, run_own long, n long, near int, far int, bytes binary"
PART = "run_bucket long, run_own long, n long, near int, far int, bucket long, own long"


def _spread(width: int) -> list[int]:
    """Distances that one part spans, by level: all, then a quarter each time, down to one."""
    spans = [width - Q + 1]
    while spans[-1] > 1:
        spans.append(-(-spans[-1] // SPLIT))
    return spans


def _met(rows: DataFrame, keyed: DataFrame, on: list[str], size: str) -> DataFrame:
    """``rows`` joined with ``keyed``, a written table whose column ``size`` says
    how many of the rows have the key. The rows of a hot key are dealt by a hash
    of the whole row, and the key's rows of ``keyed`` are repeated for each part."""
    total = keyed.agg(F.sum(size)).first()[0] or 0
    hot = F.col(size) > max(total // HOT_KEYS, HOT_PARTS)
    parts = F.when(hot, F.sequence(F.lit(0), F.lit(HOT_PARTS - 1))).otherwise(F.array(F.lit(0)))
    names = keyed.filter(hot).select(*on).distinct().withColumn("hot", F.lit(True))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64(*rows.columns), F.lit(HOT_PARTS)).cast("int")).otherwise(0)
    dealt = rows.join(F.broadcast(names), on, "left").withColumn("salt", salt).drop("hot")
    return dealt.join(keyed.withColumn("salt", F.explode(parts)).drop(size), [*on, "salt"]).drop("salt")


def _verdicts(rows: DataFrame) -> DataFrame:
    """(bucket, own, m, open, size) of the classes that are not finished as
    unique: m places have these bytes, in ``size`` rows; open: the bucket has
    several classes, one of them with a single member, and has to be refined."""
    classes = shared_table(rows.groupBy("bucket", "own").agg(F.sum("n").alias("m"), F.count("*").alias("size")))
    buckets = shared_table(classes.groupBy("bucket").agg(
        (F.count("*") > 1).alias("mixed"), (F.count_if(F.col("m") == 1) > 0).alias("single"), F.count("*").alias("classes"))
        .filter("mixed OR NOT single"))
    return _met(classes, buckets, ["bucket"], "classes").select(
        "bucket", "own", "m", (F.col("mixed") & F.col("single")).alias("open"), "size")


def repeated_spans(docs: DataFrame, width: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, tag, ranges): per text the byte ranges covered by repeated strings,
    unsorted and overlapping, each as start * 2**32 + end; ``tag`` tells apart
    texts that share an id."""
    if width <= Q:
        raise ValueError(f"width must be over {Q}")
    ship_code(docs.sparkSession)
    body = F.col(text_col).cast("binary")
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(body).alias("tag"), body.alias("body")).filter(
        F.octet_length("body") >= width)

    def runs_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids, tags = pdf["id"].to_numpy(), pdf["tag"].to_numpy()
            for runs in text_runs(pdf["body"].tolist(), width):
                text = runs.pop("text").to_numpy()
                runs.insert(0, "tag", tags[text])
                runs.insert(0, "id", ids[text])
                yield runs

    # a null id becomes the smallest number; such texts are still told apart by their tag
    keyed = slim.withColumn("id", F.coalesce("id", F.lit(NO_ID)))
    runs = keyed.mapInPandas(runs_of, RUN)

    # step 2 on whole runs: a bucket needs its number of runs and whether their bytes differ
    buckets = runs.groupBy("bucket").agg(F.count("*").alias("n"), F.min("own").alias("low"), F.max("own").alias("high"))
    live = shared_table(buckets.filter("n > 1").select("bucket", "n", (F.col("low") < F.col("high")).alias("mixed")))
    found = shared_table(_met(runs, live, ["bucket"], "n"))
    done = found.filter("NOT mixed").select("id", "tag", "place", "near", "far")

    # step 3: classes of the mixed buckets, with the bytes of one member
    classes = shared_table(found.filter("mixed").groupBy("bucket", "own").agg(
        F.count("*").alias("n"), F.first("id").alias("id"), F.first("tag").alias("tag"), F.first("place").alias("place"),
        F.first("near").alias("near"), F.first("far").alias("far")))
    singles = shared_table(classes.groupBy("bucket").agg(F.count_if(F.col("n") == 1).alias("s"), F.count("*").alias("classes"))
                           .filter("s > 0").select("bucket", "classes"))
    opened = _met(classes, singles, ["bucket"], "classes")
    wanted = opened.groupBy("id", "tag").agg(F.collect_list(F.struct("bucket", "own", "n", "place", "near", "far")).alias("w"))

    def bytes_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(w["bucket"], w["own"], w["n"], w["near"], w["far"], body[w["place"] - w["far"]:w["place"] - w["near"] + width])
                    for body, ws in zip(pdf["body"], pdf["w"]) for w in ws]
            yield pd.DataFrame(rows, columns=_names(BYTES))

    member = shared_table(keyed.join(wanted, ["id", "tag"]).select("body", "w").mapInPandas(bytes_of, BYTES)
                          .dropDuplicates(["run_bucket", "run_own"]))
    held = member.select("run_bucket", "run_own", F.col("far").alias("place"), "bytes")
    open_ = member.select("run_bucket", "run_own", "n", "near", "far")
    repeated = classes.filter("n > 1").select(F.col("bucket").alias("run_bucket"), F.col("own").alias("run_own"), "near", "far", "n")
    for span in _spread(width)[1:]:
        parts = shared_table(open_.join(held, ["run_bucket", "run_own"]).mapInPandas(_splitter(span, width), PART))
        judged = shared_table(_met(parts, shared_table(_verdicts(parts)), ["bucket", "own"], "size"))
        repeated = repeated.union(judged.filter("m > 1").select("run_bucket", "run_own", "near", "far", "n"))
        open_ = judged.filter("open").select("run_bucket", "run_own", "n", "near", "far")
    members = found.filter("mixed").select("id", "tag", "place", F.col("bucket").alias("run_bucket"), F.col("own").alias("run_own"))
    hits = _met(members, repeated, ["run_bucket", "run_own"], "n").select("id", "tag", "place", "near", "far")
    # a text has less than 2**31 bytes: a range is packed into one number
    start, end = F.col("place") - F.col("far"), F.col("place") - F.col("near") + width
    packed = F.shiftleft(start.cast("long"), 32) + end
    return shared_table(done.union(hits).groupBy("id", "tag").agg(F.collect_set(packed).alias("ranges")).select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias("id"), "tag", "ranges"))


NO_ID = -(1 << 63)


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def _splitter(span: int, width: int):
    """Cut parts at the multiples of ``span`` distances; the bucket of a part is
    that of the bytes common to all windows at its cell's distances."""
    size = max(BLOCK // (2 * width), 1)  # rows that are laid out at once

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), size):
                rows = pdf.iloc[at:at + size]
                grams = _gram_buckets(np.frombuffer(b"".join(rows["bytes"]), np.uint8))
                begins = rows["bytes"].str.len().cumsum().shift(fill_value=0).to_numpy()
                near, far = rows["near"].to_numpy(np.int64), rows["far"].to_numpy(np.int64)
                cells = far // span - near // span + 1
                row = np.repeat(np.arange(len(rows)), cells)
                cell = np.arange(len(row)) - np.repeat(np.cumsum(cells) - cells, cells) + (near // span)[row]
                low, high = np.maximum(near[row], cell * span), np.minimum(far[row], (cell + 1) * span - 1)
                # the q-gram stands here; the window at distance d starts d before it
                gram = (begins + rows["place"].to_numpy(np.int64))[row]
                core = _refined(grams, gram - cell * span, np.full(len(row), width - span + 1))
                own = _refined(grams, gram - high, width + high - low)
                out = rows[["run_bucket", "run_own", "n"]].iloc[row].reset_index(drop=True)
                yield out.assign(near=low, far=high, bucket=_refine(core, cell.astype(np.uint64)).view(np.int64),
                                 own=_refine(own, low.astype(np.uint64)).view(np.int64))

    return split


def remove_repeats(docs: DataFrame, width: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept): one row per row of ``docs``;
    ``kept`` is binary, the remaining bytes joined."""
    spans = repeated_spans(docs, width, id_col, text_col)

    @F.pandas_udf("n_bytes long, n_removed long, n_spans long, kept binary")
    def cut(body: pd.Series, ranges: pd.Series) -> pd.DataFrame:
        rows = []
        for text, r in zip(body, ranges):
            text = text or b""
            if r is None or not len(r):
                rows.append((len(text), 0, 0, text))
                continue
            r = np.sort(np.asarray(r, np.int64))
            a, reach = r >> 32, np.maximum.accumulate(r & 0xFFFFFFFF)
            new = np.flatnonzero(a[1:] > reach[:-1]) + 1  # a span that touches the one before belongs to it
            first, last = a[np.concatenate([[0], new])], reach[np.concatenate([new - 1, [len(a) - 1]])]
            cuts = zip([0, *last.tolist()], [*first.tolist(), len(text)])
            rows.append((len(text), int((last - first).sum()), len(first), b"".join([text[x:y] for x, y in cuts])))
        return pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept"])

    body = F.col(text_col).cast("binary")
    plain = docs.select(F.col(id_col).alias("__id"), body.alias("__body"), F.xxhash64(body).alias("__tag"))
    met = plain.join(spans, F.col("__id").cast("long").eqNullSafe(F.col("id")) & (F.col("__tag") == F.col("tag")), "left")
    return met.withColumn("__c", cut("__body", "ranges")).select(
        F.col("__id").alias(id_col), "__c.n_bytes", "__c.n_removed", "__c.n_spans", "__c.kept")
