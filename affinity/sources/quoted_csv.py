"""Records of quoted CSV files, read in ranges.

A line break inside quotes does not end a record, so where a range of a file
starts does not say whether its first line opens a record. Spark's own reader
therefore takes such a file in one piece. Here the lines of all ranges are read
side by side, and two passes find the records:

1. Of each range only the lines with a quote are looked at. They say in which
   state (inside or outside of quotes) the range ends if it starts in either.
   One such row per range comes to the driver, where the states are chained
   along each file; ranges without quotes keep the state.
2. Every range knows the state it starts in, joins its own lines to records,
   and passes on what it holds of records that cross its borders; only these
   pieces are shuffled.

A quote opens a quoted field only as the first character of a field; after the
closing one, text up to the next delimiter belongs to the field. That is how
Spark's reader takes irregular quotes too.

The first record of each file is its header and is left out, empty lines
outside of quotes are skipped, and where records end with CR LF, the line
breaks inside of their quotes become LF.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.session import ship_code

CLOSING = re.compile(r'[^"]*(?:""[^"]*)*"(?!")')
RANGE = ["file", "start", "length"]
NAMES = ["record", "file", "owner", "piece", "header"]


def ends_inside(line: str, inside: bool, delimiter: str = ",") -> bool:
    """Whether a line ends within quotes, given whether it starts within them."""
    at, opening = 0, delimiter + '"'
    while True:
        if not inside:
            if line.startswith('"', at):
                at += 1
            else:
                at = line.find(opening, at)
                if at < 0:
                    return False
                at += len(opening)
        closed = CLOSING.match(line, at)
        if closed is None:
            return True
        at = line.find(delimiter, closed.end())
        if at < 0:
            return False
        at, inside = at + len(delimiter), False


def _lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path, lineSep="\n")
    return lines.select("value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                        F.col("_metadata.file_block_length").alias("length"))


def _by_range(batches: Iterator[pa.RecordBatch]):
    """(range, its consecutive lines in this batch); a task reads range after range."""
    for batch in batches:
        keys = [batch.column(batch.schema.get_field_index(c)).to_numpy() for c in RANGE]
        changes = np.flatnonzero((np.diff(keys[0]) != 0) | (np.diff(keys[1]) != 0)) + 1
        cuts = [0, *changes.tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if a < b:
                yield tuple(int(k[a]) for k in keys), batch.column(0).slice(a, b - a)


def range_states(spark: SparkSession, path: str, delimiter: str = ",") -> dict[int, list[tuple]]:
    """Per file the ranges that hold quotes, in order: (start, length, ends
    inside if it starts outside, ends inside if it starts inside, whether a
    record ends in it if it starts inside). One row per range at most."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {}
        for key, lines in _by_range(batches):
            outside, inside, ended = found.get(key, (False, True, False))
            for line in lines.to_pylist():
                if outside == inside:  # both have met: one state from here on
                    outside = inside = ends_inside(line, inside, delimiter)
                else:
                    outside, inside = ends_inside(line, outside, delimiter), ends_inside(line, inside, delimiter)
                ended = ended or not inside
            found[key] = outside, inside, ended
        rows = [(*k, *v) for k, v in found.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64() if i < 3 else pa.bool_()) for i in range(6)],
                                         names=[*RANGE, "outside", "inside", "ended"])

    quoted = _lines(spark, path).filter(F.col("value").contains('"'))
    out = defaultdict(list)
    for r in quoted.mapInArrow(scan, "file long, start long, length long, outside boolean, inside boolean, ended boolean").collect():
        out[r.file].append((r.start, r.length, r.outside, r.inside, r.ended))
    return {f: sorted(ranges) for f, ranges in out.items()}


class States:
    """The state in which a range starts, chained from those before it in its file."""

    def __init__(self, ranges: dict[int, list[tuple]]):
        self.files, self.crossing = {}, False
        for file, listed in ranges.items():
            starts, ends, after = [], [], [(False, -1)]  # (inside, start of the range in which the open record began)
            for start, length, outside, inside, ended in listed:
                was_inside, owner = after[-1]
                if not was_inside:
                    now, owner = outside, start
                else:
                    now, owner = inside, start if ended else owner
                starts.append(start)
                ends.append(start + length)
                after.append((now, owner))
                self.crossing |= now
            self.files[file] = starts, ends, after

    def at(self, file: int, start: int, length: int) -> tuple[bool, int]:
        if file not in self.files:
            return False, -1
        starts, ends, after = self.files[file]
        before = bisect_left(starts, start)
        if before and ends[before - 1] > start or bisect_right(starts, start) < bisect_left(starts, start + length):
            raise RuntimeError("the files are split in another way than when their quotes were read; call read_csv again")
        return after[before]


def _records(spark: SparkSession, path: str, states: States, delimiter: str) -> DataFrame:
    """(record, file, owner, piece): whole records (piece null) and pieces of
    records that cross ranges, with the range in which the record began."""

    def tidy(record: str) -> str:
        return record[:-1].replace("\r\n", "\n") if record.endswith("\r") else record

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, inside, owner, open_lines, header, rows = None, False, -1, [], False, []

        def out():
            nonlocal rows
            got, rows = rows, []
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in got], pa.string())] + [
                pa.array([r[i] for r in got], pa.int64()) for i in (1, 2, 3)] + [pa.array([r[4] for r in got], pa.bool_())],
                names=NAMES)

        def leave():  # the range is over: what is open goes on in the next one
            if key is not None and open_lines:
                rows.append(("\n".join(open_lines), key[0], owner, key[1], header))

        for now, lines in _by_range(batches):
            if now != key:
                leave()
                key, (inside, owner), open_lines = now, states.at(*now), []
                begun_before, header = inside, now[1] == 0
            if not inside and not header and not pc.any(pc.match_substring_regex(lines, '["\r]')).as_py():
                rest = lines.filter(pc.greater(pc.binary_length(lines), 0))  # a record each
                none = pa.nulls(len(rest), pa.int64())
                yield pa.RecordBatch.from_arrays([rest, none, none, none, pa.nulls(len(rest), pa.bool_())], names=NAMES)
                continue
            for line in lines.to_pylist():
                if not inside and '"' not in line:  # a record of its own
                    if line and line != "\r":
                        if header:
                            header = False
                        else:
                            rows.append((tidy(line), None, None, None, False))
                    continue
                open_lines.append(line)
                if not inside:
                    owner, begun_before = now[1], False
                inside = ends_inside(line, inside, delimiter)
                if not inside:
                    record, open_lines = "\n".join(open_lines), []
                    if begun_before:
                        rows.append((record, now[0], owner, now[1], False))
                        begun_before = False
                    elif header:
                        header = False
                    else:
                        rows.append((tidy(record), None, None, None, False))
            yield out()
        leave()
        yield out()

    return _lines(spark, path).mapInArrow(join, "record string, file long, owner long, piece long, header boolean")


def read_records(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """One row ``record`` per record of the files, header and empty lines left out.

    The quotes are read when this is called, the records when the frame is;
    ``States.at`` refuses to go on if the files are split differently by then.
    A record has to fit in a row; the pieces of one that spans many ranges are
    put together in the order of their ranges.
    """
    ship_code(spark)
    states = States(range_states(spark, path, delimiter))
    rows = _records(spark, path, states, delimiter)
    whole = rows.filter("piece IS NULL").select("record")
    if not states.crossing:
        return whole
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "record"))), lambda p: p["record"]), "\n")
    crossing = rows.filter("piece IS NOT NULL").groupBy("file", "owner").agg(text.alias("record"), F.bool_or("header").alias("header"))
    ended = F.col("record").endswith("\r")
    crossing = crossing.filter(~F.col("header")).select(
        F.when(ended, F.regexp_replace(F.substr("record", F.lit(1), F.length("record") - 1), "\r\n", "\n")).otherwise(F.col("record")).alias("record"))
    return whole.union(crossing)
