"""CSV records that run over several lines, cut out of the splits of large files.

Where a record ends depends on whether a line break stands inside quotes, and so
on all the text before. But a line can only begin outside or inside a quoted
field, so each split is read once for both cases, which gives for either one the
state at its end. The true states follow split by split; then every split is cut
on its own, and only the records that cross its edges are put together.

A quote opens a field as its first character, is doubled inside, and closes it;
elsewhere it is text. Line breaks inside fields are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUOTE, SEPARATOR, BREAK = '"', ",", "\n"
_BOM = "﻿"

_SPLIT_SCHEMA = "file string, block long, ends_inside array<boolean>, closes array<boolean>, head string"
_PIECE_SCHEMA = "value string, file string, block long, place long"


def ends_inside(line: str, inside: bool) -> bool:
    """Whether the text after the line's break is inside a quoted field, given that for the line's beginning."""
    at = 0
    while True:
        if inside:
            at = line.find(QUOTE, at)
            if at < 0:
                return True
            at += 1
            if line.startswith(QUOTE, at):
                at += 1
                continue
            inside = False
        if line.startswith(QUOTE, at) and (at == 0 or line[at - 1] == SEPARATOR):
            inside, at = True, at + 1
            continue
        at = line.find(SEPARATOR, at)
        if at < 0:
            return False
        at += 1


def _lines(spark: SparkSession, path) -> DataFrame:
    """Lines in their order, each with its file and the place of its split in it."""
    return spark.read.text(path, lineSep=BREAK).select("value", F.col("_metadata.file_path").alias("file"), F.input_file_block_start().alias("block"))


def _by_split(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.Array]]:
    """(file, block, lines) of consecutive lines of one split; a split may come in several parts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block = pc.run_end_encode(batch.column(1)), pc.run_end_encode(batch.column(2))
        ends = sorted({*file.run_ends.to_pylist(), *block.run_ends.to_pylist()})
        for start, end in zip([0, *ends], ends):
            yield batch.column(1)[start].as_py(), batch.column(2)[start].as_py(), batch.column(0).slice(start, end - start)


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    """Per split and for either state at its beginning: the state at its end, and whether any of its lines ends a record."""
    found: dict[tuple[str, int], list] = {}
    for file, block, lines in _by_split(batches):
        state = found.setdefault((file, block), [[False, True], [False, False], None, []])
        now, closes, head, begun = state
        at = 0
        quoted = pc.indices_nonzero(pc.match_substring(lines, QUOTE)).to_pylist()
        for k in [*quoted, len(lines)]:
            if k > at:
                closes[:] = [c or not s for c, s in zip(closes, now)]
            if k < len(lines):
                line = lines[k].as_py()
                now[:] = [ends_inside(line, s) for s in now]
                closes[:] = [c or not s for c, s in zip(closes, now)]
            at = k + 1
        if block == 0 and head is None:
            state[2] = _first_record(begun, lines)
    rows = [(f, b, s, c, h) for (f, b), (s, c, h, _) in found.items()]
    if rows:
        types = [pa.string(), pa.int64(), pa.list_(pa.bool_()), pa.list_(pa.bool_()), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types)], names=["file", "block", "ends_inside", "closes", "head"])


def _first_record(begun: list[str], lines: pa.Array) -> str | None:
    """The first record that is not empty, once all its lines are there; ``begun`` holds them from call to call."""
    for line in lines:
        line = line.as_py()
        if not begun:
            line = line.removeprefix(_BOM)
            if not line.rstrip("\r"):
                continue
        begun.append(line)
        inside = False
        for part in begun:
            inside = ends_inside(part, inside)
        if not inside:
            return BREAK.join(begun).removesuffix("\r")
    return None


class Split(NamedTuple):
    """Whether a split begins inside a field, and the split in which the record that is open there began."""

    inside: bool
    begun: int


def split_states(scanned: Iterable[Mapping]) -> tuple[dict[str, dict[int, Split]], list[str]]:
    """The state at the beginning of every split of every file, from what each split gives for either one.

    Also the files that have a split that ends inside a field.
    """
    states: dict[str, dict[int, Split]] = {}
    crossed: dict[str, None] = {}
    inside, begun = False, 0
    for row in sorted(scanned, key=lambda r: (r["file"], r["block"])):
        block = row["block"]
        if row["file"] not in states:
            states[row["file"]], inside = {}, False
        states[row["file"]][block] = Split(inside, begun if inside else block)
        if row["closes"][inside] or not inside:
            begun = block
        inside = row["ends_inside"][inside]
        if inside:
            crossed[row["file"]] = None
    return states, list(crossed)


class _Cutter:
    """Cuts the lines of one split after the other into records.

    A record that crosses the edge of a split comes in pieces that carry the split
    in which it began and the one they stand in; whole records carry none. The
    header, the first record of a file, is left out.
    """

    def __init__(self, states: Mapping[str, Mapping[int, Split]], heads: Mapping[str, str]):
        self.states, self.heads = states, heads
        self.at: tuple[str, int] | None = None
        self.inside, self.begun, self.parts, self.head, self.first = False, 0, [], False, False

    def __call__(self, batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for file, block, lines in _by_split(batches):
            if (file, block) != self.at:
                yield from self.closed()
                self.enter(file, block)
            whole: list[pa.Array] = []
            crossing: list[pa.RecordBatch] = []
            self.cut(lines, whole, crossing)
            if whole:
                values = pa.concat_arrays([w.cast(pa.string()) for w in whole])
                none = pa.nulls(len(values), pa.int64())
                yield _batch(values, pa.array([file] * len(values), pa.string()), none, none)
            yield from crossing
        yield from self.closed()

    def enter(self, file: str, block: int) -> None:
        found = self.states.get(file, {}).get(block)
        if found is None:
            raise RuntimeError(f"{file} was split anew between two reads; read it again")
        self.at = file, block
        self.inside, self.begun = found
        self.first = block == 0
        self.head = block == 0 and file in self.heads

    def closed(self) -> Iterator[pa.RecordBatch]:
        """What is open where a split ends."""
        if self.parts:
            yield self.piece(BREAK.join(self.parts))
            self.parts = []

    def piece(self, value: str) -> pa.RecordBatch:
        file, block = self.at
        return _batch(pa.array([value], pa.string()), pa.array([file], pa.string()), pa.array([self.begun], pa.int64()), pa.array([block], pa.int64()))

    def cut(self, lines: pa.Array, whole: list[pa.Array], crossing: list[pa.RecordBatch]) -> None:
        while (self.first or self.head) and len(lines):
            line = lines[0].as_py()
            self.line(line.removeprefix(_BOM) if self.first else line, whole, crossing)
            self.first, lines = False, lines.slice(1)
        # Records of one line stay in Arrow, in stretches between those of several.
        stretch = upto = 0
        for k in pc.indices_nonzero(pc.match_substring(lines, QUOTE)).to_pylist():
            line = lines[k].as_py()
            if not self.inside:
                if ends_inside(line, False):
                    whole.append(lines.slice(stretch, k - stretch))
                    self.line(line, whole, crossing)
            else:
                self.parts += lines.slice(upto, k - upto).to_pylist()
                self.line(line, whole, crossing)
                stretch = k + 1
            upto = k + 1
        if self.inside:
            self.parts += lines.slice(upto).to_pylist()
        else:
            whole.append(lines.slice(stretch))

    def line(self, line: str, whole: list[pa.Array], crossing: list[pa.RecordBatch]) -> None:
        """One line that begins, goes on with or ends a record."""
        if not self.inside:
            self.begun = self.at[1]
        self.parts.append(line)
        self.inside = ends_inside(line, self.inside)
        if self.inside:
            return
        record, self.parts = BREAK.join(self.parts), []
        if self.begun != self.at[1]:
            crossing.append(self.piece(record))
        elif self.head and record.rstrip("\r"):
            self.head = False
        else:
            whole.append(pa.array([record], pa.string()))


def _batch(*columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), names=["value", "file", "block", "place"])


class Records(NamedTuple):
    """Data records (``value``, ``file``), and the header record of each file."""

    rows: DataFrame
    heads: dict[str, str]


def read_records(spark: SparkSession, path) -> Records:
    """The records of CSV files with a header, line breaks in quoted fields and all (an action, then lazy).

    The first read scans the splits; the driver gets a row for each, as it lists
    them to plan the scan. The second cuts them. A split is never shuffled: only
    the pieces of records that cross splits are, two per split. To find these the
    files that have any are read once more. Empty records are left out. If files are split differently at the second read, as when the
    cluster's size changes in between, it fails and says so. A quoted field that is
    still open where its file ends makes its last record.
    """
    lines = _lines(spark, path)
    scanned = [r.asDict() for r in lines.mapInArrow(_scan, _SPLIT_SCHEMA).collect()]
    heads = {r["file"]: r["head"] for r in scanned if r["head"] is not None}
    states, crossed = split_states(scanned)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        return _Cutter(states, heads)(batches)

    rows = lines.mapInArrow(cut, _PIECE_SCHEMA).filter(F.col("block").isNull()).select("value", "file")
    if crossed:
        pieces = lines.filter(F.col("file").isin(crossed)).mapInArrow(cut, _PIECE_SCHEMA).filter(F.col("block").isNotNull())
        joined = pieces.groupBy("file", "block").agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("p"))
        rows = rows.unionByName(joined.select(F.array_join("p.value", BREAK).alias("value"), "file"))
    return Records(rows.withColumn("value", F.regexp_replace("value", "\r\\z", "")).filter("value <> ''"), heads)
