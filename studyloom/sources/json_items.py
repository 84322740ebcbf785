"""Top-level items of very large JSON files, read by many tasks.

Spark's text source cuts a file into splits at a separator; here that is the quote, so each record is
what stands between two quotes. Whether a record is inside a string, and how deep brackets are nested,
depends on all of the file before it. So a first pass sums up each split for both cases (it begins inside
or outside a string): quotes, change of depth, commas by depth. The sums, one small row per split, give
every split its real beginning; a second pass cuts the splits at the commas of depth one. Only items
that go over the end of a split are put together afterwards. The text of the files is not shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from studyloom.sources.files import plain_path

_MARKS = re.compile(r"[{}\[\],]")
_WHITE = " \t\r\n﻿"
#: Characters of items that are handed on together.
TOGETHER = 4 << 20


def _segments(spark: SparkSession, paths: Sequence[str], glob: str | None) -> DataFrame:
    reader = spark.read.option("lineSep", '"')
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"), "value")


def _escapes(segment: str) -> bool:
    """True if the quote after a segment is escaped."""
    return (len(segment) - len(segment.rstrip("\\"))) % 2 == 1


@dataclass
class _Sums:
    """What a split adds, for a beginning outside (0) and inside (1) of a string."""

    first: str = ""
    quotes: int = 0
    depth: list[int] = field(default_factory=lambda: [0, 0])
    commas: list[Counter] = field(default_factory=lambda: [Counter(), Counter()])
    opened: list[Counter] = field(default_factory=lambda: [Counter(), Counter()])
    tail: list[str] = field(default_factory=lambda: ["", ""])

    def add(self, segment: str) -> None:
        if not self.first:
            self.first = segment.lstrip(_WHITE)[:1]
        case = self.quotes % 2  # the case in which this segment is outside
        depth = self.depth[case]
        for mark in _MARKS.findall(segment):
            if mark == ",":
                self.commas[case][depth] += 1
            elif mark in "{[":
                self.opened[case][depth] += 1
                depth += 1
            else:
                depth -= 1
        self.depth[case] = depth
        self.quotes += not _escapes(segment)


_SUMS = ("path string, block long, first string, quotes long, depth array<long>, "
         "commas array<map<long,long>>, opened array<map<long,long>>")


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    here, sums = None, None

    def row() -> pa.RecordBatch:
        counts = pa.list_(pa.map_(pa.int64(), pa.int64()))
        values = [here[0], here[1], sums.first, sums.quotes, sums.depth,
                  [list(c.items()) for c in sums.commas], [list(c.items()) for c in sums.opened]]
        types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int64()), counts,
                 counts]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip(values, types)],
            names=["path", "block", "first", "quotes", "depth", "commas", "opened"])

    for batch in batches:
        for path, block, segment in zip(*(c.to_pylist() for c in batch.columns)):
            if (path, block) != here:
                if here is not None:
                    yield row()
                here, sums = (path, block), _Sums()
            sums.add(segment)
    if here is not None:
        yield row()


@dataclass(frozen=True)
class _Start:
    """Where a split begins: inside a string, nesting depth, number of the open item."""

    inside: int
    depth: int
    item: int
    kind: str


def _starts(rows: list) -> tuple[dict[tuple[str, int], _Start], set[str]]:
    """Beginnings of the splits of well-formed files, and the other files."""
    files: dict[str, list] = {}
    for row in rows:
        files.setdefault(row.path, []).append(row)
    starts, broken = {}, set()
    for path, parts in files.items():
        parts.sort(key=lambda r: r.block)
        kind = next((r.first for r in parts if r.first), "")
        found, inside, depth, item, roots = {}, 0, 0, 0, 0
        for row in parts:
            found[path, row.block] = _Start(inside, depth, item, kind)
            case = inside
            item += row.commas[case].get(1 - depth, 0)
            roots += row.opened[case].get(-depth, 0)
            depth += row.depth[case]
            inside = (inside + row.quotes) % 2
        # the quote after the last record of a file is not there, unless the text ends with one
        if kind in ("{", "[") and depth == 0 and roots == 1 and inside == 1:
            starts.update(found)
        else:
            broken.add(path)
    return starts, broken


_ITEMS = "path string, kind string, item long, block long, whole boolean, value string"


def _cut(starts: dict[tuple[str, int], _Start]):
    """The second pass: items and parts of items of every split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        here = start = None
        inside = depth = item = 0
        begun = False  # the open item began in this split
        parts: list[str] = []

        def end(whole: bool) -> None:
            nonlocal size
            value = "".join(parts)
            rows.append((here[0], start.kind, item, here[1], whole, value))
            size += len(value)
            parts.clear()

        def hand_on() -> pa.RecordBatch:
            nonlocal size
            columns = list(zip(*rows))
            types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
            rows.clear()
            size = 0
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                names=["path", "kind", "item", "block", "whole", "value"])

        for batch in batches:
            for path, block, segment in zip(*(c.to_pylist() for c in batch.columns)):
                if (path, block) != here:
                    if start is not None and depth > 0:
                        end(False)
                    parts.clear()
                    here, start = (path, block), starts.get((path, block))
                    if start is not None:
                        inside, depth, item = start.inside, start.depth, start.item
                    begun = False
                if start is None:
                    continue
                text, at = segment + '"', 0
                if not inside:
                    for match in _MARKS.finditer(segment):
                        mark = match.group()
                        if mark in "{[":
                            if depth == 0:
                                at, begun = match.end(), True
                            depth += 1
                        elif mark != ",":
                            depth -= 1
                            if depth == 0:
                                parts.append(text[at:match.start()])
                                end(begun)
                        elif depth == 1:
                            parts.append(text[at:match.start()])
                            end(begun)
                            at, begun, item = match.end(), True, item + 1
                if depth > 0:
                    parts.append(text[at:] if at else text)
                if not _escapes(segment):
                    inside = 1 - inside
                if size > TOGETHER:
                    yield hand_on()
        if start is not None and depth > 0:
            end(False)
        if rows:
            yield hand_on()

    return run


def _one_slash(path: str) -> str:
    """A URI with as many slashes after its scheme wherever it comes from."""
    return re.sub("^([a-z0-9+.-]+):/+", r"\1:/", path)


def read_items(spark: SparkSession, paths: str | Sequence[str],
               glob: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Items of JSON objects and lists, and the files that are neither.

    `paths` are files, folders or patterns. Items: file, kind (`{` or `[`), item (place in the file, from 0), value (the text of the item: a key
    and its value, or an element). An empty object or list has one blank item. Files: file, of those
    whose brackets or quotes do not fit, or that hold something else; they have no items. Whether an item
    is valid in itself is left to whoever parses it.

    The driver holds one small row per input split, as its own scheduler does. An item is one value, so
    it must fit into a task; a file need not.
    """
    segments = _segments(spark, [paths] if isinstance(paths, str) else paths, glob)
    starts, broken = _starts(segments.mapInArrow(_sum_up, _SUMS).collect())
    # the text source passes over files without a byte
    read = {_one_slash(path) for path in broken} | {_one_slash(path) for path, _ in starts}
    broken |= {path for path in segments.inputFiles() if _one_slash(path) not in read}
    cut = segments.mapInArrow(_cut(starts), _ITEMS)
    joined = (cut.where("not whole").groupBy("path", "kind", "item")
              .agg(F.array_sort(F.collect_list(F.struct("block", "value"))).alias("parts"))
              .select("path", "kind", "item", F.array_join("parts.value", "").alias("value")))
    items = cut.where("whole").select("path", "kind", "item", "value").unionByName(joined)
    bad = spark.createDataFrame([(p,) for p in sorted(broken)], "path string")
    return (items.select(plain_path(F.col("path")).alias("file"), "kind", "item", "value"),
            bad.select(plain_path(F.col("path")).alias("file")))
