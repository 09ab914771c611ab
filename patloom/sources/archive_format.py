"""Nested archives as a data source: `spark.read.format("patent_archive").load(folder)`, and as a stream.

Gives the rows of `read_nested` with the year and week of the archive's name. The driver lists names, sizes and
times only. A task reads those members of an archive that begin in its slice of the file, so one huge archive keeps many
tasks busy and nothing is shuffled. Files are chosen before any is opened.

Options: `fromWeek` and `toWeek` (year and week as in 202405, both included), `docRule` (true: only the DOC folder, where an archive
has one), `sliceBytes`, `settleSeconds` (a stream leaves files alone that were modified less than so many seconds ago), and
`pushFilters` (false). With the last one, filters on archive, year and week choose files too. Spark 4.1 keeps what was
pushed with the loaded table, not with its scan: a query that filters one load in two ways would mix them up, so give
each use a `load` of its own.
"""

from __future__ import annotations

import re
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql import datasource as ds

from patloom.functions.names import ARCHIVE_EXTENSION, EP_ARCHIVE
from patloom.sources.archives import (
    CONTENT_ERRORS,
    SLICE_BYTES,
    _batches,
    _in_doc_folder,
    _member_entries,
    _open,
    _Outer,
    _reason,
    _schema,
    located,
)

NAME = "patent_archive"
ROWS = "archive string, member string, entry string, content binary, error string, year string, week string"
BY_FILE = ("archive", "year", "week")  # columns that are the same in all rows of a file


@dataclass(frozen=True)
class Slice(ds.InputPartition):
    """The members of an archive that begin in [begin, end)."""

    path: str
    begin: int
    end: int | None


def _named(path: str) -> dict:
    name = path.rsplit("/", 1)[-1]
    found = re.match(EP_ARCHIVE, name)
    return {"archive": name, "year": found and found[1], "week": found and found[2]}


def _listed(folder: str) -> list[tuple[int, str, int]]:
    """(time of modification in nanoseconds, path, size) of all archives below a folder, in that order."""
    filesystem, inside = located(folder)
    scheme = folder.split("://", 1)[0] + "://" if "://" in folder else ""
    files = filesystem.get_file_info(fs.FileSelector(inside, recursive=True))
    found = [(f.mtime_ns or 0, scheme + f.path, f.size) for f in files if f.type == fs.FileType.File]
    return sorted(f for f in found if re.search(ARCHIVE_EXTENSION, f[1]))


def _within(named: dict, first: str, last: str) -> bool:
    """Whether a file is of a span of weeks; one whose name gives no week is only where no span is asked for."""
    if not first and not last:
        return True
    week = (named["year"] or "") + (named["week"] or "")
    return bool(week) and first <= week and (not last or week <= last)


def _slices(path: str, size: int, slice_bytes: int) -> Iterator[Slice]:
    begins = range(0, max(1, size), slice_bytes)
    for begin in begins:  # offsets of a compressed tar go beyond the file's size, into the last slice
        yield Slice(path, begin, begin + slice_bytes if begin + slice_bytes < size else None)


def _rows(part: Slice, doc_rule: bool) -> Iterator[dict]:
    named = _named(part.path)
    with _open(part.path) as opened:
        try:
            outer = _Outer(opened, part.path)
            found = list(outer.members())
        except CONTENT_ERRORS as problem:
            if part.begin == 0:
                yield {**named, "error": _reason(problem)}
            return
        if doc_rule and any(_in_doc_folder(member) for member, _, _ in found):
            found = [one for one in found if _in_doc_folder(one[0])]
        mine = (one for one in found if part.begin <= one[1] and (part.end is None or one[1] < part.end))
        for member, offset, size in sorted(mine, key=lambda one: one[1]):
            for row in _member_entries(outer, part.path, member, offset, size):
                yield {**named, **{k: v for k, v in row.items() if k != "path"}}


class _Options:
    def __init__(self, options: dict) -> None:
        self.folder = options.get("path")
        if not self.folder:
            raise ValueError("a folder is needed: load(folder)")
        self.doc_rule = options.get("docRule", "true").lower() == "true"
        self.slice_bytes = int(options.get("sliceBytes", SLICE_BYTES))
        self.settle = float(options.get("settleSeconds", 0))
        self.weeks = options.get("fromWeek", ""), options.get("toWeek", "")

    def listed(self) -> list[tuple[int, str, int]]:
        """The files of the weeks asked for."""
        first, last = self.weeks
        return [f for f in _listed(self.folder) if _within(_named(f[1]), first, last)]

    def batches(self, part: Slice) -> Iterator[pa.RecordBatch]:
        yield from _batches(_rows(part, self.doc_rule), _schema(ROWS), sized="content")


def _test(value: str | None, one: ds.Filter) -> bool | None:
    """What a filter says of a value; None where that is not known here."""
    if isinstance(one, ds.IsNull):
        return value is None
    if isinstance(one, ds.IsNotNull):
        return value is not None
    if isinstance(one, ds.EqualNullSafe):
        return value == one.value
    if value is None:
        return False
    if isinstance(one, ds.In):
        return value in one.value
    if isinstance(one, ds.Not):
        inner = _test(value, one.child) if not isinstance(one.child, ds.EqualNullSafe) else None
        return None if inner is None else not inner
    tests = {
        ds.EqualTo: lambda a, b: a == b,
        ds.GreaterThan: lambda a, b: a.encode() > b.encode(),
        ds.GreaterThanOrEqual: lambda a, b: a.encode() >= b.encode(),
        ds.LessThan: lambda a, b: a.encode() < b.encode(),
        ds.LessThanOrEqual: lambda a, b: a.encode() <= b.encode(),
        ds.StringStartsWith: str.startswith,
        ds.StringEndsWith: str.endswith,
        ds.StringContains: lambda a, b: b in a,
    }
    test = tests.get(type(one))
    return None if test is None else test(value, one.value)


def _column(one: ds.Filter) -> str | None:
    attribute = _column_path(one)
    return attribute[0] if attribute and len(attribute) == 1 and attribute[0] in BY_FILE else None


def _column_path(one: ds.Filter):
    return _column_path(one.child) if isinstance(one, ds.Not) else getattr(one, "attribute", None)


class ArchiveReader(ds.DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options, self.filters = _Options(options), []

    def partitions(self) -> Sequence[Slice]:
        chosen = (
            (path, size)
            for _, path, size in self.options.listed()
            if all(_test(_named(path)[_column(one)], one) for one in self.filters)
        )
        return [part for path, size in chosen for part in _slices(path, size, self.options.slice_bytes)]

    def read(self, partition: Slice | None) -> Iterator[pa.RecordBatch]:
        if partition is not None:
            yield from self.options.batches(partition)


class FilteringReader(ArchiveReader):
    def pushFilters(self, filters: list[ds.Filter]) -> list[ds.Filter]:
        """Takes note of the filters on columns of the file's name; Spark tests all of them again."""
        self.filters = [one for one in filters if _column(one) and _test("", one) is not None]
        return filters


class ArchiveStreamReader(ds.DataSourceStreamReader):
    """Archives in order of time of modification and path; the offset is the last one given.

    A file that appears later must not be older than the last one given, as uploads are not: leave files alone for
    some seconds (`settleSeconds`) where several writers upload at once. A file that is replaced is given again.
    """

    def __init__(self, options: dict) -> None:
        self.options = _Options(options)

    def initialOffset(self) -> dict:
        return {"time": "0", "path": ""}

    def latestOffset(self) -> dict:
        until = time.time_ns() - int(self.options.settle * 1e9)
        found = [f for f in self.options.listed() if not self.options.settle or f[0] <= until]
        return {"time": str(found[-1][0]), "path": found[-1][1]} if found else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> Sequence[Slice]:
        low, high = ((int(o["time"]), o["path"]) for o in (start, end))
        new = ((path, size) for at, path, size in self.options.listed() if low < (at, path) <= high)
        return [part for path, size in new for part in _slices(path, size, self.options.slice_bytes)]

    def read(self, partition: Slice | None) -> Iterator[pa.RecordBatch]:
        if partition is not None:
            yield from self.options.batches(partition)


class ArchiveSource(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return ROWS

    def reader(self, schema) -> ArchiveReader:
        pushing = self.options.get("pushFilters", "false").lower() == "true"
        return FilteringReader(self.options) if pushing else ArchiveReader(self.options)

    def streamReader(self, schema) -> ArchiveStreamReader:
        return ArchiveStreamReader(self.options)


def register(spark: SparkSession) -> None:
    """Make the format known to the session, and let Spark hand filters to those loads that ask for them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ArchiveSource)
