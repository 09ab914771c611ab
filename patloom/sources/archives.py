"""Archives as rows, without moving an archive whole.

An archive is opened by path from the shared file system and read by seeking. First each archive
lists what lies in it (names and offsets only); these small rows are then spread over the cluster
by slices of an archive, and each task reads the members of its slices. So one huge archive keeps
many tasks busy, its bytes are never shuffled, and memory holds one member at a time.
"""

from __future__ import annotations

import codecs
import gzip
import io
import lzma
import posixpath
import re
import struct
import tarfile
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patloom.functions.names import base_name
from patloom.functions.us import DOCUMENT
from patloom.sources import restart

# ---- Fixed values: the published layout --------------------------------------------------
DOC_FOLDER = "DOC"
DOCUMENT_ENDING = ".xml"
CONTENTS_ENDING = "TOC.xml"
CLOSING_TAG = r"</us-patent-[a-z-]+>"
# -------------------------------------------------------------------------------------------

SLICE_BYTES = 32 << 20  # members of an archive that start in the same slice are read together
PORTION_BYTES = SLICE_BYTES // 2  # for each core: what is staged or replaced at once, at least, where the disk is to hold little twice
MOST_PORTIONS = 12  # about so many, of larger inputs; each has jobs of its own
TASKS_PER_CORE = 100  # at most; slices are dealt to tasks, so a task may have several
AHEAD_BYTES = 128 << 10  # of a file, read at once
BATCH_BYTES = 4 << 20  # size at which a batch of entries is handed to Spark

MEMBERS = "path string, member string, offset bigint, size bigint, error string"
ENTRIES = "path string, member string, entry string, content binary, error string"
INDEX = "path string, entry string, encoding string, at bigint, size bigint, bit bigint, out bigint, window binary, begin bigint, end bigint, doc_pos int, error string"
DOCUMENTS = "path string, entry string, doc_pos int, xml string, error string"


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system that a path names, and the path on it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    scheme, rest = path.split("://", 1)
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    return fs.FileSystem.from_uri(f"{scheme}://{quote(rest)}")


class _Raw(io.RawIOBase):
    """An input file that takes offsets as files in memory do: what bad bytes ask for is no fault of the file system."""

    def __init__(self, file: pa.NativeFile) -> None:
        self.file, self.end, self.at = file, file.size(), 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def seek(self, offset: int, whence: int = 0) -> int:
        if whence == 0 and offset < 0:
            raise ValueError(f"negative seek value {offset}")
        self.at = max(0, offset + (0, self.at, self.end)[whence])
        return self.at

    def tell(self) -> int:
        return self.at

    def readinto(self, into) -> int:
        data = self.file.read_at(min(len(into), self.end - self.at), self.at) if self.at < self.end else b""
        into[: len(data)] = data
        self.at += len(data)
        return len(data)

    def close(self) -> None:
        if not self.closed:
            self.file.close()
        super().close()


class _File(io.BufferedReader):
    """Reads ahead, since archives are read in small pieces."""

    def read_at(self, size: int, offset: int) -> bytes:
        return self.raw.file.read_at(size, offset)


def _open(path: str) -> _File:
    """A seekable file on whatever file system the path names."""
    filesystem, inside = located(path)
    return _File(_Raw(filesystem.open_input_file(inside)), AHEAD_BYTES)


# What bad bytes give. Everything else, a file system that fails above all, is raised: Spark tries again.
CONTENT_ERRORS = (
    zipfile.BadZipFile, tarfile.TarError, gzip.BadGzipFile, zlib.error, lzma.LZMAError, struct.error,
    EOFError, ValueError, NotImplementedError,
)


def _reason(problem: Exception) -> str:
    """The reason for a row with an error. Errors of Arrow's file systems are raised, though they may also be of a kind named above."""
    if isinstance(problem, pa.ArrowException):
        raise problem
    return f"{type(problem).__name__}: {problem}"


class _Outer:
    """An outer zip or tar, by its ending. A member is known by where it starts, since names may repeat.

    A tar may be compressed; its offsets are then those of what it unpacks to.
    """

    def __init__(self, opened, name: str) -> None:
        if name.lower().endswith(".zip"):
            self.archive = zipfile.ZipFile(opened)
            self.infos = {info.header_offset: info for info in self.archive.infolist()}
        elif name.lower().endswith(".tar"):
            self.archive, self.infos = tarfile.open(fileobj=opened, mode="r:*"), None
        else:
            raise ValueError(f"not an archive: {name}")

    def members(self) -> Iterator[tuple[str, int, int]]:
        """Name, offset and size of each file."""
        if self.infos is not None:
            yield from ((i.filename, i.header_offset, i.file_size) for i in self.archive.infolist() if not i.is_dir())
        else:
            yield from ((i.name, i.offset_data, i.size) for i in self.archive if i.isfile())

    def read(self, offset: int, size: int) -> bytes:
        if self.infos is not None:
            return self.archive.read(self.infos[offset])
        self.archive.fileobj.seek(offset)
        blob = self.archive.fileobj.read(size)
        if len(blob) < size:
            raise EOFError(f"{len(blob)} of {size} bytes")
        return blob


def _in_doc_folder(member: str) -> bool:
    return posixpath.normpath(member).startswith(DOC_FOLDER + "/")


def _wanted(entry: str) -> bool:
    return entry.endswith(DOCUMENT_ENDING) and not entry.endswith(CONTENTS_ENDING)


def _batches(rows: Iterator[dict], schema: pa.Schema, sized: str | None = None) -> Iterator[pa.RecordBatch]:
    """Rows as record batches, cut by the bytes of the column `sized` or by count."""
    pending, held = [], 0
    for row in rows:
        pending.append(row)
        held += len((row.get(sized) if sized else None) or "") + 256
        if held >= BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(pending, schema)
            pending, held = [], 0
    if pending:
        yield pa.RecordBatch.from_pylist(pending, schema)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in ddl.split(","))])


def _list_members(doc_rule: bool):
    def listed(path: str) -> Iterator[dict]:
        try:
            with _open(path) as opened:
                found = list(_Outer(opened, path).members())
        except CONTENT_ERRORS as problem:  # a broken archive becomes a row, not a failed job
            yield {"path": path, "error": _reason(problem)}
            return
        if doc_rule and any(_in_doc_folder(member) for member, _, _ in found):
            found = [one for one in found if _in_doc_folder(one[0])]
        for member, offset, size in found:
            yield {"path": path, "member": member, "offset": offset, "size": size}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for path in batch.column(0).to_pylist() for row in listed(path))
        yield from _batches(rows, _schema(MEMBERS))

    return run


def _inner_entries(member: str, blob: bytes) -> Iterator[dict]:
    """The documents of an inner zip; nothing where the bytes are no zip. A bad entry is a row with its error."""
    if not zipfile.is_zipfile(io.BytesIO(blob)):
        return
    with zipfile.ZipFile(io.BytesIO(blob)) as inner:
        for info in inner.infolist():
            if _wanted(info.filename):
                try:
                    yield {"member": member, "entry": info.filename, "content": inner.read(info)}
                except CONTENT_ERRORS as problem:
                    yield {"member": member, "entry": info.filename, "error": _reason(problem)}


def _member_entries(outer: _Outer, path: str, member: str, offset: int, size: int) -> Iterator[dict]:
    """The documents of a member. One that cannot be read is a row with its error, and others are read on."""
    try:
        for entry in _inner_entries(member, outer.read(offset, size)):
            yield {"path": path, **entry}
    except CONTENT_ERRORS as problem:
        yield {"path": path, "member": member, "error": _reason(problem)}


def _read_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[dict]:
        path, opened, outer = None, None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["error"]:
                    yield {"path": row["path"], "error": row["error"]}
                    continue
                if row["path"] != path:
                    if opened:
                        opened.close()
                    path, opened = row["path"], _open(row["path"])
                    outer = _Outer(opened, path)
                yield from _member_entries(outer, path, row["member"], row["offset"], row["size"])

    yield from _batches(rows(), _schema(ENTRIES), sized="content")


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """path, modificationTime, length of the files below a path. Their bytes are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).drop("content")


def _tasks(files: DataFrame, tasks: int | None) -> int:
    """Task count for reading files: by their listed sizes, between the parallelism there is and a multiple."""
    if tasks:
        return tasks
    total = files.agg(F.sum("length")).first()[0] or 0
    cores = files.sparkSession.sparkContext.defaultParallelism
    return max(cores, min(total // SLICE_BYTES, TASKS_PER_CORE * cores))


def read_nested(archives: DataFrame, doc_rule: bool = True, tasks: int | None = None) -> DataFrame:
    """Documents of nested archives: outer zip or tar by ending, inner zips by their bytes.

    With `doc_rule` only the DOC folder is looked at where an archive has one. Gives (archive,
    member, entry, content, error); tables of contents are left out, whatever cannot be read is
    a row with its error. `archives` needs path and length, as `list_files` gives.
    """
    members = archives.select("path").mapInArrow(_list_members(doc_rule), MEMBERS)
    slices = F.coalesce(F.floor(F.col("offset") / SLICE_BYTES), F.lit(0))
    spread = members.repartition(_tasks(archives, tasks), "path", slices).sortWithinPartitions("path", "offset")
    entries = spread.mapInArrow(_read_members, ENTRIES)
    return entries.select(base_name(F.col("path")).alias("archive"), "member", "entry", "content", "error")


def _nested_blobs(doc_rule: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for batch in batches:
                for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                    try:
                        outer = _Outer(io.BytesIO(content.as_py()), path)
                        found = list(outer.members())
                    except CONTENT_ERRORS as problem:
                        yield {"path": path, "error": _reason(problem)}
                        continue
                    if doc_rule and any(_in_doc_folder(one[0]) for one in found):
                        found = [one for one in found if _in_doc_folder(one[0])]
                    for member, offset, size in found:
                        yield from _member_entries(outer, path, member, offset, size)

        yield from _batches(rows(), _schema(ENTRIES), sized="content")

    return run


def explode_nested(archives: DataFrame, doc_rule: bool = True) -> DataFrame:
    """As `read_nested`, for archives whose bytes are already rows (path, content).

    For small archives, or file systems that only Spark can reach.
    """
    entries = archives.select("path", "content").mapInArrow(_nested_blobs(doc_rule), ENTRIES)
    return entries.select(base_name(F.col("path")).alias("archive"), "member", "entry", "content", "error")


def _flat_entries(batches: Iterator[pa.RecordBatch], read) -> Iterator[dict]:
    """Rows that `read(opened, outer, entry)` gives for each top-level XML entry, content errors as rows."""
    for batch in batches:
        for path in batch.column(0).to_pylist():
            with _open(path) as opened:
                try:
                    outer = zipfile.ZipFile(opened)
                except CONTENT_ERRORS as problem:
                    yield {"path": path, "error": _reason(problem)}
                    continue
                for info in outer.infolist():
                    if info.filename.endswith(DOCUMENT_ENDING) and "/" not in info.filename:
                        try:
                            for row in read(opened, outer, info):
                                yield {"path": path, "entry": info.filename, **row}
                        except CONTENT_ERRORS as problem:
                            yield {"path": path, "entry": info.filename, "error": _reason(problem)}


def _whole(opened, outer: zipfile.ZipFile, entry: zipfile.ZipInfo) -> Iterator[dict]:
    yield {"content": outer.read(entry)}


def _text_blocks(outer: zipfile.ZipFile, name: zipfile.ZipInfo, encoding: str) -> Iterator[str]:
    with outer.open(name) as entry:
        yield from _decoded(iter(lambda: entry.read(4 << 20), b""), encoding)


def _documents(outer: zipfile.ZipFile, name: zipfile.ZipInfo) -> Iterator[dict]:
    """Single documents of an entry, read as a stream from its begin to its end."""
    encoding = "utf-8"
    try:
        for _ in _text_blocks(outer, name, encoding):
            pass
    except UnicodeDecodeError:  # one bad byte anywhere decides for the whole entry
        encoding = "ISO-8859-1"
    yield from _numbered(_pieces(_text_blocks(outer, name, encoding)), 0)


def _pieces(texts: Iterator[str]) -> Iterator[str]:
    """The pieces of a text that comes in blocks, each up to the end of a closing tag.

    A match of `DOCUMENT` ends at the first closing tag after its start, so each piece can be matched alone. Memory holds
    the longest piece.
    """
    closing, rest = re.compile(CLOSING_TAG), ""
    for block in texts:
        seen = max(rest.rfind("<"), 0)  # a closing tag cut by the block edge starts at the last "<"
        rest, done = rest + block, 0
        for end in closing.finditer(rest, seen):
            yield rest[done : end.end()]
            done = end.end()
        rest = rest[done:]


def _decoded(blocks: Iterator[bytes], encoding: str) -> Iterator[str]:
    decoder = codecs.getincrementaldecoder(encoding)()
    for block in blocks:
        yield decoder.decode(block)
    yield decoder.decode(b"", final=True)


def _packed_at(opened, entry: zipfile.ZipInfo) -> int:
    """Where the packed bytes of an entry begin: behind its own header, whose lengths may differ from the directory's."""
    opened.seek(entry.header_offset)
    header = opened.read(30)
    if header[:4] != b"PK\x03\x04":
        raise zipfile.BadZipFile("Bad magic number for file header")
    name, extra = struct.unpack("<HH", header[26:30])
    return entry.header_offset + 30 + name + extra


def _reader(opened, at: int) -> restart.Read:
    def read(offset: int, size: int) -> bytes:
        opened.seek(at + offset)
        return opened.read(size)

    return read


def _slices(opened, outer: zipfile.ZipFile, entry: zipfile.ZipInfo, span: int) -> list[dict]:
    """The slices of an entry: where each can be taken up, and which documents are its own.

    A slice begins behind the first closing tag after a restart point, and ends where the next one begins.
    An entry that is short, not deflated, or encrypted, is one slice: it is not read here, and known by its place in the file.
    """
    if entry.compress_size <= span or entry.compress_type != zipfile.ZIP_DEFLATED or entry.flag_bits & 1:
        return [{"begin": entry.header_offset}]
    try:
        return _sliced(opened, entry, span, "utf-8")
    except UnicodeDecodeError:  # one bad byte anywhere decides for the whole entry
        return _sliced(opened, entry, span, "ISO-8859-1")


def _sliced(opened, entry: zipfile.ZipInfo, span: int, encoding: str) -> list[dict]:
    at = _packed_at(opened, entry)
    waiting, check, total = None, 0, 0

    def blocks() -> Iterator[bytes]:
        nonlocal waiting, check, total
        for block, point in restart.unpacked(_reader(opened, at), entry.compress_size, span):
            waiting = point or waiting
            check, total = zlib.crc32(block, check), total + len(block)
            yield block

    first = {"encoding": encoding, "at": at, "size": entry.compress_size, "bit": 0, "out": 0, "window": b"", "begin": 0, "doc_pos": 0}
    found, document = [first], re.compile(DOCUMENT)
    begin, pos = 0, 0
    for piece in _pieces(_decoded(blocks(), encoding)):
        begin += len(piece.encode(encoding))
        pos += len(document.findall(piece))
        if waiting and waiting.out:
            # The tag ends behind the point, else an earlier block would have shown it.
            found.append({**first, "bit": waiting.bit, "out": waiting.out, "window": waiting.window, "begin": begin, "doc_pos": pos})
        waiting = None
    if check != entry.CRC or total != entry.file_size:
        raise zipfile.BadZipFile(f"Bad CRC-32 for file {entry.filename!r}")
    for one, following in zip(found, [*found[1:], {"begin": None}]):
        one["end"] = following["begin"]
    return found


def _index(span: int):
    def read(opened, outer: zipfile.ZipFile, entry: zipfile.ZipInfo) -> Iterator[dict]:
        yield from _slices(opened, outer, entry, span)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(_flat_entries(batches, read), _schema(INDEX), sized="window")

    return run


def _part(blocks: Iterator[bytes], begin: int, end: int | None) -> Iterator[bytes]:
    """The bytes from `begin` to `end` of what comes in blocks."""
    at = 0
    for block in blocks:
        piece = block[max(0, begin - at) : None if end is None else max(0, end - at)]
        if piece:
            yield piece
        at += len(block)
        if end is not None and at >= end:
            return


def _slice_documents(opened, row: dict) -> Iterator[dict]:
    """The documents of a slice, with their places in the entry."""
    if row["at"] is None:
        outer = zipfile.ZipFile(opened)
        entry = next(info for info in outer.infolist() if info.header_offset == row["begin"])  # names may repeat
        yield from _documents(outer, entry)
        return
    point = restart.Point(row["bit"], row["out"], row["window"] or b"")
    blocks = restart.resumed(_reader(opened, row["at"]), row["size"], point)
    end = None if row["end"] is None else row["end"] - point.out
    yield from _numbered(_pieces(_decoded(_part(blocks, row["begin"] - point.out, end), row["encoding"])), row["doc_pos"])


def _numbered(pieces: Iterator[str], pos: int) -> Iterator[dict]:
    """The documents of pieces, from place `pos` on."""
    document = re.compile(DOCUMENT)
    for piece in pieces:
        for xml in document.findall(piece):
            yield {"doc_pos": pos, "xml": xml}
            pos += 1


def _read_flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _batches(_flat_entries(batches, _whole), _schema(ENTRIES), sized="content")


def _read_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                named = {"path": row["path"], "entry": row["entry"]}
                if row["error"]:
                    yield {**named, "error": row["error"]}
                    continue
                with _open(row["path"]) as opened:
                    try:
                        for document in _slice_documents(opened, row):
                            yield {**named, **document}
                    except CONTENT_ERRORS as problem:  # of an entry that was not read before
                        yield {**named, "error": _reason(problem)}

    yield from _batches(rows(), _schema(DOCUMENTS), sized="xml")


def read_flat(archives: DataFrame, tasks: int | None = None) -> DataFrame:
    """Top-level XML entries of flat zips, whole: (archive, member, entry, content, error)."""
    entries = archives.select("path").repartition(_tasks(archives, tasks)).mapInArrow(_read_flat, ENTRIES)
    return entries.select(base_name(F.col("path")).alias("archive"), "member", "entry", "content", "error")


def index_flat(archives: DataFrame, tasks: int | None = None, span: int = restart.SPAN) -> DataFrame:
    """The slices of the entries of flat zips, about `span` packed bytes each: where a task can take an entry up.

    Every archive with longer entries is unpacked once, by one task, which keeps some 32 KB per slice. What cannot be read is a row with its error.
    """
    return archives.select("path").repartition(_tasks(archives, tasks)).mapInArrow(_index(span), INDEX)


def read_flat_documents(archives: DataFrame, tasks: int | None = None, span: int = restart.SPAN) -> DataFrame:
    """Single patent documents of flat zips: (archive, entry, doc_pos, xml, error).

    The same as `read_flat`, `decode_text` and `split_documents` in a row, for entries too large
    for a row. The slices of an entry are spread, so one archive keeps many tasks busy.
    """
    slices = index_flat(archives, tasks, span).repartition(_tasks(archives, tasks))
    found = slices.mapInArrow(_read_slices, DOCUMENTS)
    return found.select(base_name(F.col("path")).alias("archive"), "entry", "doc_pos", "xml", "error")


def spread_documents(documents: DataFrame, archives: int, tasks: int) -> DataFrame:
    """Spread documents over tasks before the parse, only where archives are fewer than tasks."""
    return documents.repartition(tasks) if archives < tasks else documents
