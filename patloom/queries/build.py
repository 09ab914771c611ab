"""XML and archives built from the given tables, as input for the queries that read them.

The XML is put together by expressions, row by row. Archives are written by the tasks that hold
the rows, a fixed number of documents to an archive.
"""

from __future__ import annotations

import io
import tarfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patloom.functions.names import EP_MIDDLE, EP_PREFIX, EP_SUFFIX
from patloom.sources.archives import _open

DOCUMENTS_PER_ARCHIVE = 200
DOCUMENTS_PER_INNER = 50
MOST_ARCHIVES = 53 * (9999 - 1900 + 1)  # weeks of years of four digits

US_HEAD = '<?xml version="1.0" encoding="UTF-8"?>\n<!DOCTYPE us-patent-grant SYSTEM "grant.dtd" [ ]>\n'
# Characters that XML cannot hold; the SQL drops them as well.
NOT_XML = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"


def escaped(value: Column) -> Column:
    """Text as XML character data."""
    text = value.cast("string")
    clean = F.regexp_replace(text, NOT_XML, "")
    for plain, reference in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\r", "&#13;")):
        clean = F.replace(clean, F.lit(plain), F.lit(reference))
    return F.when(text.rlike(r"[&<>\x00-\x08\x0b-\x1f]"), clean).otherwise(text)


def tag(name: str, *content: Column | str, **attributes: Column | str) -> Column:
    """An element; strings are markup as it stands, columns likewise (see `escaped`)."""
    opened: list[Column] = [F.lit(f"<{name}")]
    for key, value in attributes.items():
        value = F.lit(value) if isinstance(value, str) else escaped(value)
        opened += [F.lit(f' {key.replace("_", "-")}="'), value, F.lit('"')]
    inside = [F.lit(part) if isinstance(part, str) else part for part in content]
    return F.concat(*opened, F.lit(">"), *inside, F.lit(f"</{name}>"))


def leaf(name: str, value: Column | str) -> Column:
    return tag(name, escaped(F.lit(value) if isinstance(value, str) else value))


def each(values: Column, make) -> Column:
    """One element per array item, concatenated."""
    return F.array_join(F.transform(values, make), "")


def lines(text: Column) -> Column:
    return F.split(text, "\n")


def day(column: str) -> Column:
    return F.date_format(F.col(column), "yyyyMMdd")


def _write(path: str, content: bytes) -> None:
    if "://" in path:
        filesystem, inside = fs.FileSystem.from_uri(path)
    else:
        filesystem, inside = fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    filesystem.create_dir(inside.rsplit("/", 1)[0])
    with filesystem.open_output_stream(inside) as out:
        out.write(content)


def _zip(entries: list[tuple[str, bytes]]) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as archive:
        for name, content in entries:
            archive.writestr(name, content)
    return buffer.getvalue()


def _tar(entries: list[tuple[str, bytes]]) -> bytes:
    buffer = io.BytesIO()
    with tarfile.open(fileobj=buffer, mode="w") as archive:
        for name, content in entries:
            info = tarfile.TarInfo(name)
            info.size = len(content)
            archive.addfile(info, io.BytesIO(content))
    return buffer.getvalue()


def _nested(documents: list[tuple[str, str]], tar: bool) -> bytes:
    """DOC/n.zip with documents and a table of contents, and a zip outside DOC to be passed over."""
    inner = []
    for at in range(0, len(documents), DOCUMENTS_PER_INNER):
        part = [(f"{name}.xml", xml.encode()) for name, xml in documents[at : at + DOCUMENTS_PER_INNER]]
        inner.append((f"DOC/{at}.zip", _zip([*part, ("TOC.xml", b"<toc/>")])))
    outside = ("INDEX/extra.zip", _zip([("extra.xml", b"<extra/>")]))
    return (_tar if tar else _zip)([*inner, outside])


def _ep_archive(number: int, documents: list[tuple[str, str]]) -> tuple[str, bytes]:
    year, week = 1900 + number // 53, number % 53 + 1
    if year > 9999:
        raise ValueError(f"archive number {number} has no year of four digits")
    tar = number % 2 == 1
    name = f"{EP_PREFIX}{year:04d}{EP_MIDDLE}{week:02d}{EP_SUFFIX}{'.tar' if tar else '.zip'}"
    return name, _nested(documents, tar)


def _us_archive(number: int, documents: list[tuple[str, str]]) -> tuple[str, bytes]:
    if number > 999_999:
        raise ValueError(f"archive number {number} has more than six digits")
    text = "\n".join(US_HEAD + xml + "\n" + US_HEAD + "<sequence-cwu>no patent</sequence-cwu>" for _, xml in documents)
    return f"ipg{number:06d}_r1.zip", _zip([("all.xml", text.encode()), ("notes.txt", b"-")])


def _us_file(number: int, documents: list[tuple[str, str]]) -> tuple[str, bytes]:
    return f"part{number:06d}.xml", "\n".join(US_HEAD + xml for _, xml in documents).encode()


def _writer(folder: str, make, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        task, tasks = context.partitionId(), int(context.getLocalProperty("patloom.tasks"))
        pending: list[tuple[str, str]] = []
        written = 0

        def flush() -> None:
            nonlocal written
            name, content = make(task + written * tasks, pending)
            _write(f"{folder}/{name}", content)
            pending.clear()
            written += 1

        for batch in batches:
            for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                pending.append(row)
                if len(pending) == size:
                    flush()
        if pending:
            flush()
        yield pa.RecordBatch.from_pydict({"archives": pa.array([written], pa.int64())})

    return run


def write_archives(documents: DataFrame, folder: str, kind: str, tasks: int) -> str:
    """Write (name, xml) rows, which lie in so many tasks, as archives of a kind: ep, us, or loose US files."""
    make = {"ep": _ep_archive, "us": _us_archive, "file": _us_file}[kind]
    context = documents.sparkSession.sparkContext
    context.setLocalProperty("patloom.tasks", str(tasks))
    # Larger archives where there would be more of them than names.
    size = max(DOCUMENTS_PER_ARCHIVE, -(-documents.count() // (MOST_ARCHIVES // 2)))
    documents.select("name", "xml").mapInArrow(_writer(folder, make, size), "archives bigint").agg(F.sum("archives")).collect()
    return folder


def copy_archives(files: DataFrame, folder: str, keep: float = 1.0) -> None:
    """Copy files (path) to a folder, or only the first part of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with _open(path) as opened:
                    content = opened.read()
                _write(f"{folder}/{path.rsplit('/', 1)[1]}", content[: int(len(content) * keep)])
            yield pa.RecordBatch.from_pydict({"copied": pa.array([batch.num_rows], pa.int64())})

    files.select("path").mapInArrow(run, "copied bigint").agg(F.sum("copied")).collect()


def ep_archive_blobs(documents: DataFrame) -> DataFrame:
    """Each row (name, xml) as the bytes of a nested archive of its own: (path, content)."""

    @F.arrow_udf("binary")
    def blob(names: pa.Array, xmls: pa.Array) -> pa.Array:
        pairs = zip(names.to_pylist(), xmls.to_pylist())
        return pa.array([_nested([pair], tar=len(pair[0]) % 2 == 1) for pair in pairs], pa.binary())

    ending = F.when(F.length("name") % 2 == 1, ".tar").otherwise(".zip")
    return documents.select(F.concat("name", ending).alias("path"), blob("name", "xml").alias("content"))
