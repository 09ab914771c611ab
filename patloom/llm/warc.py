"""WARC archives (.warc.gz), written with an index and read back by coalesced byte ranges.

Records are compressed one by one where the pages are read, as usual for WARC, so that only compressed
records move, once, to the archive they belong to. Which pages revisit another is settled on narrow
rows (id, URL, payload size and digest). The writer of an archive counts offsets as it goes, and its index
rows (file, offset, length, URL, digest) are a Spark table: they are committed only for tasks that
ended well, and name the file of that attempt, so a lost executor leaves at most a file that no index
names. Readers start from the index: they take sorted ranges of an archive, near ones in one read.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patloom.llm.registry import query, table, written
from patloom.session import shared_folder
from patloom.sources.archives import _open, located

# ---- Fixed values: the WARC 1.1 format ----------------------------------------------------
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# -------------------------------------------------------------------------------------------

MIN_REVISIT_BYTES = 100
ARCHIVE_BYTES = 64 << 20  # payload bytes of an archive
SLICE_BYTES = 8 << 20  # records that start in one slice of an archive are read by one task
GAP_BYTES = 64 << 10  # ranges at most so far apart are read at once
READ_BYTES = 4 << 20  # size up to which ranges are put together
BATCH_BYTES = 16 << 20

KEY = ("page_id", "url", "digest")
INDEX = "path string, offset bigint, length bigint, page_id bigint, url string, digest string, record_type string, refers_to bigint"
RECORD = "page_id bigint, url string, record_type string, refers_to bigint, digest string, bytes bigint, payload binary"
ARROW = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}


def arrow_schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, ARROW[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


def _shown(value) -> str:
    """A header value: empty for null, line breaks percent-encoded."""
    return "" if value is None else str(value).replace("\r", "%0D").replace("\n", "%0A")


def record(page_id, url, digest: str, payload: bytes | None, size: int, date: str, refers_to=None) -> bytes:
    """One record as a gzip member; without a payload it is a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    name = uuid.UUID(hashlib.md5(f"{_shown(page_id)}|{_shown(url)}|{digest}".encode()).hexdigest())
    fields = [
        ("WARC-Type", "response" if payload is not None else "revisit"),
        ("WARC-Record-ID", f"<urn:uuid:{name}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", _shown(url)),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("X-Page-ID", _shown(page_id)),
    ]
    if payload is None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("X-Refers-To-Page-ID", _shown(refers_to))]
    block = http + (payload or b"")
    head = "".join(f"{name}: {value}\r\n" for name, value in [*fields, ("Content-Length", len(block))])
    return gzip.compress(f"{VERSION}\r\n{head}\r\n".encode() + block + b"\r\n\r\n", mtime=0)


def parsed(data: bytes) -> dict:
    """What a record holds; `payload` is null for a revisit, `bytes` is the size of the full payload."""
    head, _, rest = gzip.decompress(data).partition(b"\r\n\r\n")
    fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
    if len(rest) != int(fields[b"Content-Length"]) + 4:
        raise ValueError(f"a record of {int(fields[b'Content-Length'])} bytes where {len(rest) - 4} are")
    http, _, payload = rest[:-4].partition(b"\r\n\r\n")
    number = lambda name: int(fields[name]) if fields.get(name) else None
    kind = fields[b"WARC-Type"].decode()
    return {
        "page_id": number(b"X-Page-ID"),
        "url": fields[b"WARC-Target-URI"].decode(),
        "record_type": kind,
        "refers_to": number(b"X-Refers-To-Page-ID"),
        "digest": fields[b"WARC-Payload-Digest"].decode().removeprefix("sha256:"),
        "bytes": int(re.search(rb"Content-Length: (\d+)", http)[1]),
        "payload": payload if kind == "response" else None,
    }


def _batches(rows: Iterator[dict], schema: pa.Schema, sized: str) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[sized] or b"") + 200
        if size > BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


PACKED = "page_id bigint, url string, digest string, bytes bigint, record binary"


def _pack(date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for page_id, url, html in _rows(batches):
                payload = (html or "").encode()
                digest = hashlib.sha256(payload).hexdigest()
                packed = record(page_id, url, digest, payload, len(payload), date)
                yield {"page_id": page_id, "url": url, "digest": digest, "bytes": len(payload), "record": packed}

        yield from _batches(rows(), arrow_schema(PACKED), "record")

    return run


def _write(folder: str, date: str):
    """Rows (shard, page_id, url, digest, bytes, refers_to, record) in order to archives; index rows out.

    Of one key the row that says what it revisits comes first; it has no record.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            filesystem, inside = located(folder)
            filesystem.create_dir(inside, recursive=True)
            out, at, key, first = None, None, None, None
            try:
                for shard, page_id, url, digest, size, refers_to, packed in _rows(batches):
                    if packed is None:
                        key, first = (page_id, url, digest), refers_to
                        continue
                    if shard != at:
                        if out:
                            out.close()
                        at, name = shard, f"{shard:06d}-{uuid.uuid4().hex}.warc.gz"
                        out = filesystem.open_output_stream(f"{inside}/{name}", compression=None)
                    revisit = key == (page_id, url, digest)
                    if revisit:
                        packed = record(page_id, url, digest, None, size, date, first)
                    yield {
                        "path": f"{folder}/{name}", "offset": out.tell(), "length": len(packed), "page_id": page_id, "url": url,
                        "digest": digest, "record_type": "revisit" if revisit else "response", "refers_to": first if revisit else None,
                    }
                    out.write(packed)
            finally:
                if out:
                    out.close()

        yield from _batches(rows(), arrow_schema(INDEX), "url")

    return run


def revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(page_id, url, digest, refers_to) of the pages whose payload an earlier page has.

    Of equal payloads of at least `min_bytes` the smallest page id is the response and the others
    revisit it. A null payload is empty. Rows that repeat the response's id and payload are responses
    as well; where all ids of equal payloads are null, so are all of these. Equal payloads are counted in
    each task before they move; one that a third of all pages have is a skewed join key of narrow
    rows, which Spark splits: the responses are written first, so that both sides are shuffled for the join.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    narrow = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("n")
    ).filter(F.col("n") >= min_bytes)
    firsts = narrow.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("often"))
    firsts = written(firsts.filter("often > 1").select("digest", "refers_to"), "responses")
    met = narrow.join(firsts, "digest")
    later = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return met.filter(later).select(*KEY, "refers_to")


def write_archives(
    pages: DataFrame,
    path: str,
    index_path: str,
    archive_bytes: int = ARCHIVE_BYTES,
    min_bytes: int = MIN_REVISIT_BYTES,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write the archives under `path` and their index as Parquet.

    Takes page_id, url and html. The number of archives follows the bytes of all payloads; pages go to
    them by a hash of id, URL and digest. The date is a parameter, so that a task that runs again writes
    the same bytes. Records that agree in id, URL and payload are written as often as they come, with one
    record id. A page without a URL has an empty target.
    """
    total = pages.agg(F.sum(F.octet_length("html").cast("long") + 1024).alias("n")).first()["n"]
    shards = max(1, -(-(total or 0) // archive_bytes))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string"))
    bodies = rows.mapInArrow(_pack(date), PACKED).withColumn("refers_to", F.lit(None).cast("long"))
    told = revisits(rows, min_bytes).distinct().select(
        *KEY, F.lit(None).cast("long").alias("bytes"), F.lit(None).cast("binary").alias("record"), "refers_to"
    )
    met = bodies.unionByName(told).withColumn("shard", F.pmod(F.xxhash64(*KEY), F.lit(shards)).cast("long"))
    ordered = met.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard", *KEY, F.col("record").isNotNull())
    columns = ordered.select("shard", *KEY, "bytes", "refers_to", "record")
    columns.mapInArrow(_write(path, date), INDEX).write.parquet(index_path)


def read_index(spark: SparkSession, index_path: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(index_path)


def _ranges(rows: Iterator[tuple[str, int, int]]) -> Iterator[list[tuple[str, int, int]]]:
    """Sorted (path, offset, length), put together where they lie near each other."""
    run: list[tuple[str, int, int]] = []
    for path, offset, length in rows:
        near = run and run[-1][0] == path and offset - sum(run[-1][1:]) <= GAP_BYTES
        if run and not (near and offset + length - run[0][1] <= READ_BYTES):
            yield run
            run = []
        run.append((path, offset, length))
    if run:
        yield run


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        opened, name = None, None
        for run in _ranges(_rows(batches)):
            if run[0][0] != name:
                if opened:
                    opened.close()
                name = run[0][0]
                opened = _open(name)
            start = run[0][1]
            data = opened.read_at(sum(run[-1][1:]) - start, start)
            for _, offset, length in run:
                yield parsed(data[offset - start : offset - start + length])

    yield from _batches(rows(), arrow_schema(RECORD), "payload")


def read_records(selected: DataFrame) -> DataFrame:
    """The records that the selected index rows (path, offset, length) name.

    Each task reads slices of archives in order of offset. A revisit has no payload. Any error in reading
    fails the task, so that Spark tries again.
    """
    size = selected.agg(F.sum("length").alias("n")).first()["n"] or 0
    tasks = max(-(-size // SLICE_BYTES), selected.sparkSession.sparkContext.defaultParallelism)
    slices = selected.select("path", "offset", "length", F.floor(F.col("offset") / SLICE_BYTES).alias("slice"))
    spread = slices.repartition(tasks, "path", "slice").sortWithinPartitions("path", "offset")
    return spread.select("path", "offset", "length").mapInArrow(_read, RECORD)


FACTS = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and digest of each record, taken from its payload where it has one."""

    def rows():
        for page_id, _, kind, refers_to, digest, size, payload in _rows(batches):
            if payload is not None and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                raise ValueError(f"the payload of page {page_id} differs from what its record says")
            yield {"page_id": page_id, "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": refers_to}

    yield from _batches(rows(), arrow_schema(FACTS), "payload_digest")


SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS n, sha256(payload) AS digest FROM p),
f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) END AS first FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
    CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN first <> page_id THEN first END AS refers_to
FROM f
"""


@query("op4_warc", SQL)
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records, written and read back."""
    path, index_path = shared_folder(spark, "warc"), shared_folder(spark, "warc-index")
    write_archives(table(spark, sf_dir, "pages"), path, index_path)
    return read_records(read_index(spark, index_path)).mapInArrow(_facts, FACTS)
