"""One long entry of an archive over many tasks."""

import io
import random
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from patloom.functions.us import decode_text, split_documents
from patloom.sources import restart
from patloom.sources.archives import index_flat, list_files, read_flat, read_flat_documents

HEAD = '<?xml version="1.0"?>\n<!DOCTYPE us-patent-grant SYSTEM "grant.dtd" [ ]>\n'
WORDS = [f"word{i * i}é" for i in range(3000)]


def entry(seed, documents, other=""):
    rng, out = random.Random(seed), []
    for i in range(documents):
        body = " ".join(rng.choice(WORDS) for _ in range(rng.choice([3, 40, 400])))
        out.append(f'{HEAD}<us-patent-grant id="{i}">{body}</us-patent-grant>\n')
        if i % 7 == 0:
            out.append("<stray>no document</us-patent-grant>" + other)
    return "".join(out)


def archive(path, entries, kind=zipfile.ZIP_DEFLATED, level=6):
    with zipfile.ZipFile(path, "w", kind, compresslevel=level) as out:
        for name, content in entries.items():
            out.writestr(name, content)


def rows(df):
    return sorted((r.archive, r.entry, r.doc_pos, r.xml) for r in df.collect())


@pytest.mark.parametrize("level", [1, 6, 9])
def test_points_lead_on(level):
    data = entry(level, 1500).encode()
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    packed = packer.compress(data) + packer.flush()
    read = lambda at, n: packed[at : at + n]
    pieces = list(restart.unpacked(read, len(packed), 50_000))
    points = [point for _, point in pieces if point]
    assert b"".join(piece for piece, _ in pieces) == data and len(points) > 2
    assert any(point.bit % 8 for point in points)
    for point in points:
        assert b"".join(restart.resumed(read, len(packed), point)) == data[point.out :]
    with pytest.raises(EOFError):
        list(restart.unpacked(lambda at, n: packed[:90_000][at : at + n], len(packed)))


@pytest.mark.parametrize("encoding", ["utf-8", "ISO-8859-1"])
def test_slices_give_the_same_documents(spark, tmp_path, encoding):
    archive(tmp_path / "ipg240102.zip", {"one.xml": entry(1, 2500).encode(encoding), "two.xml": entry(2, 30).encode(encoding), "empty.xml": b""})
    archive(tmp_path / "ipg240109.zip", {"stored.xml": entry(3, 300).encode(encoding)}, zipfile.ZIP_STORED)
    files = list_files(spark, str(tmp_path))
    slices = index_flat(files, span=60_000)
    assert slices.filter("entry = 'one.xml'").count() > 4
    whole = split_documents(read_flat(files).select("archive", "entry", decode_text(F.col("content")).alias("text")))
    got = rows(read_flat_documents(files, span=60_000))
    assert got == rows(whole) and len(got) == 2830


@pytest.mark.filterwarnings("ignore:Duplicate name")
def test_short_entries_are_read_once_and_names_may_repeat(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "ipg240102.zip", "w", zipfile.ZIP_DEFLATED) as out:
        for seed in (1, 2):
            out.writestr("same.xml", entry(seed, 4))
    files = list_files(spark, str(tmp_path))
    assert index_flat(files).filter("at IS NULL AND window IS NULL").count() == 2
    got = [r.xml for r in read_flat_documents(files).collect()]
    assert len(got) == 8 and len(set(got)) == 8


def test_one_archive_is_read_by_many_tasks(spark, tmp_path):
    archive(tmp_path / "ipg240102.zip", {"one.xml": entry(1, 3000).encode()})
    documents = read_flat_documents(list_files(spark, str(tmp_path)), span=60_000)
    tasks = documents.select(F.spark_partition_id().alias("task")).distinct().count()
    assert tasks == spark.sparkContext.defaultParallelism
    # What is shuffled are the slices, not the documents.
    plan = documents._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and plan.index("MapInArrow") < plan.index("Exchange")


def test_damage_is_a_row_and_other_entries_are_read(spark, tmp_path):
    buffer = io.BytesIO()
    archive(buffer, {"bad.xml": entry(1, 800).encode(), "good.xml": entry(2, 3).encode()})
    blob = bytearray(buffer.getvalue())
    blob[20_000] ^= 255
    (tmp_path / "ipg240102.zip").write_bytes(blob)
    got = read_flat_documents(list_files(spark, str(tmp_path)), span=10_000).collect()
    assert [(r.entry, r.doc_pos) for r in got if r.error] == [("bad.xml", None)]
    assert [r.doc_pos for r in sorted(got, key=lambda r: r.doc_pos or 0) if not r.error] == [0, 1, 2]
