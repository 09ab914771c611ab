"""The archive format: the same rows as the reader, in batch and as a stream, and only the files asked for."""

import os

import pytest
from archives import ep_xml, tarred, zipped
from pyspark.sql import functions as F
from test_jobs import name

from patloom.functions.ep import parse_ep
from patloom.sources import archive_format
from patloom.sources.archives import list_files, read_nested

COLUMNS = ("archive", "member", "entry", "content", "error")


@pytest.fixture
def folder(spark, tmp_path):
    archive_format.register(spark)
    inner = lambda *numbers: zipped({f"EP{n}.xml": ep_xml(n) for n in numbers} | {"TOC.xml": b"x"})
    (tmp_path / "deep").mkdir()
    (tmp_path / name(1)).write_bytes(zipped({f"DOC/{i}.zip": inner(10 * i, 10 * i + 1) for i in range(1, 9)} | {"INDEX/x.zip": inner(999)}))
    (tmp_path / "deep" / name(2).replace(".zip", ".tar")).write_bytes(tarred({"DOC/a.zip": inner(201), "b.zip": inner(202)}))
    (tmp_path / name(3)).write_bytes(b"no archive")
    (tmp_path / "other.ZIP").write_bytes(zipped({"a.zip": inner(301), "note.txt": b"n"}))
    (tmp_path / "readme.txt").write_bytes(b"no")
    return tmp_path


def rows(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("size", [50, 700, 1 << 20])
def test_same_rows_as_the_reader(spark, folder, size):
    read = spark.read.format("patent_archive").option("sliceBytes", size).load(str(folder))
    files = list_files(spark, str(folder)).filter(F.lower("path").rlike(r"\.(zip|tar)$"))
    assert rows(read) == rows(read_nested(files)) and read.count() == 19
    loose = spark.read.format("patent_archive").option("docRule", "false").load(str(folder))
    assert rows(loose) == rows(read_nested(files, doc_rule=False))
    if size == 50:
        assert read.rdd.getNumPartitions() > 10


def test_filters_choose_the_files(spark, folder):
    load = lambda: spark.read.format("patent_archive").option("pushFilters", "true").load(str(folder))
    read = load()
    weeks = {r.archive: r.week for r in read.select("archive", "week").distinct().collect()}
    assert sorted(weeks.values(), key=repr) == sorted(["01", "02", "03", None], key=repr)
    for condition in ("week = '02'", "week > '01' AND week < '03'", "week IN ('02')", "archive LIKE '%01001.tar'", "week <=> '02'", "NOT (week = '01') AND week <> '03'", "week IS NULL"):
        some = load().filter(condition)
        assert some.rdd.getNumPartitions() == 1  # one file, one slice
        assert rows(some) == rows(load().filter(F.expr(condition.replace("week", "concat(week, '')").replace("archive", "concat(archive, '')"))))
    assert load().filter("week = '02' AND entry = 'EP201.xml'").count() == 1
    assert load().filter("year = '1999'").count() == 0


def test_weeks_asked_for_and_two_filters_of_one_load(spark, folder):
    reader = lambda: spark.read.format("patent_archive")
    some = reader().option("fromWeek", "202402").option("toWeek", "202402").load(str(folder))
    assert some.rdd.getNumPartitions() == 1 and {r.week for r in some.collect()} == {"02"}
    assert {r.week for r in reader().option("toWeek", "202401").load(str(folder)).collect()} == {"01"}
    assert {r.week for r in reader().option("fromWeek", "202402").load(str(folder)).collect()} == {"02", "03"}
    whole = reader().load(str(folder))
    both = whole.filter("week = '02'").unionByName(whole.filter("week = '01'"))
    assert {r.week for r in both.collect()} == {"01", "02"}


def test_stream_gives_each_archive_once(spark, folder, tmp_path_factory):
    out = tmp_path_factory.mktemp("out")
    (folder / name(3)).unlink()

    def run():
        stream = spark.readStream.format("patent_archive").load(str(folder))
        query = parse_ep(stream).writeStream.format("parquet").option("checkpointLocation", str(out / "check")).start(str(out / "rows"))
        query.processAllAvailable()
        query.stop()
        return sorted(r.doc_id or "" for r in spark.read.parquet(str(out / "rows")).select("doc_id").collect())

    first = run()
    assert len(first) == 18 and run() == first
    (folder / name(9)).write_bytes(zipped({"DOC/a.zip": zipped({"EP901.xml": ep_xml(901)})}))
    os.utime(folder / name(9), (2e9, 2e9))
    assert run() == sorted([*first, "EP901"])
