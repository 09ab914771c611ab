"""Whole jobs and streams: archives to tables, and their reruns."""

import pytest
from archives import ep_xml, tarred, zipped
from pyspark.sql import functions as F

from patloom.plans import us
from patloom.plans.ep import BAD, GOOD, embedded, write_records
from patloom.plans.ingest import ingest_archives, named_archives, one_per_week, unfitting_names
from patloom.sources.archives import list_files
from patloom.sources.files import read_weekly
from patloom.streaming.weekly import archive_stream, insert_ep_stream, write_us_stream

HEAD = '<?xml version="1.0"?>\n<!DOCTYPE us-patent-grant SYSTEM "x.dtd">\n'


def us_doc(number, title="t"):
    reference = "" if number is None else f"<document-id><doc-number>{number}</doc-number></document-id>"
    return f"{HEAD}<us-patent-grant><publication-reference>{reference}</publication-reference><invention-title>{title}</invention-title></us-patent-grant>"


def name(week, ending="zip"):
    return f"EPRTBJV2024{week:08d}".replace(f"{week:08d}", f"0000{week:02d}001001") + "." + ending


@pytest.fixture
def folder(tmp_path):
    source = tmp_path / "source"
    source.mkdir()
    inner = zipped({"EP1.xml": ep_xml(1), "EP2.xml": ep_xml(2), "bad.xml": b"<d id='x'", "TOC.xml": b"<toc/>"})
    (source / name(1)).write_bytes(zipped({"DOC/a.zip": inner}))
    (source / name(1, "tar")).write_bytes(tarred({"DOC/a.zip": zipped({"EP9.xml": ep_xml(9)})}))
    (source / name(2, "tar")).write_bytes(tarred({"DOC/b.zip": zipped({"EP1.xml": ep_xml(1, lang="de"), "EP3.xml": ep_xml(3)})}))
    (source / "OTHER.zip").write_bytes(zipped({"x.zip": inner}))
    return tmp_path


def test_ingest_takes_each_week_once(spark, folder):
    source, raw, manifest = (str(folder / part) for part in ("source", "raw", "manifest"))
    ingest_archives(spark, source, raw, manifest)
    ingest_archives(spark, source, raw, manifest)
    got = sorted((r.year, r.week, r.archive, r.entry) for r in read_weekly(spark, raw).collect())
    assert got == [
        ("2024", "01", name(1), "EP1.xml"),
        ("2024", "01", name(1), "EP2.xml"),
        ("2024", "01", name(1), "bad.xml"),
        ("2024", "02", name(2, "tar"), "EP1.xml"),
        ("2024", "02", name(2, "tar"), "EP3.xml"),
    ]
    assert sorted(r.file_name for r in spark.read.parquet(manifest).collect()) == [name(1), name(2, "tar")]
    (folder / "source" / name(3)).write_bytes(zipped({"c.zip": zipped({"EP4.xml": ep_xml(4)})}))
    ingest_archives(spark, source, raw, manifest)
    assert read_weekly(spark, raw).count() == 6 and spark.read.parquet(manifest).count() == 3


def test_names_that_do_not_fit_are_reported(spark, folder):
    archives = named_archives(list_files(spark, str(folder / "source")))
    assert [r.file_name for r in unfitting_names(archives).collect()] == ["OTHER.zip"]
    assert sorted(r.file_name for r in one_per_week(archives).collect()) == [name(1), name(2, "tar")]


def test_records_and_quarantine_in_one_write(spark, folder):
    source, raw, manifest, out = (str(folder / part) for part in ("source", "raw", "manifest", "out"))
    ingest_archives(spark, source, raw, manifest)

    def model():
        return lambda texts: [[float(len(text))] for text in texts]

    write_records(read_weekly(spark, raw), out, embed=lambda df: embedded(df, model, width=1))
    records = read_weekly(spark, out)
    good = records.filter(F.col("status") == GOOD)
    assert sorted((r.doc_id, r.title_en, r.week) for r in good.collect()) == [
        ("EP1", "T1", "01"),
        ("EP1", "T1", "02"),
        ("EP2", "T2", "01"),
        ("EP3", "T3", "02"),
    ]
    assert good.first().embedding == [float(len("title t1 abstract description applicants inventors"))]
    bad = records.filter(F.col("status") == BAD).collect()
    assert [(r.entry, bytes(r.bad_xml)) for r in bad] == [("bad.xml", b"<d id='x'")]
    assert bad[0].error.startswith("ParseError")


def test_ep_stream_inserts_once(spark, folder):
    source, out, bad = (str(folder / part) for part in ("source", "out", "bad"))

    def run(checkpoint):
        insert_ep_stream(archive_stream(spark, source, per_batch=1), out, bad, str(folder / checkpoint)).awaitTermination()
        return sorted((r.doc_id, r.lang) for r in spark.read.parquet(out).collect())

    first = run("one")
    assert [doc for doc, _ in first] == ["EP1", "EP2", "EP3", "EP9"]
    assert run("one") == first  # nothing new
    assert run("two") == first  # all again, nothing inserted
    (folder / "source" / name(4)).write_bytes(zipped({"c.zip": zipped({"EP1.xml": ep_xml(1), "EP5.xml": ep_xml(5)})}))
    assert [doc for doc, _ in run("one")] == ["EP1", "EP2", "EP3", "EP5", "EP9"]
    assert {r.entry for r in spark.read.parquet(bad).collect()} == {"bad.xml"}


def test_us_archives_and_stream(spark, tmp_path):
    source = tmp_path / "source"
    source.mkdir()
    many = us_doc("A") + us_doc("A", "second") + us_doc("B") + us_doc(None) + us_doc(None) + HEAD + "<us-patent-grant><a></us-patent-grant>"
    (source / "ipg240102.zip").write_bytes(zipped({"1.xml": many, "2.xml": us_doc("A", "third")}))
    (source / "ipg240102_r1.zip").write_bytes(zipped({"1.xml": us_doc("A", "revised")}))
    (source / "ipg240109.zip").write_bytes(b"broken")
    expected = [("240102", "A", "revised"), ("240102", "A", "t"), ("240102", "B", "t"), ("240102", None, "t")]

    def records(path, status=GOOD):
        df = spark.read.option("mergeSchema", "true").parquet(path).filter(F.col("status") == status)
        return sorted(((str(r.date_part), r.pub_ref_doc_number, r.title) for r in df.collect()), key=repr)

    us.write_archives(list_files(spark, str(source)), str(tmp_path / "out"))
    assert records(str(tmp_path / "out")) == sorted(expected, key=repr)
    assert len(records(str(tmp_path / "out"), BAD)) == 2  # one bad document, one bad archive
    for _ in range(2):
        stream = archive_stream(spark, str(source), glob="*.zip")
        write_us_stream(stream, str(tmp_path / "stream"), str(tmp_path / "check")).awaitTermination()
    assert records(str(tmp_path / "stream")) == sorted(expected, key=repr)


def test_us_job_has_one_shuffle_after_the_reading(spark, tmp_path):
    from patloom.functions.us import parse_us
    from patloom.sources.archives import read_flat_documents

    (tmp_path / "ipg240102.zip").write_bytes(zipped({"1.xml": us_doc("A")}))
    df = us.unique_records(parse_us(read_flat_documents(list_files(spark, str(tmp_path)), tasks=2)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "WindowGroupLimit" in plan


def test_us_manifest_knows_full_names(spark, tmp_path):
    source = tmp_path / "source"
    source.mkdir()
    (source / "ipg240102.zip").write_bytes(zipped({"1.xml": us_doc("A")}))
    (source / "readme.txt").write_bytes(b"-")
    paths = [str(tmp_path / part) for part in ("source", "out", "manifest")]
    us.write_new_archives(spark, *paths)
    (source / "ipg240102_r1.zip").write_bytes(zipped({"1.xml": us_doc("A", "revised")}))
    for _ in range(2):
        us.write_new_archives(spark, *paths)
        assert sorted(r.title for r in spark.read.parquet(paths[1]).collect()) == ["revised", "t"]
        names = sorted(r.file_name for r in spark.read.parquet(paths[2]).collect())
        assert names == ["ipg240102.zip", "ipg240102_r1.zip"]


def test_loose_files_of_a_week_to_records(spark, tmp_path):
    from patloom.sources.files import read_week_folders

    week = tmp_path / "2024" / "xml" / "2024_02"
    week.mkdir(parents=True)
    for number in (1, 2):
        (week / f"EP{number}.xml").write_bytes(ep_xml(number))
    (week / "TOC.xml").write_bytes(b"<toc/>")
    write_records(read_week_folders(spark, str(tmp_path / "2024")), str(tmp_path / "out"), balance=False)
    rows = read_weekly(spark, str(tmp_path / "out")).collect()
    assert sorted((r.doc_id, r.year, r.week, r.status) for r in rows) == [("EP1", "2024", "02", GOOD), ("EP2", "2024", "02", GOOD)]
