"""Failures, repairs and reruns: nothing lost, nothing stale."""

import gzip
import io
import zipfile

import pytest
from archives import ep_xml, tarred, zipped
from pyspark.sql import functions as F
from test_jobs import name, us_doc

from patloom.functions.ep import parse_ep
from patloom.functions.lemmas import lemmatise
from patloom.plans import us
from patloom.plans.ep import BAD, GOOD, embedded, insert_records, write_records
from patloom.plans.extract import run_extract
from patloom.plans.ingest import ingest_archives, left_out, named_archives, one_per_week
from patloom.queries import build
from patloom.schemas import EP_INSERT_COLUMNS
from patloom.sources.archives import explode_nested, list_files, read_nested
from patloom.sources.files import read_weekly
from patloom.streaming.weekly import archive_stream, insert_ep_stream


@pytest.mark.parametrize("bound", [0, 100])
def test_lemmas_repeat_and_keys_are_null(spark, bound):
    lemmas = spark.createDataFrame([("dogs", "dogz"), ("dogs", "dog"), ("cats", "cat"), ("x", None), ("is", "is"), ("is", "be")], "word string, lemma string")
    df = spark.createDataFrame([(1, ["dogs", "is"]), (None, ["cats"]), (None, ["dogs", "x"]), (1, ["cats"]), (2, None)], "id int, tokens array<string>")
    got = sorted((r.tokens for r in lemmatise(df, "tokens", lemmas, ["id"], broadcast_rows=bound).collect()), key=repr)
    assert got == sorted([["dog", "be"], ["cat"], ["dog", "x"], ["cat"], None], key=repr)


def test_archive_numbers_out_of_range_fail():
    with pytest.raises(ValueError):
        build._ep_archive(53 * 8100, [])
    with pytest.raises(ValueError):
        build._us_archive(1_000_000, [])


def test_truncated_replaced_and_read(spark, tmp_path):
    source = tmp_path / "source"
    source.mkdir()
    whole = zipped({"DOC/a.zip": zipped({"EP1.xml": ep_xml(1)})})
    (source / name(1)).write_bytes(whole[: len(whole) // 2])
    paths = [str(tmp_path / part) for part in ("source", "raw", "manifest")]
    ingest_archives(spark, *paths)
    assert [r.entry for r in read_weekly(spark, paths[1]).collect()] == [None]
    assert spark.read.parquet(paths[2]).count() == 0
    (source / name(1)).write_bytes(whole)
    for _ in range(2):
        ingest_archives(spark, *paths)
        assert [(r.entry, r.error) for r in read_weekly(spark, paths[1]).collect()] == [("EP1.xml", None)]
        assert spark.read.parquet(paths[2]).count() == 1


def test_replaced_archive_is_read_again(spark, tmp_path):
    source = tmp_path / "source"
    source.mkdir()
    paths = [str(tmp_path / part) for part in ("source", "raw", "manifest")]
    for number in (1, 22):
        (source / name(1)).write_bytes(zipped({"DOC/a.zip": zipped({f"EP{number}.xml": ep_xml(number)})}))
        ingest_archives(spark, *paths)
        assert [r.entry for r in read_weekly(spark, paths[1]).collect()] == [f"EP{number}.xml"]


def test_file_system_error_fails_the_job(spark, tmp_path):
    files = spark.createDataFrame([(str(tmp_path / name(1)), 10)], "path string, length bigint")
    with pytest.raises(Exception, match="FileNotFoundError"):
        read_nested(files).collect()


def test_us_broken_then_whole(spark, tmp_path):
    source = tmp_path / "source"
    source.mkdir()
    paths = [str(tmp_path / part) for part in ("source", "out", "manifest")]
    (source / "ipg050104.zip").write_bytes(b"broken")
    us.write_new_archives(spark, *paths)
    assert spark.read.parquet(paths[2]).count() == 0
    (source / "ipg050104.zip").write_bytes(zipped({"1.xml": us_doc("A")}))
    us.write_new_archives(spark, *paths)
    got = us.read_us_records(spark, paths[1]).collect()
    assert [(r.status, r.year, r.date_part, r.archive, r.title) for r in got] == [(GOOD, "2005", "050104", "ipg050104.zip", "t")]
    assert spark.read.parquet(paths[2]).count() == 1


BROKEN = b"<d id='x'"


@pytest.mark.parametrize("order", [(BROKEN, ep_xml(1)), (ep_xml(1), BROKEN)])
def test_rerun_leaves_no_stale_rows(spark, tmp_path, order):
    out = str(tmp_path / "out")
    for xml in order:
        df = spark.createDataFrame([("a", "m", "e.xml", bytearray(xml), None, "2024", "02")], "archive string, member string, entry string, content binary, error string, year string, week string")
        write_records(df, out)
        rows = read_weekly(spark, out).collect()
        assert [(r.status, r.week) for r in rows] == [(BAD if xml == BROKEN else GOOD, "02")]


def test_every_fitting_archive_and_the_rest_reported(spark, tmp_path):
    stem = "EPRTBJV20240000{:02d}001{:03d}"
    names = [stem.format(3, 1) + ".ZIP", stem.format(4, 2) + ".zip", stem.format(5, 1) + ".zip", stem.format(5, 1) + ".tar", "OTHER.zip"]
    for number, one in enumerate(names):
        content = {"DOC/a.zip": zipped({f"EP{number}.xml": ep_xml(number)})}
        (tmp_path / one).write_bytes(tarred(content) if one.endswith("tar") else zipped(content))
    archives = named_archives(list_files(spark, str(tmp_path)))
    assert sorted(r.file_name for r in one_per_week(archives).collect()) == sorted(names[:3])
    assert sorted(r.file_name for r in left_out(archives).collect()) == sorted(names[3:])
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    insert_ep_stream(archive_stream(spark, str(tmp_path)), out, bad, str(tmp_path / "check")).awaitTermination()
    assert sorted(r.doc_id for r in spark.read.parquet(out).collect()) == ["EP0", "EP1", "EP2"]


def odd_archives():
    """Bad members and entries among good ones, repeated names, a compressed tar."""
    good = zipped({"EP1.xml": ep_xml(1)})
    bad_entry = bytearray(zipped({"EP2.xml": ep_xml(2), "EP3.xml": ep_xml(3)}))
    at = bad_entry.find(b"EP2.xml") + 12
    bad_entry[at : at + 8] = b"\xff" * 8
    cut = zipped({"EP8.xml": ep_xml(8)})
    twice = io.BytesIO()
    with zipfile.ZipFile(twice, "w") as outer:
        outer.writestr("a.zip", zipped({"EP4.xml": ep_xml(4)}))
        with pytest.warns(UserWarning):
            outer.writestr("a.zip", zipped({"EP5.xml": ep_xml(5)}))
    return {
        "one.zip": zipped({"a.zip": cut[:30] + b"\0" * 40 + cut[30:], "b.zip": bytes(bad_entry), "c.zip": good}),
        "two.zip": twice.getvalue(),
        "three.tar": gzip.compress(tarred({"a.zip": good, "b.zip": zipped({"EP6.xml": ep_xml(6)})})),
    }


def test_both_ways_read_odd_archives_alike(spark, tmp_path):
    made = odd_archives()
    for one, content in made.items():
        (tmp_path / one).write_bytes(content)
    columns = ["archive", "member", "entry", F.col("error").isNotNull().alias("bad")]
    read = sorted(map(tuple, read_nested(list_files(spark, str(tmp_path))).select(*columns).collect()), key=repr)
    blobs = spark.createDataFrame([(one, bytearray(content)) for one, content in made.items()], "path string, content binary")
    assert read == sorted(map(tuple, explode_nested(blobs).select(*columns).collect()), key=repr)
    good = {(archive, entry) for archive, _, entry, bad in read if not bad}
    assert good >= {("one.zip", "EP1.xml"), ("one.zip", "EP3.xml"), ("two.zip", "EP4.xml"), ("two.zip", "EP5.xml"), ("three.tar", "EP1.xml"), ("three.tar", "EP6.xml")}
    assert ("one.zip", "b.zip", "EP2.xml", True) in read


def test_model_never_sees_a_bad_row(spark):
    rows = [(None, "good title"), ("ParseError", "bad title")]
    df = spark.createDataFrame(rows, "error string, title_en string")
    for column in ("title_de", "title_fr", "abstract", "description", "claims", "applicants", "inventors", "doc_id"):
        df = df.withColumn(column, F.lit(None).cast("string"))

    def model():
        def encode(texts):
            assert not any("bad" in text for text in texts)
            return [[1.0] for _ in texts]

        return encode

    got = {r.error: r.embedding for r in embedded(df, model, width=1).collect()}
    assert got == {None: [1.0], "ParseError": [0.0]}


def test_emptied_extract_leaves_nothing_behind(spark, tmp_path):
    source, out = str(tmp_path / "source"), str(tmp_path / "out")
    spark.createDataFrame([("20220105", "2022"), ("20230105", "2023")], "date_publication string, y string").write.partitionBy("y").parquet(source)
    assert run_extract(spark, source, out, "20220101", "20221231", year="y") == 1
    assert run_extract(spark, source, out, "19990101", "19991231") == 0
    assert spark.read.parquet(out).count() == 0


def test_insert_keeps_its_columns(spark, tmp_path):
    df = spark.createDataFrame([("a", "m", "e.xml", bytearray(ep_xml(1)), None), ("a", "m", "f.xml", bytearray(BROKEN), None)], "archive string, member string, entry string, content binary, error string")
    for _ in range(2):
        insert_records(parse_ep(df), str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.columns == list(EP_INSERT_COLUMNS) and [r.doc_id for r in back.collect()] == ["EP1"]
