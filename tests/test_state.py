"""What streams and manifests remember: nothing lost between streams, no archive read for ever."""

import re

import pytest
from archives import ep_xml, zipped
from pyspark.sql import functions as F
from test_jobs import name, us_doc

from patloom.plans import us
from patloom.plans.ingest import DONE, GIVEN_UP, ingest_archives
from patloom.sources.files import read_weekly
from patloom.streaming.weekly import archive_stream, insert_ep_stream


def week(folder, number, *documents, bad=()):
    entries = {f"EP{n}.xml": ep_xml(n) for n in documents} | {f"b{n}.xml": b"<d id='x'" for n in bad}
    (folder / name(number)).write_bytes(zipped({"DOC/a.zip": zipped(entries)}))


def damaged(folder, number):
    """An archive with one entry that cannot be unpacked, and one that can."""
    inner = bytearray(zipped({"EP1.xml": ep_xml(1), "EP2.xml": ep_xml(2) * 50}))
    inner[inner.find(b"EP2.xml") + 20] ^= 255
    (folder / name(number)).write_bytes(zipped({"DOC/a.zip": bytes(inner)}))


def test_streams_share_a_quarantine(spark, tmp_path):
    one, two = tmp_path / "one", tmp_path / "two"
    for at, folder in enumerate((one, two)):
        folder.mkdir()
        week(folder, at + 1, at + 1, bad=[at + 1])
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")

    def run(folder, check):
        insert_ep_stream(archive_stream(spark, str(folder)), out, bad, str(tmp_path / check)).awaitTermination()
        return sorted(r.entry for r in spark.read.parquet(bad).collect())

    assert run(one, "check1") == ["b1.xml"]
    assert run(two, "check2") == ["b1.xml", "b2.xml"]
    assert run(one, "check1") == ["b1.xml", "b2.xml"]  # nothing new, nothing lost
    week(one, 3, 7, bad=[3])
    assert run(one, "check1") == ["b1.xml", "b2.xml", "b3.xml"]
    assert sorted(r.doc_id for r in spark.read.parquet(out).collect()) == ["EP1", "EP2", "EP7"]
    # Of each stream one batch is staged, the last.
    assert spark.read.option("recursiveFileLookup", "true").parquet(bad + "-staged").filter("error IS NOT NULL").count() == 2


def test_a_batch_without_archives_takes_nothing_of_another_run(spark, tmp_path):
    source, empty = tmp_path / "source", tmp_path / "empty"
    source.mkdir(), empty.mkdir()
    week(source, 1, 1)
    (empty / "note.txt").write_bytes(b"x")
    insert_ep_stream(archive_stream(spark, str(source)), str(tmp_path / "a"), str(tmp_path / "bad"), str(tmp_path / "c1")).awaitTermination()
    insert_ep_stream(archive_stream(spark, str(empty)), str(tmp_path / "b"), str(tmp_path / "bad"), str(tmp_path / "c2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "a")).count() == 1 and spark.read.parquet(str(tmp_path / "b")).count() == 0


def test_one_bad_entry_is_tried_so_many_times(spark, tmp_path):
    source = tmp_path / "source"
    source.mkdir()
    damaged(source, 1)
    week(source, 2, 5)
    paths = [str(tmp_path / part) for part in ("source", "raw", "manifest")]
    states, written = [], set()
    for _ in range(5):
        ingest_archives(spark, *paths)
        states.append(sorted((r.file_name, r.state, r.tries) for r in spark.read.parquet(paths[2]).collect()))
        written.add(frozenset(p.name for p in (tmp_path / "raw" / "year=2024" / "week=01").glob("*.parquet")))
        assert sorted((r.entry, r.error is None) for r in read_weekly(spark, paths[1]).collect()) == [("EP1.xml", True), ("EP2.xml", False), ("EP5.xml", True)]
    assert states[0] == states[1] == [(name(2), DONE, None)]
    assert states[2:] == [[(name(1), GIVEN_UP, 3), (name(2), DONE, None)]] * 3
    assert len(written) == 3  # the week was written by the first three runs only
    reason = spark.read.parquet(paths[2]).filter(F.col("state") == GIVEN_UP).first().reason
    assert "rror" in reason
    week(source, 1, 1, 2, 3)  # another file in its place is another archive
    ingest_archives(spark, *paths)
    assert read_weekly(spark, paths[1]).filter("error IS NOT NULL").count() == 0
    assert spark.read.parquet(paths[2]).filter(F.col("state") == DONE).count() == 2


def test_only_the_weeks_of_pending_archives_are_looked_at(spark, tmp_path):
    from patloom.plans.ingest import _failed, named_archives
    from patloom.sources.archives import list_files

    source = tmp_path / "source"
    source.mkdir()
    for number in range(1, 6):
        week(source, number, number, bad=[number])
    paths = [str(tmp_path / part) for part in ("source", "raw", "manifest")]
    ingest_archives(spark, *paths)
    archives = named_archives(list_files(spark, paths[0])).filter("week = '03'")
    plan = _failed(spark, archives, paths[1])._jdf.queryExecution().executedPlan().toString()
    filters = re.sub(r"#\d+", "", plan[plan.index("PartitionFilters") :].split("]")[0])
    assert "(year = 2024)" in filters and "(week = 03)" in filters


@pytest.mark.parametrize("tries", [1, 2])
def test_a_broken_us_archive_is_given_up(spark, tmp_path, tries):
    source = tmp_path / "source"
    source.mkdir()
    paths = [str(tmp_path / part) for part in ("source", "out", "manifest")]
    (source / "ipg050104.zip").write_bytes(b"broken")
    (source / "ipg050111.zip").write_bytes(zipped({"1.xml": us_doc("A")}))
    for run in range(1, 4):
        us.write_new_archives(spark, *paths, most_tries=tries)
        states = {r.file_name: r.state for r in spark.read.parquet(paths[2]).collect()}
        assert states == {"ipg050111.zip": DONE} | ({"ipg050104.zip": GIVEN_UP} if run >= tries else {})


@pytest.mark.parametrize("kind", ["ArrowInvalid", "ArrowNotImplementedError"])
def test_faults_of_a_file_system_are_no_content(tmp_path, monkeypatch, kind):
    import pyarrow as pa

    from patloom.sources import archives

    week(tmp_path, 1, 1)
    problem = getattr(pa, kind)("lost")
    monkeypatch.setattr(archives._Outer, "members", lambda self: (_ for _ in ()).throw(problem))
    batch = pa.RecordBatch.from_pydict({"path": [str(tmp_path / name(1))]})
    with pytest.raises(pa.ArrowException, match="lost"):
        list(archives._list_members(True)(iter([batch])))


def test_the_latest_of_a_catalog_is_read_once(spark, tmp_path):
    from patloom.plans.ingest import ingest_latest

    source = tmp_path / "source"
    source.mkdir()
    paths = [str(tmp_path / part) for part in ("source", "raw", "manifest")]
    for number in (1, 2, 3):
        week(source, number, number)
    listed = [(0, "note.pdf", "31.12.2024 10:00"), (1, name(2), "09.01.2024 14:00"), (2, name(3), "no time"), (3, name(1), "02.01.2024 14:00"), (4, name(4), "10.01.2024 08:00")]
    catalog = spark.createDataFrame(listed, "pos int, file_name string, published_at string")
    read = lambda: sorted(r.archive for r in read_weekly(spark, paths[1]).collect())
    assert ingest_latest(spark, catalog.filter("pos < 4"), *paths) == name(2) and read() == [name(2)]
    assert ingest_latest(spark, catalog.filter("pos < 4"), *paths) == name(2) and spark.read.parquet(paths[2]).count() == 1
    assert ingest_latest(spark, catalog, *paths) == name(4) and read() == [name(2)]  # not there yet
    week(source, 4, 4)
    assert ingest_latest(spark, catalog, *paths) == name(4) and read() == [name(2), name(4)]
    assert ingest_latest(spark, catalog.limit(0), *paths) is None
