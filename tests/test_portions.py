"""Large inputs in portions: the disk holds little twice, and the rows are those of one run."""

import glob

import pyarrow.parquet as pq
import pytest
from archives import ep_xml, zipped
from pyspark.sql import functions as F
from test_jobs import name

from patloom.plans import ep
from patloom.plans.ep import BAD, GOOD, write_records
from patloom.sinks.keyed import files_of, insert_by_index, update_index
from patloom.sources.files import read_weekly
from patloom.streaming import weekly
from patloom.streaming.weekly import archive_stream, insert_ep_stream


def week(folder, number, *documents, bad=()):
    entries = {f"EP{n}.xml": ep_xml(n) for n in documents} | {f"b{n}.xml": b"<d id='x'" for n in bad}
    (folder / name(number)).write_bytes(zipped({"DOC/a.zip": zipped(entries)}))


@pytest.mark.parametrize("most, portions", [(0, 3), (1 << 30, 1)])
def test_a_stream_stages_some_archives_and_leaves_no_good_row_staged(spark, tmp_path, monkeypatch, most, portions):
    monkeypatch.setattr(weekly, "PORTION_BYTES", most)
    source, out, bad = tmp_path / "source", str(tmp_path / "out"), str(tmp_path / "bad")
    source.mkdir()
    week(source, 3, 1, 4)
    week(source, 1, 2, 3, bad=[1])
    week(source, 2, 1, 2, bad=[2, 3])
    seen = []

    def insert(rows, *more):
        seen.append({r.archive for r in rows.select("archive").collect()})
        insert_by_index(rows, *more)

    for check in ("one", "two"):  # the second stream starts from nothing and adds no row
        insert_ep_stream(archive_stream(spark, str(source)), out, bad, str(tmp_path / check), insert=insert).awaitTermination()
    assert len(seen) == 2 * portions and set().union(*seen) == {name(1), name(2), name(3)}
    rows = spark.read.parquet(out).select("doc_id", "archive").collect()
    assert sorted((r.doc_id, r.archive) for r in rows) == [("EP1", name(2)), ("EP2", name(1)), ("EP3", name(1)), ("EP4", name(3))]
    kept = spark.read.parquet(bad).groupBy("stream", "batch_id").agg(F.sort_array(F.collect_list("entry")).alias("entries")).collect()
    assert [r.entries for r in kept] == [["b1.xml", "b2.xml", "b3.xml"]] * 2
    staged = spark.read.option("recursiveFileLookup", "true").parquet(bad + "-staged")
    assert staged.count() == staged.filter("error IS NOT NULL").count() == 6


def test_a_batch_that_broke_off_is_run_again(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(weekly, "PORTION_BYTES", 0)
    source, out, bad, check = tmp_path / "source", str(tmp_path / "out"), str(tmp_path / "bad"), str(tmp_path / "check")
    source.mkdir()
    week(source, 1, 1, bad=[1])
    week(source, 2, 1, 2, bad=[2])
    calls = []

    def insert(rows, *more):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("broke off")
        insert_by_index(rows, *more)

    with pytest.raises(Exception, match="broke off"):
        insert_ep_stream(archive_stream(spark, str(source)), out, bad, check, insert=insert).awaitTermination()
    insert_ep_stream(archive_stream(spark, str(source)), out, bad, check, insert=insert).awaitTermination()
    assert sorted((r.doc_id, r.archive) for r in spark.read.parquet(out).collect()) == [("EP1", name(1)), ("EP2", name(2))]
    assert sorted(r.entry for r in spark.read.parquet(bad).collect()) == ["b1.xml", "b2.xml"]


@pytest.mark.parametrize("most, portions", [(0, 4), (1 << 30, 1)])
def test_weeks_are_replaced_in_turn(spark, tmp_path, monkeypatch, most, portions):
    monkeypatch.setattr(ep, "PORTION_BYTES", most)
    raw, out, written = str(tmp_path / "raw"), str(tmp_path / "out"), []
    rows = [(f"a{n}", "DOC/a.zip", f"EP{n}.xml", ep_xml(n), None, y, w) for n, (y, w) in enumerate([("2020", "52"), ("2021", "01"), ("2021", "01"), ("2021", "02"), ("2020", "07")], 1)]
    spark.createDataFrame(rows, "archive string, member string, entry string, content binary, error string, year string, week string").write.partitionBy("year", "week").parquet(raw)
    documents = read_weekly(spark, raw)
    broken = F.when(F.col("entry") < "EP4", F.substring("content", 1, 20)).otherwise(F.col("content"))
    write_records(documents.withColumn("content", broken), out, balance=False)
    first = read_weekly(spark, out)
    assert sorted((r.entry, r.status) for r in first.collect()) == [(f"EP{n}.xml", BAD if n < 4 else GOOD) for n in range(1, 6)]
    plain = ep.write_weekly
    monkeypatch.setattr(ep, "write_weekly", lambda df, *more, **options: written.append({(r.year, r.week) for r in df.select("year", "week").collect()}) or plain(df, *more, **options))
    write_records(documents, out, balance=False, in_turn=True)
    assert len(written) == portions and sum(len(weeks) for weeks in written) == 4
    got = sorted((r.year, r.week, r.doc_id, r.status) for r in read_weekly(spark, out).collect())
    assert got == [("2020", "07", "EP5", GOOD), ("2020", "52", "EP1", GOOD), ("2021", "01", "EP2", GOOD), ("2021", "01", "EP3", GOOD), ("2021", "02", "EP4", GOOD)]
    codecs = {pq.ParquetFile(file).metadata.row_group(0).column(0).compression for file in glob.glob(f"{out}/*/*/*.parquet")}
    assert codecs == {"ZSTD"}


def test_a_file_without_keys_is_known_to_the_index(spark, tmp_path):
    path = str(tmp_path / "table")
    insert_by_index(spark.createDataFrame([("EP1", 1), ("EP2", 2)], "doc_id string, at int"), path, order=["at"])
    spark.createDataFrame([(None, 3)], "doc_id string, at int").coalesce(1).write.mode("append").parquet(path)
    spark.createDataFrame([], "doc_id string, at int").coalesce(1).write.mode("append").parquet(path)
    index = update_index(spark, path, "doc_id")
    assert index.count() == len(files_of(spark, path)) and update_index(spark, path, "doc_id").count() == index.count()
    assert sorted((r.rows, r.least) for r in index.filter("rows > 0").collect())[0][1] == "EP1"
