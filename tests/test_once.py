"""Costly inputs are read once."""

import pytest
from archives import ep_xml, zipped
from test_jobs import name

from patloom.functions.lemmas import lemmatise
from patloom.plans.ingest import ingest_archives
from patloom.sinks.tables import write_weekly
from patloom.sources.files import read_weekly


@pytest.mark.parametrize("bound", [100, 0])
def test_the_lemma_table_is_made_once(spark, bound):
    made = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    lemmas = spark.createDataFrame([("dogs", "dog"), ("men", "man")], "word string, lemma string").mapInArrow(seen, "word string, lemma string")
    df = spark.createDataFrame([(1, ["dogs", "run", None]), (2, ["men"]), (2, ["x"]), (3, None), (None, [])], "id int, tokens array<string>")
    got = lemmatise(df, "tokens", lemmas, ["id"], broadcast_rows=bound).collect()
    assert sorted((r.tokens for r in got), key=repr) == sorted([["dog", "run", None], ["man"], ["x"], None, []], key=repr)
    assert made.value == 2


def _jobs(spark, run):
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_the_folders_of_a_weekly_table_are_listed_once(spark, tmp_path):
    # More than 32 weeks of each of two years: Spark lists them in two jobs, and looks at files in one more.
    weeks = spark.range(80).selectExpr("id", "CAST(1900 + id DIV 40 AS STRING) AS year", "lpad(CAST(id % 40 AS STRING), 2, '0') AS week")
    write_weekly(weeks, str(tmp_path / "weekly"))
    before = spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled")
    assert _jobs(spark, lambda: read_weekly(spark, str(tmp_path / "weekly"))) <= 3
    table = read_weekly(spark, str(tmp_path / "weekly"))
    assert [kind for _, kind in table.dtypes] == ["bigint", "string", "string"]
    assert [tuple(r) for r in table.filter("week = '07'").orderBy("id").collect()] == [(7, "1900", "07"), (47, "1901", "07")]
    assert spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled") == before


def test_nothing_is_written_where_every_archive_is_done(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / name(5)).write_bytes(zipped({"DOC/1.zip": zipped({"1.xml": ep_xml(1)})}))
    paths = [str(tmp_path / x) for x in ("in", "raw", "manifest")]
    ingest_archives(spark, *paths)
    files = {path: path.stat().st_mtime_ns for top in ("raw", "manifest") for path in (tmp_path / top).rglob("*")}
    ingest_archives(spark, *paths)
    assert {path: path.stat().st_mtime_ns for top in ("raw", "manifest") for path in (tmp_path / top).rglob("*")} == files
    assert read_weekly(spark, paths[1]).count() == 1
