"""Dedup, skip, counts, plans of the operators."""

import pytest
from pyspark.sql import functions as F

from patloom.operators.counts import counts, observed, stacked
from patloom.operators.dedup import first_by_key, latest_by_key
from patloom.operators.rows import explode_once, spread
from patloom.operators.skip import existing, not_done


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def rows(spark):
    data = [("a", 3), ("a", 1), ("b", 2), (None, 5), (None, 4)]
    return spark.createDataFrame(data, "k string, o int")


def test_first_by_key(rows):
    assert {tuple(r) for r in first_by_key(rows, ["k"], ["o"]).collect()} == {("a", 1), ("b", 2), (None, 4)}
    kept = {tuple(r) for r in first_by_key(rows, ["k"], ["o"], keep_null_keys=True).collect()}
    assert kept == {("a", 1), ("b", 2), (None, 4), (None, 5)}


def test_absent_key_column_means_no_dedup(rows):
    assert first_by_key(rows, ["k", "other"], ["o"]).count() == 5


def test_exempt_rows_stay(rows):
    kept = {tuple(r) for r in first_by_key(rows, ["k"], ["o"], exempt=F.col("k") == "a").collect()}
    assert kept == {("a", 3), ("a", 1), ("b", 2), (None, 4)}


def test_hot_key_is_reduced_before_the_shuffle(spark):
    key = F.when(F.col("id") % 10 < 7, "hot").otherwise(F.concat(F.lit("k"), "id"))
    df = spark.range(10000).select(key.alias("k"), F.col("id").alias("o")).repartition(6)
    reduced = first_by_key(df, ["k"], ["o"])
    text = plan(reduced)
    last, exchange, partial = (text.index(part) for part in ("1, Final", "Exchange hashpartitioning(k", "1, Partial"))
    assert last < exchange < partial
    assert reduced.count() == 3001 and reduced.filter("k = 'hot'").first().o == 0


def test_latest_by_key(spark):
    data = [("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("b", 1, 9)]
    df = spark.createDataFrame(data, "k string, at int, n int")
    assert {tuple(r) for r in latest_by_key(df, ["k"], "at", ["n"]).collect()} == {("a", 2, 2), ("b", 1, 9)}


def test_skip(rows, spark):
    done = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, x int")
    assert sorted(r.o for r in not_done(rows, done, ["k"]).collect()) == [2, 4, 5]
    assert sorted(r.o for r in existing(rows, done, ["k"]).collect()) == [1, 3]


def test_hot_key_of_the_done_side_is_reduced_before_the_shuffle(spark, rows):
    done = spark.range(1000).select(F.when(F.col("id") % 3 > 0, "a").otherwise("x").alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(not_done(rows, done, ["k"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("HashAggregate") == 2 and text.count("Exchange") == 2


def test_skip_reads_only_keys(spark, tables):
    documents = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id")
    target = spark.read.parquet(f"{tables}/documents.parquet")
    assert "text" not in plan(not_done(documents, target, ["doc_id"]))


def test_counts_and_observation(rows):
    assert {tuple(r) for r in counts(rows, ["k"]).collect()} == {("a", 2), ("b", 1), (None, 2)}
    watched, observation = observed(rows, "kept", least=F.min("o"))
    assert len(watched.collect()) == 5
    assert observation.get == {"rows": 5, "least": 1}


def test_stacked(spark):
    a, b = spark.createDataFrame([(1, "x")], "a int, b string"), spark.createDataFrame([("y", 2)], "b string, a int")
    c = spark.createDataFrame([(3,)], "a int")
    assert {tuple(r) for r in stacked(a, b, c).collect()} == {(1, "x"), (2, "y"), (3, None)}


def test_explode_once(spark):
    df = spark.createDataFrame([(1, ["a", None]), (2, []), (3, None)], "n int, v array<string>")
    assert [tuple(r) for r in explode_once(df, ["n"], "v", "pos", "item").collect()] == [(1, 0, "a"), (1, 1, None)]


def test_spread_only_where_tasks_are_few(spark):
    assert "Exchange" in plan(spread(spark.range(10, numPartitions=2), 4))
    assert "Exchange" not in plan(spread(spark.range(10, numPartitions=4), 4))
