"""Neighbours over the borders of tasks."""

import random
from collections import Counter

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from patloom.llm import ORACLES, QUERIES, repeats
from patloom.llm.ordered import neighbours, repeated
from patloom.llm.registry import written


@pytest.mark.parametrize("single", [True, False])
@pytest.mark.parametrize("hot", [0, 700])
def test_first_of_each_key(spark, single, hot):
    rng = random.Random(hot)
    rows = [(rng.randrange(400), i, rng.randrange(3)) for i in range(1000)] + [(77, 2000 + i, 0) for i in range(hot)]
    df = spark.createDataFrame(rows, "k long, i long, x int").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    small = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        out = neighbours(df, ["k"], ["i"], "n", single).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", small)
    by = {}
    for k, i, _ in rows:
        by.setdefault(k, []).append(i)
    want = {(k, i, x, min(by[k])) for k, i, x in rows if single or len(by[k]) > 1}
    assert {(r.k, r.i, r.x, r.first_i) for r in out} == want and len(out) == len(want)
    if single:
        assert all(r.alone == (len(by[r.k]) == 1) for r in out)


@pytest.mark.parametrize("hot", [0, 700])
@pytest.mark.parametrize("wide", [40, 400, 100_000])
def test_rows_whose_key_is_there_again(spark, wide, hot):
    rng = random.Random(hot)
    rows = [(rng.randrange(wide), i, rng.randrange(3)) for i in range(1000)] + [(77, 2000 + i, 0) for i in range(hot)]
    # pairs, so that some of them lie on both sides of a border, a row of each
    rows += [(wide + i // 2, 5000 + i, 1) for i in range(100)]
    df = spark.createDataFrame(rows, "k long, i long, x int").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    shuffles = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        out = repeated(df, ["k"], ["i"], "n").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
    times = Counter(k for k, _, _ in rows)
    assert sorted(map(tuple, out)) == sorted(row for row in rows if times[row[0]] > 1)


def _joined(node):
    """Rows that the broadcast joins of a plan that ran have given."""
    name = node.nodeName()
    if name == "AdaptiveSparkPlan":
        return _joined(node.executedPlan())
    below = node.plan() if "QueryStage" in name else None
    children = [below] if below else [node.children().apply(i) for i in range(node.children().size())]
    own = node.metrics().apply("numOutputRows").value() if name == "BroadcastHashJoin" else 0
    return own + sum(map(_joined, children))


def test_suffixes_with_a_partner_in_their_task_meet_no_join(spark, monkeypatch):
    """A passage that all documents hold: what is looked up follows the tasks, not the rows."""
    passage = " ".join(f"common{i}" for i in range(300))
    texts = [(i, " ".join(f"own{i}-{j}" for j in range(60)) + " " + passage) for i in range(200)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    seen = {}

    def watched(df, name):
        if name == "extended":
            rows = df.collect()
            seen["rows"] = sum(len(r.places) for r in rows)
            seen["joined"] = _joined(df._jdf.queryExecution().executedPlan())
        return written(df, name)

    monkeypatch.setattr(repeats, "written", watched)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spans = repeats.repeated_spans(docs).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(spans) == 199 and all(r.first_doc_id == 0 and r.end_word - r.start_word == 300 for r in spans)
    assert seen["rows"] > 1000 and seen["joined"] <= 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_no_rows(spark):
    df = spark.range(0).select(F.col("id").alias("k"), F.col("id").alias("i"))
    assert neighbours(df, ["k"], ["i"], "n").collect() == []
    assert repeated(df, ["k"], ["i"], "n").collect() == []


def test_op1_against_sql(spark, tables):
    assert differences(QUERIES["op1_repeats"](spark, tables), connect(tables), ORACLES["op1_repeats"]) == []
