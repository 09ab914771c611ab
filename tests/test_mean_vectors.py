"""Mean vectors by sums that are put together."""

import random

import pytest
from pyspark.sql import functions as F

from patloom.operators import pooling
from patloom.operators.pooling import mean_by_position, merged_means


def plain(rows, keys=1):
    held = {}
    for *key, vector in rows:
        for at, value in enumerate(vector or []):
            held.setdefault(tuple(key), {}).setdefault(at, []).extend([] if value is None else [value])
    return {key: [sum(v) / len(v) if v else None for _, v in sorted(by.items())] for key, by in held.items()}


@pytest.mark.parametrize("cells", [3, 1 << 22])
def test_means_of_uneven_vectors(spark, monkeypatch, cells):
    monkeypatch.setattr(pooling, "MOST_CELLS", cells)
    rng = random.Random(cells)
    rows = [(rng.choice(["a", "b", "c", None, ""]), rng.choice([1, None]), [rng.choice([None, 1.0, 2.5, -4.0]) for _ in range(rng.randrange(5))]) for _ in range(300)]
    rows += [("only null", 1, [None, None]), ("empty", 1, []), ("none", 1, None)]
    df = spark.createDataFrame(rows, "k string, j int, v array<double>").repartition(5)
    got = {(r.k, r.j): r.vector for r in merged_means(df, ["k", "j"], "v").collect()}
    want = plain(rows)
    assert set(got) == set(want)
    for key, vector in want.items():
        assert got[key] == pytest.approx(vector) if None not in vector else [x is None for x in got[key]] == [x is None for x in vector]


def test_a_hot_key_moves_a_row_per_task(spark):
    df = spark.range(0, 20_000, numPartitions=6).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 50).alias("k"), F.array(F.col("id").cast("float"), F.lit(1.0)).alias("v"))
    means = merged_means(df, ["k"], "v")
    counted = means.filter("k = 7")
    assert counted.first().vector[1] == 1.0
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = merged_means(df, ["k"], "v")
        plan.collect()
        moved = exchanged(plan._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert moved <= 6 * 50
    long = {(r.k, r.pos): r["mean"] for r in mean_by_position(df, ["k"], "v").collect()}
    for r in means.collect():
        assert r.vector == pytest.approx([long[r.k, 0], long[r.k, 1]])


def exchanged(plan):
    """Rows that go through the shuffles of a plan."""
    found = 0
    if plan.nodeName() == "Exchange":
        found = plan.metrics().apply("shuffleRecordsWritten").value()
    return found + sum(exchanged(plan.children().apply(i)) for i in range(plan.children().size()))


def test_no_keys_and_no_rows(spark):
    df = spark.createDataFrame([([1.0, 3.0],), ([2.0],)], "v array<double>")
    assert [r.vector for r in merged_means(df, [], "v").collect()] == [[1.5, 3.0]]
    assert merged_means(df.limit(0).withColumn("k", F.lit(1)), ["k"], "v").collect() == []
