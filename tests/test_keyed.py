"""Insert if absent by an index of the table's files."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from patloom.sinks import keyed
from patloom.sinks.keyed import candidate_files, files_of, insert_by_index, update_index
from patloom.sinks.tables import insert_if_absent

ORDER = ["at"]


def batch(spark, keys, at=0):
    return spark.createDataFrame([(k, at + i, "x" * 200) for i, k in enumerate(keys)], "doc_id string, at int, text string")


def test_filters_hold_what_they_were_given():
    rng = np.random.default_rng(1)
    inside, outside = (rng.integers(0, 2**64, n, dtype=np.uint64) for n in (5000, 20000))
    kept = keyed.bloom(inside)
    assert all(keyed.may_hold(kept, inside[i : i + 1]) for i in range(0, 5000, 7))
    assert sum(keyed.may_hold(kept, outside[i : i + 1]) for i in range(2000)) < 20
    assert not keyed.may_hold(keyed.bloom(inside[:0]), outside)


def test_same_table_as_the_plain_insert(spark, tmp_path):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    batches = [["EP3", "EP1", "EP3", None], ["EP1", "EP2", None, None], [], ["EP9", "EP8", "EP2", "EP0"], [None], ["EP3"]]
    for at, keys in enumerate(batches):
        insert_if_absent(batch(spark, keys, 10 * at), one, order=ORDER)
        insert_by_index(batch(spark, keys, 10 * at), two, order=ORDER)
        rows = [sorted(((r.doc_id, r.at) for r in spark.read.parquet(path).collect()), key=repr) for path in (one, two)]
        assert rows[0] == rows[1]


def test_a_stream_of_batches_opens_little_of_the_table(spark, tmp_path):
    path = str(tmp_path / "table")
    opened = total = 0
    for number in range(20):
        new = [f"EP{number:03d}{i:05d}" for i in range(300)]
        again = [f"EP{number - 1:03d}{i:05d}" for i in range(20)] if number % 5 == 4 else []
        rows = batch(spark, new + again, 1000 * number)
        files = candidate_files(rows, path, "doc_id")
        opened += sum(os.path.getsize(f.removeprefix("file:")) for f in files)
        total += sum(os.path.getsize(f.removeprefix("file:")) for f in files_of(spark, path).values())
        insert_by_index(rows, path, order=ORDER)
    assert 0 < opened < total / 10
    assert spark.read.parquet(path).count() == 6000 == spark.read.parquet(path).select("doc_id").distinct().count()


def test_keys_all_over_the_range_are_found_by_the_filters(spark, tmp_path):
    path = str(tmp_path / "table")
    for part in range(8):
        insert_by_index(batch(spark, [f"EP{i:06d}" for i in range(part, 4000, 8)]), path, order=ORDER)
    held = len(files_of(spark, path))
    assert len(candidate_files(batch(spark, ["EP000011", "EP003995"]), path, "doc_id")) == 1 < held
    assert candidate_files(batch(spark, ["EP000011x", "EP001x"]), path, "doc_id") == []


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_tables_without_or_with_half_an_index(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(keyed, "MOST_KEYS", most)
    path = str(tmp_path / "table")
    insert_if_absent(batch(spark, ["EP1", "EP2"]), path, order=ORDER)  # no index
    insert_by_index(batch(spark, ["EP2", "EP3"]), path, order=ORDER)
    insert_if_absent(batch(spark, ["EP3", "EP4"]), path, order=ORDER)  # as if the index had not been written
    insert_by_index(batch(spark, ["EP4", "EP5"]), path, order=ORDER)
    assert sorted(r.doc_id for r in spark.read.parquet(path).collect()) == [f"EP{i}" for i in range(1, 6)]
    index = update_index(spark, path, "doc_id")
    assert index.select("file").distinct().count() == index.count() == len([f for f in files_of(spark, path)])


def test_number_keys_and_a_choice_of_columns(spark, tmp_path):
    path = str(tmp_path / "table")
    for _ in range(2):
        df = spark.range(50).select((F.col("id") % 30).alias("doc_id"), F.col("id").alias("at"), F.lit("n").alias("note"))
        insert_by_index(df, path, order=ORDER, columns=["doc_id", "note"])
    assert spark.read.parquet(path).columns == ["doc_id", "note"] and spark.read.parquet(path).count() == 30


def test_rows_move_once_and_not_at_all_where_nothing_is_new(spark, tmp_path, monkeypatch):
    staged, path, joined, ranged = str(tmp_path / "staged"), str(tmp_path / "table"), [], []
    batch(spark, [f"EP{i:06d}" for i in range(2000)]).write.parquet(staged)
    rows = spark.read.parquet(staged)
    plain = keyed.first_by_key
    monkeypatch.setattr(keyed, "first_by_key", lambda df, *more: ranged.append((df, plain(df, *more))) or ranged[-1][1])
    monkeypatch.setattr(keyed, "not_done", lambda df, *more, **options: joined.append(df))
    for _ in range(2):
        insert_by_index(rows, path, order=ORDER)
    exchanges = [picked._jdf.queryExecution().executedPlan().toString().count("Exchange ") for _, picked in ranged]
    assert exchanges == [1, 1] and not joined
    assert [df.count() for df, _ in ranged] == [2000, 0]
    assert spark.read.parquet(path).count() == 2000


@pytest.mark.parametrize("most", [0, 1000])
def test_repeated_keys_and_a_table_that_holds_some(spark, tmp_path, most, monkeypatch):
    monkeypatch.setattr(keyed, "MOST_ROWS", most)
    path = str(tmp_path / "table")
    insert_by_index(batch(spark, ["a", "b"], 0), path, order=ORDER)
    insert_by_index(batch(spark, [None, "c", "b", "c", None, "d", "a"], 10), path, order=ORDER)
    got = sorted(((r.doc_id, r.at) for r in spark.read.parquet(path).collect()), key=repr)
    assert got == sorted([("a", 0), ("b", 1), (None, 10), ("c", 11), ("d", 15)], key=repr)
