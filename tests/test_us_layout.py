"""US records move once."""

import pytest
from archives import zipped
from pyspark.sql import functions as F
from test_jobs import us_doc

from patloom.operators import dedup
from patloom.operators.dedup import first_in_task
from patloom.plans import us
from patloom.plans.ep import BAD, GOOD
from patloom.sources.archives import list_files


@pytest.fixture
def source(tmp_path):
    folder = tmp_path / "source"
    folder.mkdir()
    many = "".join(us_doc(n, f"{n}-{at}") for at in range(3) for n in ("A", "B", None, *range(40)))
    (folder / "ipg240102.zip").write_bytes(zipped({"1.xml": many, "2.xml": us_doc("A", "late") + us_doc("Z", "z")}))
    (folder / "ipg240109.zip").write_bytes(zipped({"1.xml": "".join(us_doc(None, f"n{i}") for i in range(300))}))
    (folder / "ipg240116.zip").write_bytes(b"broken")
    return folder


@pytest.mark.parametrize("piece", [100, 32 << 20])
@pytest.mark.parametrize("keep", [False, True])
def test_same_records_as_two_shuffles(spark, source, tmp_path, monkeypatch, piece, keep):
    from patloom.functions.us import parse_us
    from patloom.sources.archives import read_flat_documents

    monkeypatch.setattr(us, "PIECE_BYTES", piece)
    files = list_files(spark, str(source))
    us.write_archives(files, str(tmp_path / "out"), keep_null_keys=keep)
    row = lambda df: sorted(((r.archive, r.entry, r.doc_pos, r.pub_ref_doc_number, r.title, r.error is None) for r in df.collect()), key=repr)
    want = us.unique_records(parse_us(read_flat_documents(files)), keep)
    got = us.read_us_records(spark, str(tmp_path / "out"))
    assert row(got) == row(want)
    assert {(r.archive, r.status) for r in got.collect()} >= {("ipg240102.zip", GOOD), ("ipg240116.zip", BAD)}
    again = us.write_archives(files, str(tmp_path / "out"), keep_null_keys=keep)
    assert again is None and row(us.read_us_records(spark, str(tmp_path / "out"))) == row(want)


def test_the_whole_job_has_one_wide_exchange(spark, source):
    plan = us.placed_records(list_files(spark, str(source)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    # The others: paths to the index, slices to the readers, and the spread of what comes in few slices.
    assert plan.count("Exchange") == 4


def test_a_hot_number_moves_a_row_per_task(spark, monkeypatch):
    df = spark.range(0, 9000, numPartitions=3).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("at"), (F.col("id") == 8).alias("free"))
    kept = df.filter(first_in_task([F.col("k")], [F.col("at")], F.col("free")))
    assert kept.filter("k = 'hot'").count() == 3 + 1 and kept.filter("k <> 'hot'").count() == 3000
    nulls = df.filter(first_in_task([F.when(F.col("k") != "hot", F.col("k"))], [F.col("at")], F.lit(False)))
    assert nulls.filter("k = 'hot'").count() == 3
    down = df.filter(first_in_task([F.lit(1)], [-F.col("at")], F.lit(False)))
    assert down.count() == 9000  # what comes later may be first
    monkeypatch.setattr(dedup, "MOST_SEEN", 10)
    assert df.filter(first_in_task([F.col("k")], [F.col("at")], F.col("free"))).filter("k = 'hot'").count() >= 4
