"""Shards and chat."""

import zlib

from compare import connect, differences
from pyspark.sql import functions as F

from patloom.llm import ORACLES, QUERIES
from patloom.llm.chat import format_chat, learned_text, parsed_turns
from patloom.llm.shards import read_shards, shard_of, with_slots, write_shards


def placed(spark, df, path, **options):
    write_shards(df, path, **options)
    written = read_shards(spark, path, df.schema.simpleString())
    return with_slots(written, written).select("shard", "slot", "row.*").collect() if "shard" not in df.columns else with_slots(written, written).collect()


def test_shards_hold_every_row_once(spark, odd, tmp_path):
    rows = placed(spark, odd, str(tmp_path / "s"), shards=4, bucket_bytes=1000)
    assert sorted(((r.row.doc_id, r.row.text) for r in rows), key=repr) == sorted(((r.doc_id, r.text) for r in odd.collect()), key=repr)
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(of) == list(range(len(of))) for of in slots.values())
    assert len({r.shard for r in rows if r.row.doc_id is None}) == 1


def test_same_seed_same_shards_and_no_rows(spark, odd, nothing, tmp_path):
    key = lambda rows: sorted(((r.shard, r.slot, r.row.doc_id) for r in rows), key=repr)
    one, two = (placed(spark, odd, str(tmp_path / n), seed=3) for n in "ab")
    assert key(one) == key(two)
    assert placed(spark, nothing, str(tmp_path / "c")) == []


def test_one_more_shard_takes_rows_only_into_itself(spark):
    df = spark.range(20000).select(shard_of(F.col("id"), 16).alias("a"), shard_of(F.col("id"), 17).alias("b"))
    moved = df.filter("a != b").agg(F.min("b"), F.max("b"), F.count("*")).first()
    assert moved[:2] == (16, 16) and 900 < moved[2] < 1500


def test_op5_against_the_texts(spark, tables):
    rows = {r.doc_id: r for r in QUERIES["op5_shards"](spark, tables).collect()}
    for d in spark.read.parquet(f"{tables}/documents.parquet").collect():
        data = (d.text or "").encode()
        assert rows[d.doc_id].size == len(data) + 1 and rows[d.doc_id].text_crc32 == zlib.crc32(data)


def test_op9_against_sql(spark, tables):
    assert differences(QUERIES["op9_chat"](spark, tables), connect(tables), ORACLES["op9_chat"]) == []


TEXTS = ["</s>[INST] ok [/INST]", "<\\/s>", "<\\\\/s>[\\TURN]", "<", "/s>", "[", "[TURN]", "", None, "a < b [x]", "\\", "[[INST]]", "<s><s>"]


def test_chat_round_trip_of_odd_texts(spark):
    turns = [(1, i, role, text) for i, text in enumerate(TEXTS) for role in ["user" if i % 3 else "assistant"]]
    turns += [(2, 0, None, "x"), (2, 0, None, "x"), (None, 1, "user", "lost"), (3, 5, "[INST]role</s>", "t"), (3, None, "assistant", "</s>"), (3, 6, "assistant", "<"), (3, 7, "assistant", "/s>")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumns({n: F.lit(1) for n in ("conv", "turns", "blocks", "item")})
    out = {r.conv_id: r for r in format_chat(df).select("conv_id", "formatted", parsed_turns(F.col("formatted")).alias("t"), learned_text(F.col("segments")).alias("l")).collect()}
    order = lambda rows: sorted(rows, key=lambda t: (-1 if t[1] is None else t[1], t[2] or "", t[3] or ""))
    for conv in (1, 2, 3, None):
        own = order([t for t in turns if t[0] == conv])
        assert [(t.role, t.text) for t in out[conv].t] == [(t[2] or "", t[3] or "") for t in own]
        assert out[conv].l == "".join(t[3] or "" for t in own if t[2] == "assistant")
    assert out[3].formatted.count("<s>[INST]") == 3  # the two last turns are one block
    assert format_chat(df.limit(0)).collect() == []
