"""Shuffled shards of a corpus, by a two-pass external shuffle in DataFrame functions only.

First pass: every row goes to a bucket of its shard, drawn by a seeded hash; buckets are sized to fit
in memory. Second pass: each bucket is put into a random order (Fisher-Yates, Spark's `shuffle`) and
written. A row's slot is its place in its shard: rows of earlier buckets plus its place in its own.

The shard is that of greatest hash weight among all shards (rendezvous hashing): the id and the
number of shards decide alone, and a further shard takes rows into itself only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patloom.llm.registry import query, table
from patloom.session import shared_folder

BUCKET_BYTES = 8 << 20
ROW_BYTES = 64  # what a row takes besides its text


def shard_of(key: Column, shards: int, seed: int = 0) -> Column:
    """Shard 0 to shards - 1 of a key; all null keys share one."""
    weights = F.array(*(F.xxhash64(F.lit(seed), F.lit(shard), key) for shard in range(shards)))
    return (F.array_position(weights, F.array_max(weights)) - 1).cast("int")


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def write_shards(
    df: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    shards: int = 16,
    seed: int = 0,
    bucket_bytes: int = BUCKET_BYTES,
) -> None:
    """Write all rows as `shard=N` folders of Parquet files with (bucket, pos, row).

    `row` is the input row as a struct, so its columns cannot clash with those. Null keys are one key;
    a null or empty text only counts its row's overhead; repeated rows are rows of their own, and one
    key that holds a third of all rows fills many buckets of its shard. A text longer than a bucket
    makes a larger bucket. The input must read the same when read again, as a table does: a task that
    is run again draws the same buckets.
    """
    placed = df.select(
        shard_of(F.col(key), shards, seed).alias("shard"),
        F.monotonically_increasing_id().alias("at"),
        F.struct(*(F.col(f"`{name}`") for name in df.columns)).alias("row"),
    )
    sizes = placed.groupBy("shard").agg(F.sum(text_bytes(F.col("row")[text]) + ROW_BYTES).alias("size"))
    buckets = [1] * shards
    for row in sizes.collect():  # a row per shard
        buckets[row["shard"]] = -(-row["size"] // bucket_bytes)
    of_shard = F.element_at(F.array(*(F.lit(n) for n in buckets)), F.col("shard") + 1)
    scattered = placed.select(
        "shard", F.pmod(F.xxhash64(F.lit(seed), F.lit("bucket"), F.col("at")), of_shard).cast("int").alias("bucket"), "at", "row"
    )
    gathered = scattered.groupBy("shard", "bucket").agg(F.collect_list(F.struct("at", "row")).alias("rows"))
    # Buckets and their rows come in a fixed order, so that the same seed gives the same shuffle again.
    in_order = F.array_sort("rows", lambda a, b: F.when(a["at"] < b["at"], -1).otherwise(1))
    shuffled = gathered.sortWithinPartitions("shard", "bucket").select("shard", "bucket", F.shuffle(in_order, seed).alias("rows"))
    shuffled.select("shard", "bucket", F.posexplode("rows").alias("pos", "item")).select(
        "shard", "bucket", "pos", F.col("item")["row"].alias("row")
    ).write.partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The written rows: shard, bucket, pos, row. `schema` is that of `row`, as a struct type."""
    return spark.read.schema(f"bucket int, pos int, row {schema}, shard int").parquet(path)


def with_slots(rows: DataFrame, written: DataFrame) -> DataFrame:
    """Add the slot, gapless from 0 in each shard, to rows with (shard, bucket, pos).

    Only the bucket numbers of the written table are counted; give narrow rows.
    """
    counts = written.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return rows.join(starts, ["shard", "bucket"]).withColumn("slot", F.col("start") + F.col("pos")).drop("start")


@query("op5_shards")
def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards by the law `key`, read back from the written shards."""
    documents = table(spark, sf_dir, "documents")
    path = shared_folder(spark, "shards")
    write_shards(documents, path)
    written = read_shards(spark, path, documents.schema.simpleString())
    text = F.coalesce(F.col("row.text"), F.lit(""))
    rows = written.select(
        "shard",
        "bucket",
        "pos",
        F.col("row.doc_id").alias("doc_id"),
        (text_bytes(text) + 1).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    return with_slots(rows, written).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        shard_of(F.col("doc_id"), 17).alias("grown_shard"),
    )
