"""A corpus from raw documents to token ids, in stages that each keep what the next one takes.

Documents that the quality classifier rejects go; one of each group of near duplicates stays; passages that occur
earlier are cut out; documents that hold a benchmark item go; the rest is encoded. Every stage reads the
written result of the one before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patloom.llm.bpe import public_vocabulary, round_trip
from patloom.llm.jaccard import one_per_component
from patloom.llm.leaks import places
from patloom.llm.prefilter import parted
from patloom.llm.quality import accepted
from patloom.llm.registry import table, written
from patloom.llm.repeats import repeated_spans, without_spans


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier accepts. It learns from the labels of those that are not held out.

    A null text is judged as an empty one, every row on its own; rows without an id are judged as well and never learned from."""
    return accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links at Jaccard 0.8 of five-word runs: that of least id."""
    return one_per_component(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without passages of 50 words or more that occur earlier; a document of which no word stays goes."""
    spans = written(repeated_spans(docs), "spans")
    left = without_spans(docs, spans)
    return left.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), "n_chars"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without benchmark items, also re-parameterised ones. Rows go by id and text: others of their id stay, and no id is an id.

    Items of fewer than 5 words stand anywhere by chance: a document that has nothing else of the benchmark stays."""
    found = written(places(docs, table(spark, sf_dir, "benchmark")).filter("kind <> 'short'").select(F.col("id").alias("leaking_id"), F.col("seal").alias("leaking_seal")).distinct(), "leaking")
    sealed = docs.withColumn("leaking_seal", F.xxhash64(F.col("text").cast("string")))
    maybe, rest = parted(sealed, found, "leaking_seal")
    same = maybe["doc_id"].eqNullSafe(found["leaking_id"]) & (maybe["leaking_seal"] == found["leaking_seal"])
    return maybe.join(found, same, "left_anti").unionByName(rest).drop("leaking_seal")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text, with their number and digests of ids and decoded text. A null text has no ids; every row has a row."""
    return round_trip(docs, *public_vocabulary(), with_ids=True)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

# Sets of n-grams, a fitted model and an encoder are beyond SQL; the tests hold `run` against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
