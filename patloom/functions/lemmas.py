"""Lemmas: from a table of word and lemma, and how to make that table from noun lists."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patloom.operators.rows import explode_once
from patloom.session import shared_folder

# ---- Fixed values: noun endings and what replaces them -----------------------------------
NOUN_ENDINGS = (
    ("s", ""),
    ("ses", "s"),
    ("ves", "f"),
    ("xes", "x"),
    ("zes", "z"),
    ("ches", "ch"),
    ("shes", "sh"),
    ("men", "man"),
    ("ies", "y"),
)
# -------------------------------------------------------------------------------------------

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20


def _replaced(lists: pa.Array, words: pa.Array, lemma_of: pa.Array) -> pa.Array:
    """Lists of tokens with the lemma in place of each token that is among the words."""
    flat = lists.flatten()
    swapped = pc.coalesce(lemma_of.take(pc.index_in(flat, value_set=words)), flat)
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
    return pa.ListArray.from_arrays(offsets, swapped, mask=lists.is_null())


def _lookup(df: DataFrame, tokens: str, out: str, table: pa.Table) -> DataFrame:
    known = df.sparkSession.sparkContext.broadcast((table["word"].combine_chunks(), table["lemma"].combine_chunks()))

    @F.arrow_udf("array<string>")
    def replaced(lists: pa.Array) -> pa.Array:
        return _replaced(lists, *known.value)

    return df.withColumn(out, replaced(F.col(tokens)))


@F.arrow_udf(T.ArrayType(T.StringType()))
def _swapped(lists: pa.Array, changes: pa.Array) -> pa.Array:
    # A word has one lemma everywhere, so the changes of all rows of a batch may be looked up as one table.
    pairs = changes.flatten()
    return _replaced(lists, pairs.field("word"), pairs.field("lemma"))


def _join(df: DataFrame, tokens: str, out: str, lemmas: DataFrame, keys: Sequence[str]) -> DataFrame:
    distinct = explode_once(df, keys, F.array_distinct(tokens), "__pos", "word").drop("__pos")
    # A word has one lemma everywhere, so rows that share a key, or have none, may share their changes.
    pairs = distinct.join(lemmas, "word").groupBy(*keys).agg(F.collect_set(F.struct("word", "lemma")).alias("__changes"))
    renamed = pairs.select(*(F.col(key).alias(f"__{at}") for at, key in enumerate(keys)), "__changes")
    same = reduce(Column.__and__, (df[key].eqNullSafe(renamed[f"__{at}"]) for at, key in enumerate(keys)))
    joined = df.join(renamed, same, "left").drop(*(f"__{at}" for at in range(len(keys))))
    return joined.withColumn(out, _swapped(F.col(tokens), F.col("__changes"))).drop("__changes")


def lemmatise(
    df: DataFrame,
    tokens: str,
    lemmas: DataFrame,
    keys: Sequence[str],
    out: str | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Replace each token by its lemma, if the table (word, lemma) has one; of several the least.

    The table is written to the shared folder once and measured. One within the bounds goes to every executor and is looked up
    per Arrow batch, with no shuffle. A larger one is joined on the distinct words of each row, and
    the words to change go back to their row by `keys`; Spark splits hot words (AQE skew join). Both
    ways give the same rows, also where keys repeat or are null.
    """
    changing = lemmas.filter("word IS NOT NULL AND lemma IS NOT NULL").groupBy("word").agg(F.min("lemma").alias("lemma"))
    path = shared_folder(df.sparkSession, "lemmas")
    changing.filter(F.col("word") != F.col("lemma")).write.parquet(path)
    changing = df.sparkSession.read.schema("word string, lemma string").parquet(path)
    size = changing.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.octet_length("word") + F.octet_length("lemma")), F.lit(0)).alias("bytes"),
    ).first()
    small = size["rows"] <= broadcast_rows and size["bytes"] <= broadcast_bytes
    table = changing.toArrow() if small else None
    out = out or tokens
    return _join(df, tokens, out, changing, keys) if table is None else _lookup(df, tokens, out, table)


def _shorter(form: Column) -> Column:
    """What each ending rule makes of a form, for the rules that apply."""
    made = [
        F.when(form.endswith(old), F.concat(F.substring(form, F.lit(1), F.length(form) - len(old)), F.lit(new)))
        for old, new in NOUN_ENDINGS
    ]
    return F.filter(F.array(*made), lambda one: one.isNotNull())


def noun_lemmas(words: DataFrame, nouns: DataFrame, exceptions: DataFrame | None = None) -> DataFrame:
    """The lemma table (word, lemma) of some distinct words, by the public noun rules.

    `nouns` (word) lists the known nouns, `exceptions` (word, lemma) the irregular forms. A word
    and what one round of the rules makes of it are looked up among the nouns and the shortest hit
    is the lemma; without a hit the rules are applied again to their own results. A word without
    any hit has no row.
    """
    start = F.struct(
        F.array(F.struct(F.lit(1).alias("round"), F.lit(0).alias("rank"), F.col("word").alias("form"))).alias("found"),
        F.array("word").alias("last"),
    )

    def again(state: Column, number: Column) -> Column:
        made = F.flatten(F.transform(state["last"], _shorter))
        ranked = F.transform(made, lambda form, at: F.struct(number.alias("round"), (at + 1).alias("rank"), form.alias("form")))
        return F.struct(F.concat(state["found"], ranked).alias("found"), made.alias("last"))

    rounds = F.sequence(F.lit(1), F.greatest(F.length("word"), F.lit(1)))
    found = F.when(F.size(_shorter(F.col("word"))) > 0, F.aggregate(rounds, start, again, lambda state: state["found"]))
    found = found.otherwise(start["found"])
    formed = explode_once(words, ["word"], found, "__pos", "f").select("word", "f.*")
    if exceptions is not None:
        irregular = words.join(exceptions.select("word", F.col("lemma").alias("form")), "word")
        asis = irregular.select("word").distinct().withColumn("form", F.col("word"))
        listed = irregular.select("word", "form").union(asis).select("word", F.lit(1).alias("round"), F.lit(1).alias("rank"), "form")
        formed = formed.join(exceptions.select("word"), "word", "left_anti").union(listed)
    known = formed.join(nouns.select(F.col("word").alias("form")), "form", "left_semi")
    best = F.min_by("form", F.struct("round", F.length("form").alias("size"), "rank"))
    return known.groupBy("word").agg(best.alias("lemma"))
