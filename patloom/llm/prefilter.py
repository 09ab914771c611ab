"""A bitmap of hashes that says which rows cannot have a partner, before anything wide moves.

Its size is fixed, whatever the data: more keys only make it let more rows through, and an exact join always
follows. So it saves work and decides nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 26  # 8 MB


def _words(hashes: DataFrame, bits: int) -> DataFrame:
    """(word, bits): the bitmap of a table's one column of 64-bit hashes, by words of 64 places."""
    name = hashes.columns[0]
    return (
        hashes.selectExpr(f"shiftrightunsigned(`{name}`, {64 - bits}) AS place")
        .selectExpr("shiftright(place, 6) AS word", "shiftleft(1L, CAST(place & 63 AS INT)) AS bit")
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
    )


def bitmap(hashes: DataFrame, bits: int = BITS) -> np.ndarray:
    """The bitmap of a table's one column of 64-bit hashes. At most 2^(bits - 6) words reach the driver."""
    words = _words(hashes, bits).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out.view(np.uint64)


def hits(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes (uint64) may be in the bitmap."""
    place = hashes >> np.uint64(64 - 6 - (len(words).bit_length() - 1))
    return (words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def parted(df: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows whose key may be in the same column of `keys`, and those where it is not. Null is not.

    The bitmap is a table of at most 2^(BITS - 6) words here, sent to the executors, so that no Python worker is needed.
    """
    hashes = keys.select(F.xxhash64(key).alias("h"))
    words = F.broadcast(_words(hashes, BITS).withColumnsRenamed({"word": "__word", "bits": "__bits"}))
    place = F.shiftrightunsigned(F.xxhash64(key), 64 - BITS)
    met = df.withColumns({"__place": F.when(F.col(key).isNotNull(), place), "__word": F.shiftright(place, 6)}).join(words, "__word", "left")
    there = F.coalesce(F.call_function("getbit", F.col("__bits"), F.col("__place").bitwiseAND(63).cast("int")) == 1, F.lit(False))
    return tuple(met.filter(side).select(*(F.col(f"`{name}`") for name in df.columns)) for side in (there, ~there))


def maybe_among(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose key may be in the same column of `keys`."""
    return parted(df, keys, key)[0]


def inside(keys: DataFrame, key: str):
    """For a function over Arrow batches: keeps the rows whose last column, a hash of the key, may be that of one in `keys`.

    So the look at the bitmap and the work on the rows that pass need one Python worker, not two.
    """
    shared = keys.sparkSession.sparkContext.broadcast(bitmap(keys.select(F.xxhash64(key).alias("h"))))

    def kept(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).view(np.uint64)
        return batch.filter(pa.array(hits(shared.value, hashes)))

    return kept


def without(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose key is not in `keys`; only rows that may be there move."""
    maybe, rest = parted(df, keys, key)
    return rest.unionByName(maybe.join(keys.select(key).distinct(), key, "left_anti"))
