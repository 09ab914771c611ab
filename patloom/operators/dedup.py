"""One row per key."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patloom.schemas import ORIGIN

MOST_SEEN = 100_000  # keys that a task remembers, some 50 MB

def _one_by_key(df: DataFrame, partition: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    # Spark keeps one row per key and task before the shuffle (WindowGroupLimit, Partial), so a key
    # that holds a third of all rows sends one row per task.
    numbered = df.withColumn("__n", F.row_number().over(W.partitionBy(*partition).orderBy(*order)))
    return numbered.filter(F.col("__n") == 1).drop("__n")


def first_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = ORIGIN,
    keep_null_keys: bool = False,
    exempt: Column | None = None,
) -> DataFrame:
    """The first row of each key in the given order, which should identify a row.

    Null keys count as equal; with `keep_null_keys` rows with a null in the key are all kept, and
    so are the `exempt` rows. A key column that the table does not have means no dedup at all.
    """
    if not set(keys) <= set(df.columns):
        return df
    exemptions = [F.col(key).isNull() for key in keys] if keep_null_keys else []
    if exempt is not None:
        exemptions.append(exempt)
    partition: list[str | Column] = list(keys)
    if exemptions:  # an exempt row is a group of its own
        partition.append(F.when(reduce(Column.__or__, exemptions), F.struct(*order)))
    return _one_by_key(df, partition, [F.col(name).asc() for name in order])


def first_in_task(keys: Sequence[Column], order: Sequence[Column], exempt: Column) -> Column:
    """Whether no earlier row of the same task has the key at a place before this one's; exempt rows always.

    For use before a shuffle by other columns than the key, where Spark cannot reduce a hot key itself: it leaves about one
    row per key and task, and whoever comes after decides among these. Null keys count as equal. What is kept
    of a task's keys is bounded; beyond that more rows pass.
    """
    width = len(keys)

    @F.arrow_udf("boolean")
    def passes(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        seen: dict[tuple, tuple] = {}
        for *columns, free in batches:
            out = []
            for *row, always in zip(*(column.to_pylist() for column in columns), free.to_pylist()):
                key, place = tuple(row[:width]), tuple(row[width:])
                earlier = seen.get(key)
                fresh = earlier is None or place < earlier
                if fresh and not always:
                    seen[key] = place
                out.append(always or fresh)
            if len(seen) > MOST_SEEN:
                seen.clear()
            yield pa.array(out, pa.bool_())

    return passes.asNondeterministic()(*keys, *order, exempt)


def latest_by_key(df: DataFrame, keys: Sequence[str], at: str, order: Sequence[str]) -> DataFrame:
    """The row of each key with the greatest `at`; ties go to the first in the given order."""
    return _one_by_key(df, list(keys), [F.col(at).desc(), *(F.col(name).asc() for name in order)])
