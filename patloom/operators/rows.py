"""Arrays to rows, rows over tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_once(df: DataFrame, keep: Sequence[str], array: str | Column, pos: str, item: str) -> DataFrame:
    """One row per array item with its position; the array expression is computed once.

    Before a plain `posexplode` Spark filters on the size of the array, and computes the whole
    expression again for that filter. The outer form has no such filter.
    """
    return df.select(*keep, F.posexplode_outer(array).alias(pos, item)).filter(F.col(pos).isNotNull())


def spread(df: DataFrame, tasks: int | None = None) -> DataFrame:
    """Even out an input that comes in fewer tasks than there are cores.

    For the scan before a costly stage. A table of many splits passes as it is, without a shuffle.
    """
    tasks = tasks or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df
