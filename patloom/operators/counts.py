"""Row counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def counts(df: DataFrame, by: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def observed(df: DataFrame, name: str, **extra: Column) -> tuple[DataFrame, Observation]:
    """The same rows, counted while they pass: no second run for the count.

    Read `observation.get["rows"]` after an action on the DataFrame.
    """
    observation = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows"), *(column.alias(key) for key, column in extra.items())]
    return df.observe(observation, *metrics), observation


def stacked(*parts: DataFrame) -> DataFrame:
    """All rows of all parts, columns matched by name, absent ones null."""
    first, *others = parts
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
