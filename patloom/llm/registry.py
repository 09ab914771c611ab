"""Where the queries of this subpackage are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from patloom.session import shared_folder, small_batches

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that gives the same rows where SQL can say it."""

    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return register


BATCH_ROWS = 1000  # whole texts are wide rows: few of them make a full Arrow batch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark, BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, safe from lost executors."""
    small_batches(df.sparkSession, BATCH_ROWS)
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
