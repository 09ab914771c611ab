"""A date range of the merged records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patloom.operators.counts import observed
from patloom.sinks.tables import write_extract
from patloom.sources.files import in_range, row_groups

# ---- Fixed values: the range the extract takes unless told otherwise ---------------------
FIRST_DAY, LAST_DAY = "20220101", "20241231"
# -------------------------------------------------------------------------------------------


def date_extract(
    records: DataFrame,
    day: str = "date_publication",
    first: str = FIRST_DAY,
    last: str = LAST_DAY,
    year: str | None = None,
) -> DataFrame:
    """Records of a closed range of days. The filter reaches the Parquet scan.

    Name the `year` column of a table that is partitioned by it, and whole folders are passed over.
    """
    within = records.filter(in_range(F.col(day), first, last))
    return within.filter(F.col(year).cast("string").between(first[:4], last[:4])) if year else within


def share_to_read(spark: SparkSession, source: str, first: str = FIRST_DAY, last: str = LAST_DAY, day: str = "date_publication") -> float:
    """The part of a table's bytes in row groups that may hold days of a range, by their bounds.

    Near 1 for a short range means that the table is not in order of days; `write_clustered` puts it so.
    """
    met = F.col("least").isNull() | ((F.col("least") <= last) & (F.col("greatest") >= first))
    groups = row_groups(spark, source, day).agg(F.sum(F.when(met, F.col("bytes")).otherwise(0)).alias("met"), F.sum("bytes").alias("all")).first()
    return (groups["met"] or 0) / groups["all"] if groups["all"] else 0.0


def run_extract(
    spark: SparkSession, source: str, out: str, first: str = FIRST_DAY, last: str = LAST_DAY, year: str | None = None
) -> int:
    """Write the extract and give its row count. Where no record is in the range there is no file, and an
    earlier extract is emptied."""
    rows = date_extract(spark.read.parquet(source), first=first, last=last, year=year)
    watched, seen = observed(rows, "extract")  # an observation holds what the first action saw
    return seen.get["rows"] if write_extract(watched, out, skip_empty=True, source=rows) else 0
