"""US archives to records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patloom.functions.names import base_name, us_date_part, us_year
from patloom.functions.us import parse_us
from patloom.operators.dedup import first_by_key, first_in_task
from patloom.operators.skip import not_done
from patloom.plans.ep import BAD, GOOD
from patloom.plans.ingest import DONE_BY, MANIFEST, MOST_TRIES, record_done
from patloom.sinks.tables import read_or_none, write_weekly
from patloom.sources.archives import list_files, read_flat_documents, spread_documents
from patloom.sources.files import read_partitioned
from patloom.sources.restart import SPAN

DEDUP_KEY = ("archive", "pub_ref_doc_number")
ORDER = ("archive", "entry", "doc_pos")
US_FOLDERS = ("year", "date_part", "archive")
PIECE_BYTES = 32 << 20  # packed bytes of an archive whose records are written together


def unique_records(parsed: DataFrame, keep_null_keys: bool = False) -> DataFrame:
    """The first record of each document number and archive; rows with an error are all kept."""
    return first_by_key(parsed, DEDUP_KEY, ORDER, keep_null_keys, exempt=F.col("error").isNotNull())


def us_archives(files: DataFrame) -> DataFrame:
    """Files named as US archives, in any case, with their name."""
    named = files.withColumn("file_name", base_name(F.col("path")))
    return named.filter(us_date_part(F.col("file_name")).isNotNull())


def placed_records(archives: DataFrame, keep_null_keys: bool = False, tasks: int | None = None) -> DataFrame:
    """Records and quarantine of US archives as they are written, moved once.

    Records go to pieces of their archive by a hash of their number, so that repeats meet and a task writes whole pieces: one
    shuffle for the dedup and for the layout. The number of pieces follows the largest archive. Of rows that repeat within a task all but the first
    are left out before, so a number that most rows have, or lack, moves a row per task. Rows with an error are
    spread over the pieces.
    """
    sizes = archives.agg(F.sum("length").alias("all"), F.max("length").alias("most")).first()
    cores = archives.sparkSession.sparkContext.defaultParallelism
    pieces = -(-(sizes["most"] or 1) // PIECE_BYTES)
    parsed = parse_us(spread_documents(read_flat_documents(archives, tasks), (sizes["all"] or 0) // SPAN, cores))
    number, place, exempt = F.col("pub_ref_doc_number"), [F.col(name) for name in ORDER[1:]], F.col("error").isNotNull()
    free = exempt | number.isNull() if keep_null_keys else exempt
    rows = parsed.filter(first_in_task([F.col("archive"), number], [F.coalesce(place[0], F.lit("")), F.coalesce(place[1], F.lit(-1))], free))
    key = F.when(free, F.xxhash64(*ORDER)).otherwise(F.xxhash64(number))
    dealt = rows.withColumn("piece", F.pmod(key, F.lit(pieces)))
    dealt = dealt.repartition(max(cores, -(-(sizes["all"] or 0) // PIECE_BYTES)), "archive", "piece")
    records = first_by_key(dealt, ("archive", "piece", DEDUP_KEY[1]), ORDER, keep_null_keys, exempt=exempt).drop("piece")
    return records.withColumns(
        {
            "status": F.when(F.col("error").isNull(), GOOD).otherwise(BAD),
            "year": us_year(F.col("archive")),
            "date_part": us_date_part(F.col("archive")),
        }
    )


def write_archives(archives: DataFrame, path: str, keep_null_keys: bool = False, tasks: int | None = None) -> None:
    """Read, parse, deduplicate and write US archives (path, length) by year, date part and archive.

    Records and quarantine (status `good` and `bad`) share the folder of their archive, so an archive that
    is written again replaces both. Records are moved once (`placed_records`); where there are fewer slices of archives than
    cores their documents are spread before the parse.
    """
    write_weekly(placed_records(archives, keep_null_keys, tasks), path, by=US_FOLDERS, balance=False)


def read_us_records(spark: SparkSession, path: str) -> DataFrame:
    """The US table with year, date part and archive as the strings they are."""
    return read_partitioned(spark, path, US_FOLDERS)


def write_new_archives(
    spark: SparkSession, source: str, path: str, manifest: str, tasks: int | None = None, most_tries: int = MOST_TRIES
) -> None:
    """Write the archives of a folder that the manifest does not have yet; it is written last.

    The manifest knows archives by full name, length and time of modification; so a revised archive of the
    same day counts. One of which an entry could not be read is read again, `most_tries` times in all (see `record_done`). A
    document that is no good is a row of the quarantine and no reason to read again.
    """
    archives = us_archives(list_files(spark, source))
    done = read_or_none(spark, manifest, MANIFEST)
    pending = archives if done is None else not_done(archives, done, DONE_BY)
    write_archives(pending, path, tasks=tasks)
    if read_or_none(spark, path) is None:
        return
    # The folders of pending archives alone are read: Spark prunes them by the join, as long as the list is small.
    there = read_us_records(spark, path).filter("error IS NOT NULL AND doc_pos IS NULL")
    there = there.join(pending.select(F.col("file_name").alias("archive")), "archive", "left_semi")
    record_done(spark, pending, there.groupBy("archive").agg(F.min("error").alias("reason")), manifest, most_tries)
