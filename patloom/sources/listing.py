"""Listings: which archives there could be, which there are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patloom.functions.names import EP_EXTENSIONS, ep_archive_name, is_archive, published_at, two_digits

# ---- Fixed values ------------------------------------------------------------------------
FIRST_WEEK, LAST_WEEK = 1, 53
# -------------------------------------------------------------------------------------------


def candidate_names(years: DataFrame, year: str = "year", extensions: Sequence[str] = EP_EXTENSIONS) -> DataFrame:
    """Every archive name that could exist: year × week × extension, with the extension's rank.

    Exploded from constant arrays, so it is a projection and not a join.
    """
    weeks = F.explode(F.sequence(F.lit(FIRST_WEEK), F.lit(LAST_WEEK))).alias("week_number")
    ranked = F.posexplode(F.array(*(F.lit(extension) for extension in extensions))).alias("rank", "extension")
    named = years.select(F.col(year).alias("year"), weeks).select("*", ranked)
    return named.select(
        "year",
        two_digits(F.col("week_number")).alias("week"),
        "rank",
        ep_archive_name(F.col("year"), F.col("week_number"), F.col("extension")).alias("file_name"),
    )


def first_existing(candidates: DataFrame, listing: DataFrame) -> DataFrame:
    """Of each week the first candidate by extension rank that is listed."""
    there = candidates.join(listing.select("file_name"), "file_name", "left_semi")
    order = W.partitionBy("year", "week").orderBy("rank")
    return there.withColumn("__n", F.row_number().over(order)).filter("__n = 1").drop("__n", "rank")


def archives_only(listing: DataFrame, name: str = "file_name") -> DataFrame:
    return listing.filter(is_archive(F.col(name)))


def latest_entry(listing: DataFrame, pos: str | Column, name: str = "file_name", at: str = "published_at") -> DataFrame:
    """The archive published last; of several at the same time the one listed first.

    `pos` is the place in the listing. Entries whose time cannot be read are passed over.
    """
    timed = archives_only(listing, name).withColumn(at, published_at(F.col(at))).filter(F.col(at).isNotNull())
    place = F.col(pos) if isinstance(pos, str) else pos
    return timed.orderBy(F.col(at).desc(), place.asc()).limit(1)
