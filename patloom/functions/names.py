"""Dates, weeks and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- Fixed values: published naming and date formats -------------------------------------
# A European name holds the year at characters 8 to 11, four zeros, and the week at 16 and 17.
EP_ARCHIVE = r"^.{7}(\d{4})0000(\d{2}).*\.(?i:zip|tar)$"
EP_PREFIX, EP_MIDDLE, EP_SUFFIX = "EPRTBJV", "0000", "001001"
EP_EXTENSIONS = (".zip", ".tar")  # in order of preference
WEEK_FOLDER = r"(?:^|/)(\d{4})_(\d{2})/[^/]+$"
US_ARCHIVE = r"(?i)ipg(\d{6}).*?\.zip"
US_FOLDER = "zipped"
ARCHIVE_EXTENSION = r"(?i)\.(zip|tar)$"
PUBLISHED_AT = "dd.MM.yyyy HH:mm"
GRANT_DATE = "MM-dd-yyyy"
# -------------------------------------------------------------------------------------------


def _group(name: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(name, pattern, group), F.lit(""))


def base_name(path: Column) -> Column:
    """What follows the last slash."""
    return F.regexp_extract(path, r"[^/]+$", 0)


def ep_year(name: Column) -> Column:
    """Year of a European archive name, null for any other name."""
    return _group(name, EP_ARCHIVE, 1)


def ep_week(name: Column) -> Column:
    """Two-digit week of a European archive name, null for any other name."""
    return _group(name, EP_ARCHIVE, 2)


def two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def ep_archive_name(year: Column, week: Column, extension: Column) -> Column:
    """Archive name of a year (string), a week (number) and an extension."""
    return F.concat(F.lit(EP_PREFIX), year, F.lit(EP_MIDDLE), two_digits(week), F.lit(EP_SUFFIX), extension)


def year_week(year: Column, week: Column) -> Column:
    """Folder name of a week, such as 2025_03."""
    return F.concat_ws("_", year, two_digits(week))


def folder_year(path: Column) -> Column:
    """Year of a file that lies in a week folder such as 2025_03, else null."""
    return _group(path, WEEK_FOLDER, 1)


def folder_week(path: Column) -> Column:
    """Two-digit week of a file that lies in a week folder, else null."""
    return _group(path, WEEK_FOLDER, 2)


def us_date_part(name: Column) -> Column:
    """The `yymmdd` of a US archive name in any case, null for any other name."""
    return _group(name, US_ARCHIVE, 1)


def us_year(name: Column) -> Column:
    return F.concat(F.lit("20"), F.substring(us_date_part(name), 1, 2))


def us_key_year(key: Column) -> Column:
    """Year folder of a `year/zipped/name.zip` key, null where the key has another form."""
    parts = F.split(key, "/")
    formed = (F.size(parts) >= 3) & (F.try_element_at(parts, F.lit(-2)) == US_FOLDER)
    return F.when(formed & us_date_part(F.try_element_at(parts, F.lit(-1))).isNotNull(), parts[0])


def is_archive(name: Column) -> Column:
    """Whether the name ends in an archive extension, in any case."""
    return name.rlike(ARCHIVE_EXTENSION)


def is_document(name: Column) -> Column:
    """Whether the name is that of an XML document and not of a table of contents."""
    return name.endswith(".xml") & ~name.endswith("TOC.xml")


def published_at(text: Column) -> Column:
    """Time of a listing entry, null where the text is no such time."""
    return F.try_to_timestamp(text, F.lit(PUBLISHED_AT))


def latest_grant_day(day: Column) -> Column:
    """The last Tuesday up to and including the day."""
    return F.date_sub(F.next_day(day, "TU"), 7)


def latest_grant_date(day: Column) -> Column:
    return F.date_format(latest_grant_day(day), GRANT_DATE)
