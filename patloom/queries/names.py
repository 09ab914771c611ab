"""Dates and file names."""

from __future__ import annotations

from pyspark.sql import functions as F

from patloom.functions.names import (
    PUBLISHED_AT,
    base_name,
    ep_archive_name,
    ep_week,
    ep_year,
    folder_week,
    folder_year,
    latest_grant_date,
    published_at,
    two_digits,
    us_date_part,
    us_key_year,
    us_year,
    year_week,
)
from patloom.queries.registry import query, table


@query(
    "D1_latest_grant_date",
    """
    SELECT o_orderkey, strftime(o_orderdate::DATE - ((isodow(o_orderdate) + 5) % 7)::INT, '%m-%d-%Y') AS grant_date
    FROM orders
    """,
)
def grant_date(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", latest_grant_date(F.to_date("o_orderdate")).alias("grant_date"))


@query(
    "D2_D5_ep_names",
    """
    SELECT o_orderkey, name, CASE WHEN fits THEN name[8:11] END AS year, CASE WHEN fits THEN name[16:17] END AS week,
           year_week FROM (
      SELECT o_orderkey, o_orderstatus <> 'P' AS fits,
        'EPRTBJV' || CASE o_orderstatus WHEN 'P' THEN '' ELSE year(o_orderdate)::VARCHAR END || '0000'
          || lpad(week(o_orderdate)::VARCHAR, 2, '0') || '001001.zip' AS name,
        year(o_orderdate)::VARCHAR || '_' || lpad(week(o_orderdate)::VARCHAR, 2, '0') AS year_week FROM orders)
    """,
)
def ep_names(spark, sf_dir):
    year = F.date_format("o_orderdate", "yyyy")
    week = F.weekofyear("o_orderdate")
    given = F.when(F.col("o_orderstatus") == "P", "").otherwise(year)
    named = table(spark, sf_dir, "orders").select(
        "o_orderkey", ep_archive_name(given, week, F.lit(".zip")).alias("name"), year_week(year, week).alias("year_week")
    )
    return named.withColumns({"year": ep_year(F.col("name")), "week": ep_week(F.col("name"))})


@query(
    "D3_us_names",
    """
    SELECT o_orderkey, name, CASE WHEN fits THEN part END AS date_part, CASE WHEN fits THEN '20' || part[1:2] END AS year
    FROM (SELECT o_orderkey, o_orderstatus <> 'P' AS fits, strftime(o_orderdate, '%y%m%d') AS part,
            CASE o_orderstatus WHEN 'P' THEN 'ipg' || o_orderkey % 1000 || '.zip' WHEN 'O' THEN 'IPG' || part || '_r1.ZIP'
                 ELSE 'ipg' || part || '.zip' END AS name FROM orders)
    """,
)
def us_names(spark, sf_dir):
    part, status = F.date_format("o_orderdate", "yyMMdd"), F.col("o_orderstatus")
    name = (
        F.when(status == "P", F.concat(F.lit("ipg"), F.col("o_orderkey") % 1000, F.lit(".zip")))
        .when(status == "O", F.concat(F.lit("IPG"), part, F.lit("_r1.ZIP")))
        .otherwise(F.concat(F.lit("ipg"), part, F.lit(".zip")))
    )
    named = table(spark, sf_dir, "orders").select("o_orderkey", name.alias("name"))
    return named.withColumns({"date_part": us_date_part(F.col("name")), "year": us_year(F.col("name"))})


@query(
    "D4_published_at",
    """
    SELECT event_id, CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d %H:%M') END AS published
    FROM events
    """,
)
def published(spark, sf_dir):
    text = F.when(F.col("event_type") == "error", "no time").otherwise(F.date_format("ts", PUBLISHED_AT))
    return table(spark, sf_dir, "events").select(
        "event_id", F.date_format(published_at(text), "yyyy-MM-dd HH:mm").alias("published")
    )


@query(
    "D5_two_digits",
    "SELECT DISTINCT week(o_orderdate)::INT AS week, lpad(week(o_orderdate)::VARCHAR, 2, '0') AS padded FROM orders",
)
def padded(spark, sf_dir):
    weeks = table(spark, sf_dir, "orders").select(F.weekofyear("o_orderdate").alias("week")).distinct()
    return weeks.withColumn("padded", two_digits(F.col("week")))


@query(
    "D6_key_year",
    """
    SELECT o_orderkey, key, CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y') END AS year FROM (
      SELECT *, CASE o_orderstatus WHEN 'P' THEN 'zipped' WHEN 'O' THEN strftime(o_orderdate, '%Y') || '/xmls/ipg010101.zip'
        ELSE strftime(o_orderdate, '%Y') || '/zipped/ipg' || strftime(o_orderdate, '%y%m%d') || '.zip' END AS key FROM orders)
    """,
)
def key_year(spark, sf_dir):
    year, status = F.date_format("o_orderdate", "yyyy"), F.col("o_orderstatus")
    name = F.concat(year, F.lit("/zipped/ipg"), F.date_format("o_orderdate", "yyMMdd"), F.lit(".zip"))
    key = F.when(status == "P", "zipped").when(status == "O", F.concat(year, F.lit("/xmls/ipg010101.zip"))).otherwise(name)
    keyed = table(spark, sf_dir, "orders").select("o_orderkey", key.alias("key"))
    return keyed.withColumn("year", us_key_year(F.col("key")))


@query(
    "D7_base_name",
    """
    SELECT page_id, list_last(string_split(url, '/')) AS name FROM pages
    """,
)
def base(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", base_name(F.col("url")).alias("name"))


@query(
    "D2_week_folders",
    """
    SELECT o_orderkey, path, CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y') END AS year,
      CASE WHEN o_orderstatus <> 'P' THEN lpad(week(o_orderdate)::VARCHAR, 2, '0') END AS week FROM (
      SELECT *, strftime(o_orderdate, '%Y') || '/xml/' || CASE o_orderstatus WHEN 'P' THEN 'other' ELSE
        strftime(o_orderdate, '%Y') || '_' || lpad(week(o_orderdate)::VARCHAR, 2, '0') END || '/' || o_orderkey || '.xml' AS path
      FROM orders)
    """,
)
def week_folders(spark, sf_dir):
    year = F.date_format("o_orderdate", "yyyy")
    folder = F.when(F.col("o_orderstatus") == "P", "other").otherwise(year_week(year, F.weekofyear("o_orderdate")))
    path = F.concat(year, F.lit("/xml/"), folder, F.lit("/"), "o_orderkey", F.lit(".xml"))
    paths = table(spark, sf_dir, "orders").select("o_orderkey", path.alias("path"))
    return paths.withColumns({"year": folder_year(F.col("path")), "week": folder_week(F.col("path"))})
