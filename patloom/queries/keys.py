"""Dedup, latest, joins, pooling."""

from __future__ import annotations

from pyspark.sql import functions as F

from patloom.functions.names import PUBLISHED_AT
from patloom.operators.dedup import first_by_key, latest_by_key
from patloom.operators.pooling import mean_by_position, merged_means
from patloom.operators.skip import existing, not_done
from patloom.queries.registry import query, table
from patloom.sources.listing import candidate_names, first_existing, latest_entry


@query(
    "A1_first_per_text",
    """
    SELECT doc_id, text, source FROM (
      SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS n FROM documents) WHERE n = 1
    """,
)
def first_per_text(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    # Long keys are hashed once: the rows meet and are sorted by 64 bytes, not by whole texts.
    keyed = documents.withColumn("__key", F.sha2("text", 256))
    return first_by_key(keyed, ["__key"], ["doc_id"]).drop("__key")


@query(
    "A1_null_is_one_key",
    """
    SELECT o_orderkey, o_custkey, status FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey, status ORDER BY o_orderkey) AS n
      FROM (SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS status FROM orders)) WHERE n = 1
    """,
)
def null_is_one_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status")
    )
    return first_by_key(orders, ["o_custkey", "status"], ["o_orderkey"])


@query(
    "A1_null_keys_kept",
    """
    SELECT o_orderkey, status FROM (
      SELECT *, row_number() OVER (PARTITION BY status ORDER BY o_orderkey) AS n
      FROM (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders)) WHERE n = 1 OR status IS NULL
    """,
)
def null_keys_kept(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"))
    return first_by_key(orders, ["status"], ["o_orderkey"], keep_null_keys=True)


@query(
    "A2_D4_latest_archive",
    """
    SELECT event_id, file_name, published_at FROM (
      SELECT event_id, event_type || CASE WHEN event_type = 'view' THEN '.ZIP' ELSE '.txt' END AS file_name,
             strftime(ts, '%Y-%m-%d %H:%M:00') AS published_at FROM events)
    WHERE file_name LIKE '%.ZIP' ORDER BY published_at DESC, event_id LIMIT 1
    """,
)
def latest_archive(spark, sf_dir):
    ending = F.when(F.col("event_type") == "view", ".ZIP").otherwise(".txt")
    listing = table(spark, sf_dir, "events").select(
        "event_id",
        F.concat("event_type", ending).alias("file_name"),
        F.date_format("ts", PUBLISHED_AT).alias("published_at"),
    )
    latest = latest_entry(listing, pos="event_id")
    return latest.withColumn("published_at", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss"))


@query(
    "A2_latest_per_user",
    """
    SELECT user_id, event_id, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS n FROM events) WHERE n = 1
    """,
)
def latest_per_user(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return latest_by_key(events, ["user_id"], "ts", ["event_id"]).drop("ts")


@query(
    "A3_mean_by_position",
    """
    SELECT label, pos::INT AS pos, round(avg(value), 6) AS mean FROM (
      SELECT label, unnest(range(len(embedding))) AS pos, unnest(embedding)::DOUBLE AS value FROM embeddings)
    GROUP BY label, pos
    """,
)
def pooled_by_position(spark, sf_dir):
    means = mean_by_position(table(spark, sf_dir, "embeddings"), ["label"], "embedding")
    return means.select("label", "pos", F.round("mean", 6).alias("mean"))


@query(
    "A3_mean_vectors",
    """
    SELECT label, count(*) AS width, round(sum((pos + 1) * mean), 6) AS weighted FROM (
      SELECT label, pos, avg(value) AS mean FROM (
        SELECT label, unnest(range(len(embedding))) AS pos, unnest(embedding)::DOUBLE AS value FROM embeddings)
      GROUP BY label, pos) GROUP BY label
    """,
)
def pooled_vectors(spark, sf_dir):
    vectors = merged_means(table(spark, sf_dir, "embeddings"), ["label"], "embedding")
    numbered = F.transform("vector", lambda value, at: value * (at + 1))
    weighted = F.aggregate(numbered, F.lit(0.0), lambda sum_, value: sum_ + value)
    width = F.size("vector").cast("bigint").alias("width")
    return vectors.select("label", width, F.round(weighted, 6).alias("weighted"))


@query(
    "J1_anti",
    "SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
)
def anti(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "source")
    return not_done(documents, table(spark, sf_dir, "labels"), ["doc_id"])


@query(
    "J2_semi",
    "SELECT doc_id, source FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
)
def semi(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "source")
    return existing(documents, table(spark, sf_dir, "labels"), ["doc_id"])


LISTED = """
  weeks AS (SELECT strftime(o_orderdate, '%Y') AS year, week(o_orderdate) AS week, min(o_orderkey) AS first_order,
              count(*) AS n FROM orders GROUP BY 1, 2),
  listing AS (SELECT 'EPRTBJV' || year || '0000' || lpad(week::VARCHAR, 2, '0') || '001001.zip' AS file_name
              FROM weeks WHERE first_order > n
              UNION ALL
              SELECT 'EPRTBJV' || year || '0000' || lpad(week::VARCHAR, 2, '0') || '001001.tar' FROM weeks),
  candidates AS (SELECT year, lpad(w::VARCHAR, 2, '0') AS week, rank,
              'EPRTBJV' || year || '0000' || lpad(w::VARCHAR, 2, '0') || '001001' || ext AS file_name
              FROM (SELECT DISTINCT year FROM weeks), range(1, 54) AS t(w), (VALUES (0, '.zip'), (1, '.tar')) AS e(rank, ext))
"""


def _listing(spark, sf_dir):
    """Archive names of the weeks that have orders: a tar for each, a zip for some."""
    weeks = (
        table(spark, sf_dir, "orders")
        .groupBy(F.date_format("o_orderdate", "yyyy").alias("year"), F.weekofyear("o_orderdate").alias("week"))
        .agg(F.min("o_orderkey").alias("first_order"), F.count(F.lit(1)).alias("n"))
    )
    zips = F.when(F.col("first_order") > F.col("n"), F.array(F.lit(".zip"), F.lit(".tar"))).otherwise(F.array(F.lit(".tar")))
    named = weeks.select("year", "week", F.explode(zips).alias("extension"))
    stem = F.concat(F.lit("EPRTBJV"), "year", F.lit("0000"), F.lpad(F.col("week").cast("string"), 2, "0"), F.lit("001001"))
    return named.select("year", F.concat(stem, "extension").alias("file_name"))


@query(
    "S8_D5_candidates",
    f"""WITH {LISTED}
    SELECT year, week, file_name FROM (
      SELECT year, week, file_name, row_number() OVER (PARTITION BY year, week ORDER BY rank) AS n
      FROM candidates WHERE file_name IN (SELECT file_name FROM listing)) WHERE n = 1""",
)
def candidates(spark, sf_dir):
    listing = _listing(spark, sf_dir)
    years = listing.select("year").distinct()
    return first_existing(candidate_names(years), listing).select("year", "week", "file_name")


@query(
    "J2_missing_candidates",
    f"WITH {LISTED} SELECT year, week, file_name FROM candidates WHERE file_name NOT IN (SELECT file_name FROM listing)",
)
def missing_candidates(spark, sf_dir):
    listing = _listing(spark, sf_dir)
    names = candidate_names(listing.select("year").distinct()).select("year", "week", "file_name")
    return not_done(names, listing, ["file_name"])
