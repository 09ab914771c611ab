"""Scans, filters, projections, counts, unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from patloom.functions.names import is_archive, is_document
from patloom.functions.us import format_cpc, full_cpc
from patloom.operators.counts import counts, stacked
from patloom.queries.build import day
from patloom.queries.registry import query, table
from patloom.sources.files import in_range


@query(
    "S7_F1_date_range",
    """
    SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y%m%d') AS ship_day, l_quantity
    FROM lineitem WHERE strftime(l_shipdate, '%Y%m%d') BETWEEN '19970101' AND '19991231'
    """,
)
def date_range(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity")
    # The same range on the stored column: this one reaches the Parquet scan.
    stored = items.filter((F.col("l_shipdate") >= "1997-01-01") & (F.col("l_shipdate") < "2000-01-01"))
    return stored.select("l_orderkey", "l_linenumber", day("l_shipdate").alias("ship_day"), "l_quantity").filter(
        in_range(F.col("ship_day"), "19970101", "19991231")
    )


@query(
    "F1_empty_and_null_outside",
    """
    SELECT o_orderkey, day FROM (
      SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN '' WHEN 'O' THEN strftime(o_orderdate, '%Y%m%d') END AS day
      FROM orders) WHERE day BETWEEN '00000000' AND '99999999'
    """,
)
def empty_and_null(spark, sf_dir):
    status = F.col("o_orderstatus")
    dated = F.when(status == "P", "").when(status == "O", day("o_orderdate"))
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", dated.alias("day"))
        .filter(in_range(F.col("day"), "00000000", "99999999"))
    )


@query(
    "F2_valid_number",
    """
    SELECT doc_id, number, TRY_CAST(number AS BIGINT) AS doc_number FROM (
      SELECT doc_id, CASE lang WHEN 'de' THEN doc_id || 'x' WHEN 'fr' THEN '' WHEN 'es' THEN '00' || doc_id
                     ELSE CAST(doc_id AS VARCHAR) END AS number FROM documents)
    WHERE regexp_matches(number, '^[0-9]+$')
    """,
)
def valid_number(spark, sf_dir):
    text, lang = F.col("doc_id").cast("string"), F.col("lang")
    number = F.when(lang == "de", F.concat(text, F.lit("x"))).when(lang == "fr", "")
    number = number.when(lang == "es", F.concat(F.lit("00"), text)).otherwise(text)
    numbered = table(spark, sf_dir, "documents").select("doc_id", number.alias("number"))
    valid = numbered.filter(F.col("number").rlike("^[0-9]+$"))
    return valid.withColumn("doc_number", F.col("number").try_cast("bigint"))


@query(
    "F4_full_cpc",
    """
    SELECT p_partkey, p_brand || p_type || p_name || ' ' || p_size || '/' || floor(p_retailprice)::BIGINT AS cpc
    FROM part WHERE p_type <> 'PROMO' AND p_size > 5
    """,
)
def full_entries(spark, sf_dir):
    entry = F.struct(
        F.col("p_brand").alias("section"),
        F.when(F.col("p_type") != "PROMO", F.col("p_type")).alias("class"),
        F.col("p_name").alias("subclass"),
        F.when(F.col("p_size") > 5, F.col("p_size").cast("string")).alias("main_group"),
        F.floor("p_retailprice").cast("string").alias("subgroup"),
    )
    kept = table(spark, sf_dir, "part").select("p_partkey", full_cpc(F.array(entry)).alias("entries"))
    return kept.select("p_partkey", F.explode("entries").alias("e")).select("p_partkey", format_cpc(F.col("e")).alias("cpc"))


@query(
    "F5_archive_names",
    """
    SELECT o_orderkey, name FROM (
      SELECT o_orderkey, 'w' || o_orderkey || CASE o_orderpriority WHEN '1-URGENT' THEN '.zip' WHEN '2-HIGH' THEN '.TAR'
        WHEN '3-MEDIUM' THEN '.Zip' WHEN '5-LOW' THEN '.zip.txt' ELSE 'zip' END AS name FROM orders)
    WHERE regexp_matches(lower(name), '[.](zip|tar)$')
    """,
)
def archive_names(spark, sf_dir):
    priority = F.col("o_orderpriority")
    ending = F.when(priority == "1-URGENT", ".zip").when(priority == "2-HIGH", ".TAR").when(priority == "3-MEDIUM", ".Zip")
    ending = ending.when(priority == "5-LOW", ".zip.txt").otherwise("zip")
    named = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("w"), "o_orderkey", ending).alias("name"))
    return named.filter(is_archive(F.col("name")))


@query(
    "S1_document_names",
    """
    SELECT doc_id, name FROM (
      SELECT doc_id, source || '/' || doc_id || CASE lang WHEN 'de' THEN 'TOC.xml' WHEN 'fr' THEN '.XML' ELSE '.xml' END AS name
      FROM documents)
    WHERE suffix(name, '.xml') AND NOT suffix(name, 'TOC.xml')
    """,
)
def document_names(spark, sf_dir):
    ending = F.when(F.col("lang") == "de", "TOC.xml").when(F.col("lang") == "fr", ".XML").otherwise(".xml")
    name = F.concat("source", F.lit("/"), "doc_id", ending)
    return table(spark, sf_dir, "documents").select("doc_id", name.alias("name")).filter(is_document(F.col("name")))


@query("F6_projection", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def projection(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")


@query("F7_derived_column", "SELECT *, l_extendedprice * (1 - l_discount) AS net FROM lineitem")
def derived(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").withColumn("net", F.col("l_extendedprice") * (1 - F.col("l_discount")))


@query("A4_counts", "SELECT source, lang, count(*) AS n FROM documents GROUP BY source, lang")
def counted(spark, sf_dir):
    return counts(table(spark, sf_dir, "documents"), ["source", "lang"])


@query(
    "A4_kept_per_year",
    """
    SELECT year(o_orderdate)::INT AS year, count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS kept
    FROM orders GROUP BY 1
    """,
)
def kept_per_year(spark, sf_dir):
    kept = F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("kept")
    years = table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year"))
    return years.agg(F.count(F.lit(1)).alias("total"), kept)


@query(
    "U1_union",
    """
    SELECT doc_id, text, CAST(NULL AS VARCHAR) AS source FROM documents WHERE lang = 'en'
    UNION ALL SELECT doc_id, text, source FROM documents WHERE lang = 'de'
    """,
)
def union(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    english = documents.filter("lang = 'en'").select("doc_id", "text")
    return stacked(english, documents.filter("lang = 'de'").select("doc_id", "text", "source"))
