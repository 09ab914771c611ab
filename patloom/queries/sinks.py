"""Tables written and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from patloom.operators.skip import not_done
from patloom.plans.extract import run_extract
from patloom.queries.build import day
from patloom.queries.registry import query, table
from patloom.session import shared_folder
from patloom.sinks.tables import insert_if_absent, insert_into_bucketed, write_clustered, write_weekly
from patloom.sources.files import read_weekly


@query(
    "K1_weekly_table",
    """
    SELECT strftime(o_orderdate, '%Y') AS year, lpad(week(o_orderdate)::VARCHAR, 2, '0') AS week, o_orderkey,
      o_orderpriority || CASE WHEN year(o_orderdate) < 1998 THEN '+' ELSE '' END AS priority FROM orders
    """,
)
def weekly_table(spark, sf_dir):
    out = shared_folder(spark, "weekly")
    placed = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_orderpriority").alias("priority"),
        F.date_format("o_orderdate", "yyyy").alias("year"),
        F.lpad(F.weekofyear("o_orderdate").cast("string"), 2, "0").alias("week"),
    )
    write_weekly(placed, out)
    # Some weeks are written again; the others stay.
    write_weekly(placed.filter("year < '1998'").withColumn("priority", F.concat("priority", F.lit("+"))), out)
    return read_weekly(spark, out).select("year", "week", "o_orderkey", "priority")


@query(
    "K2_S7_date_extract",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS date_publication, o_totalprice FROM orders
    WHERE strftime(o_orderdate, '%Y%m%d') BETWEEN '19990101' AND '20001231'
    """,
)
def date_extract(spark, sf_dir):
    merged, out = shared_folder(spark, "merged"), shared_folder(spark, "extract")
    dated = table(spark, sf_dir, "orders").select("o_orderkey", day("o_orderdate").alias("date_publication"), "o_totalprice")
    # Sorted by day within files, so that the extract skips row groups.
    dated.repartitionByRange("date_publication").sortWithinPartitions("date_publication").write.parquet(merged)
    run_extract(spark, merged, out, "19990101", "20001231")
    return spark.read.parquet(out)


@query(
    "K2_clustered_extract",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS date_publication, o_totalprice FROM orders
    WHERE strftime(o_orderdate, '%Y%m%d') BETWEEN '19990310' AND '19990402'
    """,
)
def clustered_extract(spark, sf_dir):
    """A few weeks of a table that is kept in order of days."""
    merged, out = shared_folder(spark, "clustered"), shared_folder(spark, "extract")
    dated = table(spark, sf_dir, "orders").select("o_orderkey", day("o_orderdate").alias("date_publication"), "o_totalprice")
    write_clustered(dated, merged, ["date_publication", "o_orderkey"], group_bytes=64 << 10)
    run_extract(spark, merged, out, "19990310", "19990402")
    return spark.read.parquet(out)


INSERTED = """
    SELECT doc_id, source, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'first' ELSE 'second' END AS run
    FROM documents"""


def _insert_twice(spark, sf_dir, insert):
    """The labelled documents first, then all of them, twice over."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "source")
    labelled = documents.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    insert(labelled.withColumn("run", F.lit("first")))
    second = documents.withColumn("run", F.lit("second"))
    insert(second.unionByName(second))
    insert(documents.withColumn("run", F.lit("third")))


@query("K4_insert_if_absent", INSERTED)
def insert(spark, sf_dir):
    out = shared_folder(spark, "inserted")
    _insert_twice(spark, sf_dir, lambda rows: insert_if_absent(rows, out, "doc_id", ["run"]))
    return spark.read.parquet(out)


@query("K4_insert_into_bucketed", INSERTED)
def insert_bucketed(spark, sf_dir):
    path = shared_folder(spark, "bucketed")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    _insert_twice(spark, sf_dir, lambda rows: insert_into_bucketed(rows, name, "doc_id", ["run"], path=path))
    return spark.table(name)


@query(
    "K5_manifest",
    """
    SELECT year, week, n FROM (
      SELECT strftime(o_orderdate, '%Y') AS year, week(o_orderdate)::INT AS week, count(*) AS n, bool_or(o_orderstatus = 'P') AS open
      FROM orders GROUP BY 1, 2)
    WHERE (year, week) NOT IN (SELECT (strftime(l_shipdate, '%Y'), week(l_shipdate)::INT) FROM lineitem WHERE l_quantity > 49)
    """,
)
def manifest(spark, sf_dir):
    weeks = table(spark, sf_dir, "orders").groupBy(
        F.date_format("o_orderdate", "yyyy").alias("year"), F.weekofyear("o_orderdate").alias("week")
    )
    done = table(spark, sf_dir, "lineitem").filter("l_quantity > 49").select(
        F.date_format("l_shipdate", "yyyy").alias("year"), F.weekofyear("l_shipdate").alias("week")
    )
    return not_done(weeks.agg(F.count(F.lit(1)).alias("n")), done.distinct(), ["year", "week"])
