"""Writing tables: by week, as an extract, and insert if absent."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patloom.operators.dedup import first_by_key
from patloom.operators.skip import not_done
from patloom.schemas import ORIGIN

GROUP_BYTES = 16 << 20  # of a row group, where ranges are to be read
MOST_CONTESTED = 100_000  # keys of which rows are to be chosen, that are sent to the tasks
CONTESTED = "held OR often > 1"
CODEC = "zstd"  # of tables that hold whole texts: two thirds of the bytes of Spark's default, half for raw XML


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at a path, as the file system says."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(at)


def remove(spark: SparkSession, path: str) -> None:
    """Delete what is at a path, if there is something."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def read_or_none(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The table at a path; None only where the path does not exist. Any other problem is raised.

    The file system is asked first: a read that fails is also told to Spark's listeners, which log it as an error.
    """
    if not exists(spark, path):
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_weekly(df: DataFrame, path: str, by: Sequence[str] = ("year", "week"), balance: bool = True) -> None:
    """Write by year and week. Weeks in the data replace what was there, other weeks stay.

    The rebalance, a shuffle, lets Spark split a large week over tasks and join small ones into
    one file. Without it each task writes a file for each week it holds: right where the rows lie
    together already.
    """
    balanced = df.hint("rebalance", *by) if balance else df
    writer = balanced.write.partitionBy(*by).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("compression", CODEC).parquet(path)


def write_clustered(df: DataFrame, path: str, by: Sequence[str], group_bytes: int = GROUP_BYTES) -> None:
    """Write a table whose files hold ranges of `by` and are sorted by it, in small row groups.

    A read of a range then opens few files, and of these few row groups. A value with very many rows may fill
    several files only if a further column of `by` tells its rows apart.
    """
    ranged = df.repartitionByRange(*by).sortWithinPartitions(*by)
    ranged.write.mode("overwrite").option("parquet.block.size", group_bytes).parquet(path)


def write_extract(df: DataFrame, path: str, skip_empty: bool = False, source: DataFrame | None = None) -> bool:
    """Write a table, all of it or nothing; whether it was written.

    With `skip_empty` no row means no file; rows of an earlier extract at the path go. `source` is what to look
    at for that, if not the table itself.
    """
    if skip_empty and (source if source is not None else df).isEmpty():
        if read_or_none(df.sparkSession, path) is not None:
            (source if source is not None else df).write.mode("overwrite").parquet(path)
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def absent_rows(incoming: DataFrame, target: DataFrame | None, key: str, order: Sequence[str]) -> DataFrame:
    """The first incoming row of each key that the target does not hold."""
    fresh = first_by_key(incoming, [key], order)
    return fresh if target is None else not_done(fresh, target, [key], unique=True)


def insert_if_absent(
    incoming: DataFrame, path: str, key: str = "doc_id", order: Sequence[str] = ORIGIN, columns: Sequence[str] | None = None
) -> None:
    """Append the rows whose key is not in the table yet, one per key, in one atomic write.

    A rerun adds nothing, so a batch that is retried after a failure does no harm. There must be
    one writer at a time. Keys alone tell which rows need a choice, those whose key is there already or comes more than once: these
    move, the others are written by the tasks that read them, and where no key is new nothing more is read. With too many such keys
    to send to the tasks all rows move. `incoming` is read several times, so give a table.
    """
    spark = incoming.sparkSession
    kept = incoming.select(*columns) if columns else incoming
    target = read_or_none(spark, path, kept.schema)
    if key in incoming.columns:
        met = _met(incoming, target, key)
        sizes = met.agg(F.count_if(~F.col("held")).alias("new"), F.count_if(F.expr(CONTESTED)).alias("contested")).first()
        if target is not None and not sizes["new"]:
            return
        if not sizes["contested"]:
            rows = incoming
        elif sizes["contested"] <= MOST_CONTESTED:
            sent = F.broadcast(met.filter(CONTESTED).select("__key", F.lit(True).alias("__contested")))
            marked = incoming.join(sent, F.col(key).eqNullSafe(F.col("__key")), "left")
            choice = absent_rows(marked.filter("__contested"), target, key, order)
            rows = marked.filter("__contested IS NULL").unionByName(choice).drop("__key", "__contested")
        else:
            rows = absent_rows(incoming, target, key, order)
    else:
        rows = absent_rows(incoming, target, key, order)
    (rows.select(*columns) if columns else rows).write.mode("append").parquet(path)


def _met(incoming: DataFrame, target: DataFrame | None, key: str) -> DataFrame:
    """(__key, often, held): each incoming key with its number of rows, and whether the target holds it. Null is a key, and never held."""
    counted = incoming.groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("often"))
    if target is None:
        return counted.withColumn("held", F.lit(False))
    there = target.select(F.col(key).alias("__key"), F.lit(True).alias("held")).distinct()
    return counted.join(there, "__key", "left").withColumn("held", F.coalesce("held", F.lit(False)))


def insert_into_bucketed(
    incoming: DataFrame,
    table: str,
    key: str = "doc_id",
    order: Sequence[str] = ORIGIN,
    columns: Sequence[str] | None = None,
    buckets: int | None = None,
    path: str | None = None,
) -> None:
    """As `insert_if_absent` for a catalog table bucketed by the key.

    The stored side of the anti join is read in its buckets and not shuffled, so the cost of an
    insert follows the size of what comes in. Spark takes that way only if the buckets are no
    fewer than the shuffle partitions; without a number they are as many. `path` is where a new
    table is kept, if not in the warehouse.
    """
    spark = incoming.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    target = spark.table(table) if spark.catalog.tableExists(table) else None
    rows = absent_rows(incoming, target, key, order)
    rows = (rows.select(*columns) if columns else rows).repartition(buckets, key)
    writer = rows.write.bucketBy(buckets, key).sortBy(key).mode("append")
    (writer.option("path", path) if path and target is None else writer).saveAsTable(table)


def insert_over_jdbc(
    incoming: DataFrame,
    connection: Mapping[str, str],
    table: str,
    key: str = "doc_id",
    order: Sequence[str] = ORIGIN,
    columns: Sequence[str] | None = None,
) -> None:
    """As `insert_if_absent` for a table in an outside database.

    `connection` holds the options of Spark's JDBC source (url, driver, user, password, and the
    partitioning of the key read). Take secrets from the environment, never from code.
    """
    reader = incoming.sparkSession.read.format("jdbc").options(**connection)
    target = reader.option("dbtable", table).load().select(key)
    rows = absent_rows(incoming, target, key, order)
    rows = rows.select(*columns) if columns else rows
    rows.write.format("jdbc").options(**connection).option("dbtable", table).mode("append").save()
