"""Session settings and the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that suit the jobs here. A value the cluster already sets is left alone.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Whole XML documents are wide rows: few of them make a full Arrow batch.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


def local_session(cores: int | str = "*", memory: str = "8g", **conf: str) -> SparkSession:
    """A session for tests and the bench. On a cluster use spark-submit and `apply_defaults`."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("patloom")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set those of `DEFAULTS` that the cluster has not set itself."""
    given = {key for key, _ in spark.sparkContext.getConf().getAll()}
    for key, value in DEFAULTS.items():
        if key not in given:
            spark.conf.set(key, value)
    return spark


def small_batches(spark: SparkSession, rows: int = 500, size: int = 4 << 20) -> None:
    """Bound the rows and bytes that a Python worker is handed at once, unless the session's own bounds are lower.

    A worker holds a batch several times over (as bytes, as Python objects, as the result), and a task may have a worker for each
    of its Python steps; so this, not the size of the input, says what they need.
    """
    for key, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        key = f"spark.sql.execution.arrow.{key}"
        own = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
        if own <= 0 or own > most:
            spark.conf.set(key, str(most))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one that the cluster names in `spark.checkpoint.dir`.

    Only a local session may do without that setting; it then gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="patloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
