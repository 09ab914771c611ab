"""New archives as a file stream: the checkpoint remembers which were read.

Each micro-batch may be run again after a failure. Both sinks bear that: the insert skips what is
there, the quarantine of a batch replaces itself. A batch is known by its stream, which is what the checkpoint
names it, and its number; so streams may share a quarantine, and a new checkpoint leaves the rows of an
earlier one in place.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from patloom.functions.ep import parse_ep
from patloom.plans.ingest import named_archives, one_per_week
from patloom.plans.us import us_archives, write_archives
from patloom.schemas import EP_RECORD
from patloom.sinks.keyed import insert_by_index
from patloom.sinks.tables import CODEC, remove, write_weekly
from patloom.sources.archives import MOST_PORTIONS, PORTION_BYTES, read_nested

EP_ORDER = ("archive", "member", "entry")
FILES = "path string, modificationTime timestamp, length bigint, content binary"
# Spark keeps what an execution shuffled until the driver happens to collect its garbage; so it goes with the execution.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def archive_stream(spark: SparkSession, folder: str, glob: str | None = None, per_batch: int | None = None) -> DataFrame:
    """Files as they appear: path, modificationTime, length. The jobs below pick archives by name, in any case."""
    reader = spark.readStream.format("binaryFile").schema(FILES).option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.load(folder).drop("content")


def _start(stream: DataFrame, each, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave to the stream of a checkpoint: the same after a restart, another for a new checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def _portions(archives: DataFrame) -> list[DataFrame]:
    """Archives (path, length) in the order of their names, some bytes or one archive at a time; one portion where there are none."""
    spark = archives.sparkSession
    rows, portions, held = archives.select("file_name", "path", "length").collect(), [[]], 0  # names, as the stream's source holds them
    most = max(PORTION_BYTES * spark.sparkContext.defaultParallelism, sum(row["length"] for row in rows) // MOST_PORTIONS)
    for row in sorted(rows, key=lambda row: row["file_name"]):
        if portions[-1] and held + row["length"] > most:
            portions.append([])
            held = 0
        portions[-1].append((row["path"], row["length"]))
        held += row["length"]
    return [spark.createDataFrame(portion, "path string, length bigint") for portion in portions]


def insert_ep_stream(
    archives: DataFrame,
    table: str,
    quarantine: str,
    checkpoint: str,
    doc_rule: bool = True,
    tasks: int | None = None,
    available_now: bool = True,
    insert: Callable = insert_by_index,
) -> StreamingQuery:
    """Insert the records of new European archives by document id, if absent; keep bad ones aside.

    Archives are chosen as in the batch job, among those of a micro-batch, and are read in portions of some bytes for each core, by name:
    of documents with one id the first is kept, as if all came at once. A portion is parsed once, into a table beside the quarantine that both
    sinks read, and that the next portion replaces; after the batch only its bad rows stay there, until the stream's next batch. An error
    other than that of bad content fails the stream.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        spark.conf.set(CLEANUP, "true")  # the session is the stream's own
        stream = stream_id(spark, checkpoint)
        staged = f"{quarantine.rstrip('/')}-staged/{stream}"
        remove(spark, staged)  # whole, so that nothing of another batch is left
        columns, aside = [*EP_ORDER, *EP_RECORD.names], [*EP_ORDER, "error", "bad_xml"]
        for portion in _portions(one_per_week(named_archives(batch))):
            rows = parse_ep(read_nested(portion, doc_rule, tasks))
            rows.write.mode("overwrite").option("compression", CODEC).parquet(f"{staged}/rows")
            parsed = spark.read.schema(rows.schema).parquet(f"{staged}/rows")
            insert(parsed.filter(F.col("error").isNull()), table, "doc_id", EP_ORDER, columns)
            bad = parsed.filter(F.col("error").isNotNull()).select(*aside)
            bad.write.mode("append").option("compression", CODEC).parquet(f"{staged}/bad")
        bad = spark.read.schema(bad.schema).parquet(f"{staged}/bad")
        write_weekly(bad.withColumns({"stream": F.lit(stream), "batch_id": F.lit(batch_id)}), quarantine, by=("stream", "batch_id"))
        remove(spark, f"{staged}/rows")

    return _start(archives, each, checkpoint, available_now)


def write_us_stream(
    archives: DataFrame, path: str, checkpoint: str, tasks: int | None = None, available_now: bool = True
) -> StreamingQuery:
    """Write the records of new US archives, each archive on its own; files of other names are passed over."""

    def each(batch: DataFrame, batch_id: int) -> None:
        write_archives(us_archives(batch), path, tasks=tasks)

    return _start(archives, each, checkpoint, available_now)
