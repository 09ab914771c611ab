"""Insert if absent at a cost that follows the input: an index beside the table says which files may hold a key.

Per file of the table the index keeps the number of rows, the least and greatest key and a Bloom filter of the keys.
An insert opens only those files whose range and filter meet an incoming key. New rows are written in ranges
of the key, so that the ranges of files hardly overlap. The index is brought up to date at the begin of an insert, from the files it
does not know: so a run that broke off before its index was written does no harm, and a table that never had one gets it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patloom.operators.dedup import first_by_key
from patloom.operators.skip import existing, not_done
from patloom.schemas import ORIGIN
from patloom.sinks.tables import CODEC, read_or_none

BITS_PER_KEY = 16
MOST_BITS = 1 << 26  # of a file's filter, 8 MB
MOST_ROWS = 1000  # of one key, that may go to a task before the first is picked
MOST_KEYS = 1 << 20  # incoming keys that are sent to the tasks; with more of them only the ranges choose
PROBES = (1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _places(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(hashes * np.uint64(probe)) >> np.uint64(64 - bits) for probe in PROBES]


def bloom(hashes: np.ndarray) -> bytes:
    """A Bloom filter of 64-bit hashes, a power of two of bits."""
    bits = min(MOST_BITS, max(64, BITS_PER_KEY * len(hashes))).bit_length()
    words = np.zeros(1 << (bits - 6), np.uint64)
    for place in _places(hashes, bits):
        np.bitwise_or.at(words, (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
    return words.tobytes()


def may_hold(kept: bytes, hashes: np.ndarray) -> bool:
    """Whether a filter may hold one of the hashes."""
    words, there = np.frombuffer(kept, np.uint64), np.ones(len(hashes), bool)
    for place in _places(hashes, (64 * len(words)).bit_length() - 1):
        there &= (words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
    return bool(there.any())


def index_path(path: str) -> str:
    return f"{path.rstrip('/')}-keys"


def _shape(kind: str) -> str:
    return f"file string, rows bigint, least {kind}, greatest {kind}, bits binary"


def _name(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def files_of(spark: SparkSession, path: str) -> dict[str, str]:
    """The files of a table by their names. A file's name is its own; Spark never writes one twice."""
    table = read_or_none(spark, path)
    return {} if table is None else {_name(file): file for file in table.inputFiles()}


def _described(table: pa.Table) -> pa.Table:
    file, table = table.column("file")[0], table.filter(table.column("key").is_valid())
    keys = table.column("key")
    kept = bloom(np.unique(table.column("hash").to_numpy().view(np.uint64)))
    ends = pa.compute.min_max(keys)
    row = {"file": file, "rows": len(table), "least": ends["min"], "greatest": ends["max"], "bits": kept}
    kinds = {"file": pa.string(), "rows": pa.int64(), "least": keys.type, "greatest": keys.type, "bits": pa.binary()}
    return pa.table({name: pa.array([getattr(row[name], "as_py", lambda v=row[name]: v)()], kind) for name, kind in kinds.items()})


def update_index(spark: SparkSession, path: str, key: str) -> DataFrame | None:
    """The index of a table, with the files that it did not know; None for no table. Only their keys are read."""
    files = files_of(spark, path)
    if not files:
        return None
    kind = dict(spark.read.parquet(next(iter(files.values()))).dtypes)[key]
    known = read_or_none(spark, index_path(path), _shape(kind))
    names = set() if known is None else {row["file"] for row in known.select("file").collect()}
    new = [file for name, file in files.items() if name not in names]
    if new:
        rows = spark.read.schema(f"`{key}` {kind}").parquet(*new)
        keyed = rows.select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"), F.col(key).alias("key")).filter("key IS NOT NULL")
        # A file without keys is described as well, else every insert would read it again.
        every = spark.createDataFrame([(_name(file),) for file in new], "file string").withColumn("key", F.lit(None).cast(kind))
        # The keys of one file meet in one task, as they do when it is read.
        described = keyed.unionByName(every).withColumn("hash", F.xxhash64("key")).groupBy("file").applyInArrow(_described, _shape(kind))
        described.write.mode("append").parquet(index_path(path))
        known = spark.read.schema(_shape(kind)).parquet(index_path(path))
    return known


def _holding(hashes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [may_hold(bits, hashes.value) for bits in batch.column(1).to_pylist()]
            yield batch.select([0]).filter(pa.array(kept, pa.bool_()))

    return run


def candidate_files(incoming: DataFrame, path: str, key: str) -> list[str]:
    """The files of a table that may hold a key of the incoming rows: whole paths, all others surely hold none."""
    spark = incoming.sparkSession
    index = update_index(spark, path, key)
    keys = incoming.select(F.col(key).alias("key")).filter("key IS NOT NULL").distinct()
    if index is None:
        return []
    ends = keys.agg(F.min("key").alias("least"), F.max("key").alias("greatest"), F.count(F.lit(1)).alias("n")).first()
    if not ends["n"]:
        return []
    meeting = index.filter((F.col("greatest") >= F.lit(ends["least"])) & (F.col("least") <= F.lit(ends["greatest"])))
    if ends["n"] <= MOST_KEYS:
        hashes = keys.select(F.xxhash64("key").alias("hash")).toArrow()["hash"].to_numpy().view(np.uint64)
        sent = spark.sparkContext.broadcast(hashes)
        meeting = meeting.select("file", "bits").mapInArrow(_holding(sent), "file string")
    names = {row["file"] for row in meeting.select("file").collect()}
    return [file for name, file in files_of(spark, path).items() if name in names]


def insert_by_index(
    incoming: DataFrame, path: str, key: str = "doc_id", order: Sequence[str] = ORIGIN, columns: Sequence[str] | None = None
) -> None:
    """As `insert_if_absent`: append the first row of each key that the table does not hold, in one atomic write.

    Of the table only the files that may hold an incoming key are opened, and of these the key column. What is there already is
    found by keys alone, so no row moves where nothing is new. Rows move once, to their range of the key, where the first is
    picked and sorted in; a key of very many rows is reduced in each task before. `incoming` is read several times, so give a
    table. A null key is never there. There must be one writer at a time.
    """
    spark = incoming.sparkSession
    kept = incoming.select(*columns) if columns else incoming
    files = candidate_files(incoming, path, key)
    counted = incoming.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("often"))
    sizes = counted.agg(F.count("key").alias("keys"), F.max("often").alias("most")).first()
    rows = _absent(incoming, spark.read.schema(kept.schema).parquet(*files), key, sizes["keys"]) if files else incoming
    if (sizes["most"] or 0) > MOST_ROWS:
        rows = first_by_key(rows, [key], order).repartitionByRange(key)
    else:  # a range holds all rows of a key, so neither the choice nor the sort needs another shuffle
        rows = first_by_key(rows.repartitionByRange(key), [key], order)
    rows = rows.select(*columns) if columns else rows
    rows.sortWithinPartitions(key).write.mode("append").option("compression", CODEC).parquet(path)
    update_index(spark, path, key)


def _absent(incoming: DataFrame, target: DataFrame, key: str, keys: int) -> DataFrame:
    """The rows whose key the target does not hold; `keys` is how many there are. Only where some are held and some not, rows move."""
    held = existing(target, incoming, [key]).select(key).distinct()
    known = held.count()
    if not known:
        return incoming
    return incoming.filter(F.col(key).isNull()) if known == keys else not_done(incoming, held, [key], unique=True)
