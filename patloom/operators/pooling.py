"""Mean vectors."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

MOST_CELLS = 1 << 22  # of sums that a task holds


def mean_by_position(df: DataFrame, keys: Sequence[str], vector: str) -> DataFrame:
    """Mean of each vector position per key, as rows (keys, pos, mean).

    The values are summed in each task before the shuffle, so a hot key costs one row per
    position and task.
    """
    long = df.select(*keys, F.posexplode(vector).alias("pos", "value"))
    return long.groupBy(*keys, "pos").agg(F.avg(F.col("value").cast("double")).alias("mean"))


def mean_vectors(df: DataFrame, keys: Sequence[str], vector: str, out: str = "vector") -> DataFrame:
    """Mean vector per key, by expressions only. A group gathered here holds one row per vector position, no more."""
    gathered = mean_by_position(df, keys, vector).groupBy(*keys).agg(F.collect_list(F.struct("pos", "mean")).alias(out))
    return gathered.withColumn(out, F.transform(F.array_sort(out), lambda at: at["mean"]))


class _Sums:
    """Sums and counts of vectors by key, handed on when they take too much room."""

    def __init__(self, schema: pa.Schema) -> None:
        self.schema, self.held, self.cells = schema, {}, 0

    def add(self, key: tuple, sums: np.ndarray, counts: np.ndarray) -> None:
        known = self.held.get(key)
        if known is None:
            self.held[key] = [sums.copy(), counts.copy()]
            self.cells += len(sums)
            return
        for at, more in enumerate((sums, counts)):
            if len(more) > len(known[at]):
                known[at] = np.concatenate([known[at], np.zeros(len(more) - len(known[at]), known[at].dtype)])
            known[at][: len(more)] += more

    def rows(self) -> pa.RecordBatch:
        keys = list(zip(*self.held)) or [()] * (len(self.schema) - 2)
        columns = [pa.array(list(values), field.type) for values, field in zip(keys, self.schema)]
        columns += [pa.array([pair[at] for pair in self.held.values()], self.schema.field(len(columns) + at).type) for at in (0, 1)]
        self.held, self.cells = {}, 0
        return pa.RecordBatch.from_arrays(columns, schema=self.schema)


def _vectors(batch: pa.RecordBatch, at: int) -> list[np.ndarray]:
    """A column of lists as arrays; nulls inside as NaN."""
    column = batch.column(at)
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(pa.compute.fill_null(pa.compute.list_value_length(column), 0))
    return np.split(flat, ends[:-1]) if len(column) else []


def _partial_sums(keys: int, schema: pa.Schema):
    """(keys, vector) to sums by key, in bounded room."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(schema)
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(keys))) if keys else [()] * len(batch)
            places: dict[tuple, list[int]] = {}
            vectors = _vectors(batch, keys)
            for i, key in enumerate(rows):
                if len(vectors[i]):
                    places.setdefault((*key, len(vectors[i])), []).append(i)
            gaps = batch.column(keys).flatten()
            gaps = pa.compute.is_null(gaps).to_numpy(zero_copy_only=False) if gaps.null_count else None
            held = np.split(gaps, np.cumsum([len(v) for v in vectors])[:-1]) if gaps is not None else None
            for key, at in places.items():
                matrix = np.stack([vectors[i] for i in at])
                if held is None:
                    sums.add(key[:-1], matrix.sum(axis=0), np.full(matrix.shape[1], len(at)))
                else:
                    there = ~np.stack([held[i] for i in at])
                    sums.add(key[:-1], np.where(there, matrix, 0).sum(axis=0), there.sum(axis=0))
            if sums.cells > MOST_CELLS:
                yield sums.rows()
        yield sums.rows()

    return run


def _merged_sums(keys: int, schema: pa.Schema):
    """Sums in order of their keys to one row per key; a key at a time is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, last = _Sums(schema), None
        for batch in batches:
            rows = list(zip(*(batch.column(i).to_pylist() for i in range(keys)))) if keys else [()] * len(batch)
            for key, total, n in zip(rows, _vectors(batch, keys), _vectors(batch, keys + 1)):
                if key != last and sums.cells > MOST_CELLS:
                    yield sums.rows()
                sums.add(key, total, n)
                last = key
        yield sums.rows()

    return run


def merged_means(df: DataFrame, keys: Sequence[str], vector: str, out: str = "vector") -> DataFrame:
    """Mean vector per key, by position, for keys with very many vectors.

    A task adds up its vectors and hands on one array of sums and counts per key, so that a key costs one row per task, not
    one per task and position as in `mean_vectors`; these are put together in order of their keys. Null elements do not count; a position that has
    nothing else is null. Keys without a vector, or with empty ones only, have no row. Null keys count as equal.
    """
    given = df.select(*keys, F.col(vector).cast("array<double>").alias("__vector"))
    kept = given.drop("__vector").schema
    shape = T.StructType([*kept.fields, T.StructField("__sums", T.ArrayType(T.DoubleType())), T.StructField("__counts", T.ArrayType(T.LongType()))])
    arrow = to_arrow_schema(shape)
    partial = given.mapInArrow(_partial_sums(len(keys), arrow), shape)
    together = partial.repartition(*keys).sortWithinPartitions(*keys) if keys else partial.coalesce(1)
    merged = together.mapInArrow(_merged_sums(len(keys), arrow), shape)
    mean = F.transform("__sums", lambda total, at: F.when(F.get("__counts", at) > 0, total / F.get("__counts", at)))
    return merged.select(*keys, mean.alias(out))


def pooled(vectors: Column) -> Column:
    """Mean of an array of equally long vectors, null for an empty one. Give a plain column."""
    count = F.size(vectors)
    width = F.size(F.try_element_at(vectors, F.lit(1)))
    places = F.sequence(F.lit(0), width - 1)
    total = lambda at: F.aggregate(vectors, F.lit(0.0), lambda sofar, v: sofar + F.get(v, at))
    return F.when((count > 0) & (width > 0), F.transform(places, lambda at: total(at) / count))


def or_zero(vector: Column, width: int) -> Column:
    """The vector, or zeros where there is none."""
    return F.coalesce(vector, F.array_repeat(F.lit(0.0), width))
