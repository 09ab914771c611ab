"""Neighbours in sorted order, over task borders.

Rows are dealt by ranges of their keys and order, and sorted, so equal keys stand side by side, and a key that holds a
third of all rows fills as many ranges as it needs. Each row is compared with the one before it. Only the first and last key of each
task reach the driver: from them follows what a task's first and last rows have for neighbours in other tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patloom.llm.registry import written


def _changes(batch: pa.RecordBatch, keys: Sequence[str]) -> np.ndarray:
    """Which rows have another key than the row before; the first row has."""
    out = np.zeros(len(batch), bool)
    out[0] = True
    for key in keys:
        values = batch.column(key)
        out[1:] |= pa.compute.fill_null(pa.compute.not_equal(values[1:], values[:-1]), True).to_numpy(zero_copy_only=False)
    return out


def _compare(keys: list[str], firsts: list[str], single: bool):
    """Rows in order to rows with the `firsts` values of the first one of their key, and whether they are alone.

    Without `single`, rows that are alone, and not at a border of the task, are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        held, origin, opened, begun = None, None, False, False
        # `held` is the last row so far: whether it is alone, the next one tells. `opened`: it begins its key.

        def out(rows: pa.RecordBatch, first: np.ndarray, alone: np.ndarray, begins: pa.RecordBatch, border: np.ndarray) -> pa.RecordBatch:
            heads = [begins.column(c).take(pa.array(first)) for c in firsts]
            columns = [*rows.columns, *heads, pa.array(alone), pa.array(np.full(len(rows), task, np.int32))]
            whole = pa.RecordBatch.from_arrays(columns, [*rows.schema.names, *(f"first_{c}" for c in firsts), "alone", "task"])
            return whole if single else whole.filter(pa.array(~alone | border))

        for batch in batches:
            if not len(batch):
                continue
            rows = batch if held is None else pa.concat_batches([held, batch])
            new = _changes(rows, keys)
            if held is not None:
                new[0] = opened
            # The row that begins each row's key: in this batch, or `origin` at the end of the table of begins.
            at = np.maximum.accumulate(np.where(new, np.arange(len(rows)), -1))
            begins = rows if origin is None else pa.concat_batches([rows, origin])
            first = np.where(at < 0, len(rows), at)
            alone = new[:-1] & new[1:]
            if len(rows) > 1:
                border = np.zeros(len(rows) - 1, bool)
                border[0] = not begun
                begun = True
                yield out(rows.slice(0, len(rows) - 1), first[:-1], alone, begins, border)
            held, opened = rows.slice(len(rows) - 1), bool(new[-1])
            origin = begins.slice(int(first[-1]), 1)
        if held is not None:
            yield out(held, np.zeros(1, np.int64), np.array([opened]), origin, np.array([True]))

    return run


def _compared(df: DataFrame, keys: list[str], order: list[str], firsts: list[str], name: str, single: bool) -> tuple[DataFrame, DataFrame]:
    """The rows as a written table, each compared within its task, and what is true of keys with rows in several tasks.

    The second table is (task, keys, true_<column> for the columns in `firsts`), sent to the executors.
    """
    kinds = dict(df.dtypes)
    shape = ", ".join([*(f"`{c}` {k}" for c, k in df.dtypes), *(f"`first_{c}` {kinds[c]}" for c in firsts), "alone boolean", "task int"])
    dealt = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    found = written(dealt.mapInArrow(_compare(keys, firsts, single), shape), name)
    place = F.struct(*keys, *(f"first_{c}" for c in firsts))
    ends = found.groupBy("task").agg(F.min(place).alias("low"), F.max(place).alias("high"))
    fixes, last, last_task = [], None, None
    for row in sorted(ends.collect(), key=lambda r: r["task"]):  # one row per task
        low, high = tuple(row["low"]), tuple(row["high"])
        n = len(keys)
        if last is not None and last[:n] == low[:n]:
            fixes += [(last_task, *last), (row["task"], *last)]
            high = last if high[:n] == low[:n] else high
        last, last_task = high, row["task"]
    fields = ", ".join(["task int", *(f"`{c}` {kinds[c]}" for c in keys), *(f"`true_{c}` {kinds[c]}" for c in firsts)])
    # At most two keys per task have rows in another one.
    return found, F.broadcast(df.sparkSession.createDataFrame(sorted(set(fixes), key=repr), fields))


def neighbours(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, single: bool = True) -> DataFrame:
    """Add to each row `first_<column>` for the columns in `order`, of the first row of equal `keys`, and `alone`.

    First is meant in ascending `order`; `alone` says that no other row has the key. Keys are not null. Without `single`, rows
    that are alone are left out. The result is a written table; the input is read twice, so give a written one or a cheap view
    of it.
    """
    keys, order = list(keys), list(order)
    found, known = _compared(df, keys, order, order, name, single)
    both = found.join(known.withColumn("met", F.lit(True)), ["task", *keys], "left")
    out = both.select(
        *df.columns,
        *(F.coalesce(f"true_{c}", f"first_{c}").alias(f"first_{c}") for c in order),
        (F.col("alone") & F.col("met").isNull()).alias("alone"),
    )
    return out if single else out.filter(~F.col("alone")).drop("alone")


def repeated(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """The rows whose `keys` another row has as well. Keys are not null; `order` only tells the rows of a key apart, so that they fill several tasks.

    As `neighbours` without `single`, for where the first row is not asked for. A row that has a partner in its own task needs nothing else: what
    other tasks hold is looked up for the others at the task's borders, two rows of it at most.
    """
    keys = list(keys)
    found, known = _compared(df, keys, list(order), [], name, single=False)
    border = found.filter("alone").join(known, ["task", *keys], "left_semi")
    return found.filter(~F.col("alone")).unionByName(border).select(*df.columns)
