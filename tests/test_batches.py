"""What a Python worker is handed at once."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from patloom.llm import registry as llm
from patloom.queries import registry

ROWS, BYTES = (f"spark.sql.execution.arrow.max{what}PerBatch" for what in ("Records", "Bytes"))


@pytest.fixture
def bounds(spark):
    kept = [(key, spark.conf.get(key)) for key in (ROWS, BYTES)]
    yield lambda rows, size: (spark.conf.set(ROWS, rows), spark.conf.set(BYTES, size))
    for key, value in kept:
        spark.conf.set(key, value)


@pytest.mark.parametrize("table, most", [(registry.table, 500), (llm.table, 1000)])
def test_rows_and_bytes_of_a_batch_are_bounded(spark, tables, bounds, table, most):
    bounds("10000", "64m")
    table(spark, tables, "documents")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "bytes": [batch.nbytes]})

    wide = spark.range(0, 200, 1, 1).select(F.repeat(F.lit("x"), 1 << 17).alias("text"))
    assert wide.mapInArrow(sizes, "rows bigint, bytes bigint").agg(F.max("bytes")).first()[0] < 5 << 20
    narrow = spark.range(0, 5000, 1, 1).mapInArrow(sizes, "rows bigint, bytes bigint")
    assert narrow.agg(F.max("rows")).first()[0] == most


def test_lower_bounds_of_the_session_stay(spark, tables, bounds):
    bounds("7", "1m")
    registry.table(spark, tables, "documents")
    assert (spark.conf.get(ROWS), spark.conf.get(BYTES)) == ("7", "1m")
