import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

LONG = " ".join(f"long{i % 977}" for i in range(60_000))


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and very long texts, repeated rows, one id with two texts, and clashing columns."""
    rows = [
        (1, "Plain text of a few words. And more of it."), (2, None), (3, ""), (4, " \n\t "), (5, LONG), (6, LONG),
        (7, "same row"), (7, "same row"), (8, "one text"), (8, "another text"), (None, "no id"), (None, None), (9, "Plain text of a few words. And more of it."),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    clash = ("row", "shard", "bucket", "pos", "at", "node", "one", "two", "n", "label", "seal", "stays", "spans", "ids", "score", "id", "token", "slot", "home", "guest")
    extra = {name: F.lit(name) for name in clash}
    return df.withColumns({**extra, "lang": F.lit(None).cast("string"), "n_chars": F.char_length("text").cast("long"), "tags": F.create_map(F.lit("a"), F.lit(1))})


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
