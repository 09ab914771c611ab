"""Embedding and pooling."""

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import functions as F

from patloom.functions.embedding import with_embedding
from patloom.operators.pooling import mean_vectors, or_zero, pooled
from patloom.plans.ep import embedded

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the stand-in model travels with the job


def model():
    def encode(texts):
        if any("bad" in text for text in texts):
            raise ValueError("cannot encode")
        return np.array([[len(text), text.count(" ")] for text in texts], dtype="float32")

    return encode


def test_embedding_pools_and_keeps_errors_visible(spark):
    rows = [(1, ["a b", "cccc"]), (2, []), (3, ["bad"]), (4, None), (5, ["x"])]
    df = spark.createDataFrame(rows, "id int, chunks array<string>").coalesce(1)
    got = {r.id: (r.embedding, r.embed_error) for r in with_embedding(df, "chunks", model, width=2, batch_size=2).collect()}
    assert got[1] == ([3.5, 0.5], None)
    assert got[2] == ([0.0, 0.0], None) and got[4] == ([0.0, 0.0], None)
    assert got[3] == ([0.0, 0.0], "ValueError: cannot encode")
    assert got[5] == ([1.0, 0.0], None)


def test_default_width(spark):
    df = spark.createDataFrame([(1, [])], "id int, chunks array<string>")
    assert with_embedding(df, "chunks", model).first().embedding == [0.0] * 1024


def test_embedding_needs_no_shuffle(spark):
    df = spark.createDataFrame([("a",)], "doc_id string").withColumns({c: F.lit("the text") for c in ("title_en", "abstract", "description", "applicants", "inventors")})
    out = embedded(df, model, width=2)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.first().embedding == [float(len("title text abstract text description text applicants text inventors text")), 9.0]


def test_embedding_with_own_chunker(spark):
    df = spark.createDataFrame([("a", "x")], "doc_id string, title_en string")
    df = df.withColumns({c: F.lit(None).cast("string") for c in ("abstract", "description", "applicants", "inventors")})
    out = embedded(df, model, width=2, chunker=lambda text: F.array(text, F.lit("y z")))
    size = len("title x abstract description applicants inventors")
    assert out.first().embedding == [(size + 3) / 2, 3.0]


def test_pooled_equals_plain_mean(spark):
    vectors = np.random.default_rng(1).normal(size=(7, 5)).tolist()
    df = spark.createDataFrame([(vectors,), ([],)], "v array<array<double>>")
    first, empty = (r[0] for r in df.select(pooled(F.col("v"))).collect())
    assert np.allclose(first, np.mean(vectors, axis=0), rtol=0, atol=1e-15) and empty is None
    assert df.select(or_zero(pooled(F.col("v")), 3)).collect()[1][0] == [0.0, 0.0, 0.0]


def test_mean_vectors_of_a_hot_key(spark):
    rows = [("hot", [float(i), 1.0]) for i in range(1000)] + [("cold", [2.0, 4.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "k string, v array<float>").repartition(8)
    got = {r.k: r.vector for r in mean_vectors(df, ["k"], "v").collect()}
    assert got == {"hot": [499.5, 1.0], "cold": [2.0, 4.0], None: [1.0, 1.0]}
    plan = mean_vectors(df, ["k"], "v")._jdf.queryExecution().executedPlan().toString()
    assert "partial_avg" in plan
