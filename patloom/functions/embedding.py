"""Model inference over the chunks of a document."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patloom.operators.pooling import or_zero
from patloom.schemas import EMBEDDING_DIM

Encode = Callable[[Sequence[str]], np.ndarray]


def sentence_model(name: str = "intfloat/e5-large-v2", device: str | None = None) -> Callable[[], Encode]:
    """A loader for a sentence-transformers model, which must be installed on the executors."""

    def load() -> Encode:
        from sentence_transformers import SentenceTransformer

        return SentenceTransformer(name, device=device).encode

    return load


def chunk_embedder(load_model: Callable[[], Encode], batch_size: int = 64) -> Callable[[Column], Column]:
    """A function from array<string> to struct<vector: array<double>, error: string>, the mean of the chunks' vectors.

    The model is loaded once per task. Chunks of many documents share a model batch. Where a batch
    fails, or gives another number of vectors than it had texts, its documents are tried one by one, so
    only the bad ones get an error. Vectors are averaged here, so that one per document goes to Spark.
    """

    @F.arrow_udf("struct<vector:array<double>,error:string>")
    def embed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = load_model()

        def vectors_of(texts: list[str]) -> list[np.ndarray]:
            starts = range(0, len(texts), batch_size)
            rows = [row for at in starts for row in np.asarray(encode(texts[at : at + batch_size]), dtype="float64")]
            if len(rows) != len(texts):
                raise ValueError(f"{len(rows)} vectors for {len(texts)} texts")
            return rows

        def mean(rows: list[np.ndarray]) -> np.ndarray | None:
            total = None
            for row in rows:
                total = row.copy() if total is None else total + row
            return total / len(rows) if rows and len(total) else None

        def one(chunks: list[str]) -> tuple[np.ndarray | None, str | None]:
            try:
                return mean(vectors_of(chunks)), None
            except Exception as problem:  # stays visible in the error column
                return None, f"{type(problem).__name__}: {problem}"

        for batch in batches:
            documents = [chunks or [] for chunks in batch.to_pylist()]
            try:
                rows = iter(vectors_of([chunk for chunks in documents for chunk in chunks]))
                results = [(mean([next(rows) for _ in chunks]), None) for chunks in documents]
            except Exception:
                results = [one(chunks) for chunks in documents]
            vectors = pa.array([vector for vector, _ in results], pa.list_(pa.float64()))
            errors = pa.array([error for _, error in results], pa.string())
            yield pa.StructArray.from_arrays([vectors, errors], ["vector", "error"])

    return embed


def with_embedding(
    df: DataFrame,
    chunks: str,
    load_model: Callable[[], Encode],
    out: str = "embedding",
    width: int = EMBEDDING_DIM,
    batch_size: int = 64,
) -> DataFrame:
    """Add the mean vector of a document's chunks, and `embed_error`.

    The chunks of a document stay in its row, so no shuffle is needed. Documents without chunks
    and documents that failed get zeros; only the latter have an error.
    """
    embedded = df.withColumn("__embedded", chunk_embedder(load_model, batch_size)(F.col(chunks)))
    return embedded.withColumns(
        {out: or_zero(F.col("__embedded.vector"), width), "embed_error": F.col("__embedded.error")}
    ).drop("__embedded")
