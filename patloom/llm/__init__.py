"""Operators for training-data pipelines over text corpora, one module each, with their queries.

Rows are known by their id column. Unless a docstring says otherwise: a null text counts as empty,
rows that agree in id and text count as one document, and columns beyond those named do not matter.
"""

from patloom.llm import (  # noqa: F401
    bpe,
    chat,
    fingerprints,
    jaccard,
    leaks,
    licences,
    manifest,
    quality,
    repeats,
    search,
    shards,
    tokens,
    warc,
)
from patloom.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
