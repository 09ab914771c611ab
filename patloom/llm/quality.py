"""Document quality by regularised quadratic discriminant analysis.

A document is a row of transformed statistics of its whole text. Each class is a normal distribution of
them; its covariance is shrunk towards the pooled one and then towards a multiple of the identity.
The score is the posterior probability of class 1, from the difference of the log densities: Mahalanobis distances by the
inverted Cholesky factor of each class, which is made once, on the driver.

The fit uses all labelled rows. They reach the driver as sums: a count, a vector and a matrix per class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patloom.llm.prefilter import inside
from patloom.llm.registry import query, table, written
from patloom.llm.words import Powers, byte_values, filled, lists, slices, words_of

POOLED = 0.5  # share of the pooled covariance
ROUND = 0.01  # share of the identity
SPREAD = 1e-6  # least standard deviation of a statistic
PRIOR_WORDS = 10  # ordinary words that every text is taken to have besides its own: short texts say little
THRESHOLD = 0.3

STATISTICS = (
    "words", "word_length", "marks", "bars", "shouts", "capitals", "digits", "distinct", "stuttered",
    "repeated_lines", "stops", "short", "line_words", "foreign", "commonest", "pairs",
)


def _at_text(counted: np.ndarray, text_starts: np.ndarray, end: int) -> np.ndarray:
    """Sum of the values of each text."""
    sums = np.concatenate([[0], np.cumsum(counted, dtype=np.int64)])
    return sums[np.append(text_starts[1:], end)] - sums[text_starts]


def statistics(texts: pa.Array, values: np.ndarray, powers: Powers) -> np.ndarray:
    """A row of transformed statistics for each text of a slice."""
    words = words_of(texts, values, powers)
    data, end = words.data, len(words.data)
    kinds = {
        "marks": b"#$%&*@^~_=+<>{}[]\\/",
        "bars": b"|",
        "shouts": b"!?",
        "capitals": bytes(range(65, 91)),
        "small": bytes(range(97, 123)),
        "digits": bytes(range(48, 58)),
        "stops": b".,;:",
        "foreign": bytes(range(128, 192)),
        "lines": b"\n",
    }
    counts = {}
    for name, of in kinds.items():
        mask = np.zeros(256, np.uint8)
        mask[list(of)] = 1
        counts[name] = _at_text(mask[data], words.text_starts, end)
    n = np.diff(words.first)
    some = n + PRIOR_WORDS
    sizes = words.ends - words.starts
    per_word = lambda of: _sum(of, words.first)
    hashes = words.hashes
    inside = np.ones(len(hashes), bool)
    inside[words.first[:-1][n > 0]] = False
    same = np.zeros(len(hashes), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    stuttered = per_word(same & inside)
    doc = np.repeat(np.arange(len(n)), n)
    distinct, most = _distinct(doc, hashes, len(n))
    pairs = hashes.copy()
    pairs[1:] += hashes[:-1] * np.uint64(3)
    distinct_pairs, _ = _distinct(doc[inside], pairs[inside], len(n))
    line = np.cumsum(np.bincount(np.searchsorted(words.starts, np.flatnonzero(data == 10)), minlength=len(hashes) + 1))[: len(hashes)]
    repeated = _repeated_lines(doc, line, hashes, sizes, len(n))
    letters = counts["capitals"] + counts["small"] + counts["foreign"] + 5 * PRIOR_WORDS
    rate = lambda x: np.log1p(20.0 * x / some)
    length = np.log1p(n)
    return np.column_stack(
        [
            length,
            np.log1p((per_word(sizes) + 5 * PRIOR_WORDS) / some),
            rate(counts["marks"]),
            rate(counts["bars"]),
            rate(counts["shouts"]),
            counts["capitals"] / letters,
            rate(counts["digits"]),
            (distinct + PRIOR_WORDS) / some,
            stuttered / some,
            repeated / some,
            rate(counts["stops"]),
            per_word(sizes <= 3) / some,
            np.log1p(n / (counts["lines"] + 1)),
            counts["foreign"] / letters,
            most / some,
            (distinct_pairs + PRIOR_WORDS) / some,
        ]
    )


def _sum(of: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(of, dtype=np.int64)])
    return sums[first[1:]] - sums[first[:-1]]


def _distinct(doc: np.ndarray, hashes: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each text, and how often its commonest one comes."""
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.ones(len(doc), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    often = np.diff(np.append(at, len(doc)))
    most = np.zeros(docs, np.int64)
    np.maximum.at(most, doc[at], often)
    return np.bincount(doc[at], minlength=docs), most


def _repeated_lines(doc: np.ndarray, line: np.ndarray, hashes: np.ndarray, sizes: np.ndarray, docs: int) -> np.ndarray:
    """Words in lines that an earlier line of the text equals."""
    if not len(doc):
        return np.zeros(docs, np.int64)
    new = np.ones(len(doc), bool)
    new[1:] = (line[1:] != line[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    n = np.diff(np.append(at, len(doc)))
    within = (np.arange(len(doc)) - np.repeat(at, n)).astype(np.uint64)
    whole = np.add.reduceat(hashes * (within * np.uint64(2) + np.uint64(1)), at)
    owner = doc[at]
    order = np.lexsort((np.arange(len(at)), whole, owner))
    again = np.zeros(len(at), bool)
    again[1:] = (whole[order][1:] == whole[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    return np.bincount(owner[order][again], weights=n[order][again], minlength=docs).astype(np.int64)


def _rows(kept):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, powers = byte_values(), Powers()
        for batch in map(kept, batches):
            texts = filled(batch.column(1))
            parts = [statistics(texts.slice(a, b - a), values, powers) for a, b in slices(texts)]
            rows = np.concatenate(parts) if parts else np.zeros((0, len(STATISTICS)))
            column = lists(rows.ravel(), np.full(len(rows), len(STATISTICS)))
            yield pa.RecordBatch.from_arrays([batch.column(0), column], ["doc_id", "stats"])

    return run


def document_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text", among: DataFrame | None = None) -> DataFrame:
    """(doc_id, stats): `STATISTICS` of every whole text, in order. A null text is empty; of an empty one all are defined.

    With `among` (key) only of documents that may have one of these keys: all that have, and a few more.
    """
    given = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"), F.xxhash64(key).alias("hash"))
    kept = inside(among, key) if among is not None else lambda batch: batch
    return given.mapInArrow(_rows(kept), f"doc_id {dict(given.dtypes)['doc_id']}, stats array<double>")


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (label, stats): count, sums and sums of products of each class, one number per row."""
    width = len(STATISTICS) + 1
    totals = np.zeros((2, width, width))
    for batch in batches:
        labels = batch.column(0).to_numpy()
        rows = np.column_stack([np.ones(len(labels)), batch.column(1).flatten().to_numpy().reshape(-1, width - 1)])
        for label in (0, 1):
            totals[label] += rows[labels == label].T @ rows[labels == label]
    at = np.arange(totals.size, dtype=np.int32)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(totals.ravel())], ["at", "total"])


@dataclass
class Model:
    """Prior log odds, and mean, inverted Cholesky factor and log determinant (halved) of each class."""

    odds: float
    classes: list[tuple[np.ndarray, np.ndarray, float]]

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of class 1."""
        value = np.full(len(rows), self.odds)
        for sign, (mean, inverse, half) in zip((-1, 1), self.classes):
            value += sign * (-0.5 * (((rows - mean) @ inverse.T) ** 2).sum(axis=1) - half)
        return 1 / (1 + np.exp(-np.clip(value, -500, 500)))


def fit(labelled: DataFrame, pooled: float = POOLED, towards_round: float = ROUND) -> Model:
    """The model of rows (label, stats). Labels other than 0 and 1 do not count.

    Without rows of one class its distribution is that of the other, and the prior alone decides.
    """
    width = len(STATISTICS) + 1
    parts = labelled.filter("label IN (0, 1)").select(F.col("label").cast("int"), "stats").mapInArrow(_sums, "at int, total double")
    totals = np.zeros(2 * width * width)
    for at, total in parts.groupBy("at").agg(F.sum("total")).collect():  # a fixed number of rows
        totals[at] = total
    totals = totals.reshape(2, width, width)
    counts = totals[:, 0, 0]
    odds = float(np.log(counts[1] + 1) - np.log(counts[0] + 1))
    if not counts.sum():
        return Model(odds, [])
    moments = [t if t[0, 0] else totals[1 - c] for c, t in enumerate(totals)]
    means = [t[0, 1:] / t[0, 0] for t in moments]
    spreads = [t[1:, 1:] / t[0, 0] - np.outer(m, m) for t, m in zip(moments, means)]
    shared = (counts[0] * spreads[0] + counts[1] * spreads[1]) / counts.sum()
    whole = totals.sum(axis=0)
    centre = whole[0, 1:] / whole[0, 0]
    scale = np.sqrt(np.maximum(np.diag(whole[1:, 1:]) / whole[0, 0] - centre**2, SPREAD**2))
    classes = []
    for mean, spread in zip(means, spreads):
        of = ((1 - pooled) * spread + pooled * shared) / np.outer(scale, scale)
        level = max(np.trace(of) / len(of), SPREAD)
        factor = np.linalg.cholesky((1 - towards_round) * of + towards_round * level * np.eye(len(of)))
        classes.append((mean, np.linalg.inv(factor) / scale, float(np.log(np.diag(factor)).sum())))
    return Model(odds, classes)


def scored(stats: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of rows (doc_id, stats)."""
    odds, classes = model.odds, model.classes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Model(odds, classes)
        for batch in batches:
            rows = batch.column(1).flatten().to_numpy().reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fitted.score(rows))], ["doc_id", "score"])

    return stats.mapInArrow(run, f"doc_id {dict(stats.dtypes)['doc_id']}, score double")


def held_out(key: Column, folds: int = 5) -> Column:
    """Whether a row stays out of the fit: crc32 of its id as text, modulo the folds, is 0. A null id is an empty text."""
    return F.crc32(F.encode(F.coalesce(key.cast("string"), F.lit("")), "UTF-8")) % folds == 0


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score), one row per document.

    Takes (doc_id, text) and (doc_id, quality). Only labels of rows that are not held out are learnt. A document that
    is labelled more than once has its least label; rows of one id and different texts are all learnt.
    Null labels, labels without a document and a label's other columns do nothing.
    """
    stats = written(document_statistics(docs), "statistics")
    marks = labels.filter("quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("label"))
    learnt = stats.join(marks.filter(~held_out(F.col("doc_id"))), "doc_id")
    model = fit(learnt.select("label", "stats"))
    return scored(stats, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score")


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The documents whose score reaches the threshold, all columns as they are.

    Fitted as in `quality_scores`, on the documents that have labels. Rows are judged where they are read, so nothing
    moves, and rows without an id or of repeated ids are judged by their own text.
    """
    marks = labels.filter("quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("label"))
    marks = written(marks.filter(~held_out(F.col("doc_id"))), "marks")
    # Written, so that no task has the workers of two Python steps, which stay alive beside those of later stages.
    stats = written(document_statistics(docs, text=text, among=marks), "statistics")
    model = fit(stats.join(marks, "doc_id").select("label", "stats"))
    odds, classes = model.odds, model.classes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, values, powers = Model(odds, classes), byte_values(), Powers()
        for batch in batches:
            texts = filled(batch.column(0))
            scores = [fitted.score(statistics(texts.slice(a, b - a), values, powers)) for a, b in slices(texts)]
            kept = np.concatenate([np.zeros(0), *scores]) >= threshold
            yield pa.RecordBatch.from_arrays([batch.column(1).filter(pa.array(kept))], ["row"])

    row = F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row")
    given = docs.select(F.col(text).cast("string").alias("text"), row)
    return given.mapInArrow(run, f"row {docs.schema.simpleString()}").select("row.*")


@query("op7_quality")
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored, with the decision at 0.3."""
    scores = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scores.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
