"""Document fingerprints: invertible Bloom lookup sketches of paragraphs.

A paragraph is a line, cut at sentence ends and into runs of at most `WORDS` words. Its digest is hashed into one
cell of each third of a sketch; a cell holds a count, and the digests and their check hashes xored. Sketches of two versions are
subtracted cell by cell, and the digests in which they differ are peeled off: a cell with one digest gives it
away, and taking it out of its other cells uncovers more. Where that gets stuck both versions are
sketched anew with twice the cells, until it succeeds. The fingerprint is the smallest sketch.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patloom.llm.registry import query, table, written
from patloom.llm.words import Powers, byte_values, mixed, slices, words_of

WORDS = 8
CELLS = 12  # of the smallest sketch; a multiple of 3
SLICE_BYTES = 1 << 19
CHECK = np.uint64(0xA0761D6478BD642F)


@dataclass
class Digests:
    """Paragraph digests of several texts, one after the other, and how many each has."""

    values: np.ndarray
    counts: np.ndarray

    def of(self, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The digests of some texts (which may repeat), and to which of them each belongs."""
        ends = np.cumsum(self.counts)
        n = self.counts[texts]
        at = np.repeat(ends[texts] - np.cumsum(n), n) + np.arange(n.sum())
        return self.values[at], np.repeat(np.arange(len(texts)), n)


def paragraph_digests(texts: pa.Array, values: np.ndarray, powers: Powers) -> Digests:
    """Digests of all paragraphs. A paragraph that comes again in a text has another digest each time."""
    parts, counts = [], []
    for begin, end in slices(texts, SLICE_BYTES):
        words = words_of(texts.slice(begin, end - begin), values, powers)
        n = len(words.hashes)
        if not n:
            counts.append(np.zeros(end - begin, np.int64))
            continue
        lines = np.concatenate([[0], np.cumsum(words.data == 10)])
        stop = np.zeros(256, bool)
        stop[list(b".!?;:")] = True
        new = np.ones(n, bool)
        new[1:] = stop[words.data[words.ends[:-1] - 1]] | (lines[words.starts[1:]] > lines[words.ends[:-1]])
        new[words.first[:-1][np.diff(words.first) > 0]] = True
        begins = np.flatnonzero(new)
        within = np.arange(n) - np.repeat(begins, np.diff(np.append(begins, n)))
        starts = np.flatnonzero(within % WORDS == 0)
        ends = np.append(starts[1:], n)
        powers.reach(n + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words.hashes * powers.up[:n], dtype=np.uint64)])
        whole = mixed((sums[ends] - sums[starts]) * powers.down[starts] + (ends - starts).astype(np.uint64))
        text = np.searchsorted(words.first, starts, "right") - 1
        order = np.lexsort((whole, text))
        whole, text = whole[order], text[order]
        run = np.ones(len(whole), bool)
        run[1:] = (whole[1:] != whole[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(run)
        again = np.arange(len(whole)) - np.repeat(first, np.diff(np.append(first, len(whole))))
        parts.append(mixed(whole + again.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D)))
        counts.append(np.bincount(text, minlength=end - begin))
    return Digests(np.concatenate([np.zeros(0, np.uint64), *parts]), np.concatenate([np.zeros(0, np.int64), *counts]))


def _cells(digests: np.ndarray, owner: np.ndarray, cells: int) -> Iterator[np.ndarray]:
    """The cells of each digest, one in each third of its owner's sketch."""
    third = cells // 3
    for part in range(3):
        place = mixed(digests + np.uint64(cells * 3 + part)) % np.uint64(third)
        yield owner * cells + part * third + place.astype(np.int64)


class Sketches:
    """Sketches of several texts."""

    def __init__(self, texts: int, cells: int) -> None:
        self.cells = cells
        self.count = np.zeros(texts * cells, np.int64)
        self.key = np.zeros(texts * cells, np.uint64)
        self.check = np.zeros(texts * cells, np.uint64)

    def add(self, digests: np.ndarray, owner: np.ndarray, sign: np.ndarray | int = 1) -> None:
        check = mixed(digests ^ CHECK)
        for cell in _cells(digests, owner, self.cells):
            np.add.at(self.count, cell, sign)
            np.bitwise_xor.at(self.key, cell, digests)
            np.bitwise_xor.at(self.check, cell, check)

    def minus(self, left: np.ndarray, right: np.ndarray) -> Sketches:
        """Differences of the sketches of two rows of texts."""
        out = Sketches(len(left), self.cells)
        rows = lambda x, of: x.reshape(-1, self.cells)[of].ravel()
        out.count = rows(self.count, left) - rows(self.count, right)
        out.key = rows(self.key, left) ^ rows(self.key, right)
        out.check = rows(self.check, left) ^ rows(self.check, right)
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How many digests only the left and only the right version has, and whether all were found."""
        texts = len(self.count) // self.cells
        found = np.zeros((2, texts), np.int64)
        while True:
            pure = np.flatnonzero((np.abs(self.count) == 1) & (mixed(self.key ^ CHECK) == self.check))
            if not len(pure):
                break
            owner, key, sign = pure // self.cells, self.key[pure], self.count[pure]
            order = np.lexsort((key, owner))
            owner, key, sign = owner[order], key[order], sign[order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
            owner, key, sign = owner[new], key[new], sign[new]
            for row, of in enumerate((1, -1)):
                found[row] += np.bincount(owner[sign == of], minlength=texts)
            self.add(key, owner, -sign)
        left = (self.count != 0) | (self.key != 0) | (self.check != 0)
        return found[0], found[1], ~left.reshape(texts, self.cells).any(axis=1)

    def texts(self) -> list[str]:
        """Each sketch as text: counts, digests and check hashes of its cells."""
        rows = np.zeros((len(self.count), 20), np.uint8)
        rows[:, :4] = self.count.astype("<i4").view(np.uint8).reshape(-1, 4)
        rows[:, 4:12] = self.key.astype("<u8").view(np.uint8).reshape(-1, 8)
        rows[:, 12:] = self.check.astype("<u8").view(np.uint8).reshape(-1, 8)
        wide = rows.reshape(-1, self.cells * 20)
        return [base64.b64encode(row.tobytes()).decode() for row in wide]


def sketch(digests: Digests, cells: int = CELLS) -> Sketches:
    out = Sketches(len(digests.counts), cells)
    out.add(*digests.of(np.arange(len(digests.counts))))
    return out


def likeness(digests: Digests, base: Sketches, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Shared paragraphs over all paragraphs of each pair of texts; 1 where neither has any."""
    only, other, done = base.minus(left, right).peel()
    cells = base.cells
    while not done.all():
        cells *= 2
        todo = np.flatnonzero(~done)
        if cells > 64 * (digests.counts[left[todo]] + digests.counts[right[todo]] + CELLS).max():
            raise ValueError("paragraph digests that no sketch tells apart")
        again = Sketches(len(todo), cells)
        again.add(*digests.of(left[todo]), 1)
        again.add(*digests.of(right[todo]), -1)
        only[todo], other[todo], done[todo] = again.peel()
    shared = digests.counts[left] - only
    total = shared + only + other
    return np.where(total > 0, shared / np.maximum(total, 1), 1.0)


RESULT = "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, guest, id, text) in descending order of id within a bucket, a guest first.

    The next document of a row has therefore come before it; only its text is kept.
    """
    values, powers = byte_values(fold=False), Powers()
    bucket, at, first, following = None, None, "", ""

    def out(ids, texts, heads) -> pa.RecordBatch:
        edited = []
        for text, head in zip(texts, heads):
            quarter = len(text) // 4
            edited.append(text[: len(text) - quarter] + head[:quarter])
        others = list(dict.fromkeys(heads))
        number = {text: i for i, text in enumerate(others)}
        digests = paragraph_digests(pa.array([*texts, *edited, *others], pa.string()), values, powers)
        base, n = sketch(digests), len(texts)
        here = np.arange(n)
        shown = base.texts()
        return pa.RecordBatch.from_arrays(
            [
                ids,
                pa.array([len(text) for text in texts], pa.int64()),
                pa.array([hashlib.sha256(text.encode()).hexdigest() for text in edited]),
                pa.array(shown[:n], pa.string()),
                pa.array(shown[n : 2 * n], pa.string()),
                pa.array(likeness(digests, base, here, here + n)),
                pa.array(likeness(digests, base, here, np.array([number[h] for h in heads], np.int64) + 2 * n)),
            ],
            ["doc_id", *(part.split()[0] for part in RESULT.split(", "))],
        )

    for batch in batches:
        ids, texts, heads, size = [], [], [], 0
        for bucket_now, guest, key, text in zip(*(column.to_pylist() for column in batch.columns)):
            text = text or ""
            if bucket_now != bucket:
                bucket, at, first, following = bucket_now, None, "", ""
            if guest:
                if at is None:
                    at, first = (key, True), text
                continue
            if at != (key, False):  # of rows with one id the first stands for it
                at, following, first = (key, False), first, text
            ids.append(key)
            texts.append(text)
            heads.append("" if key is None else following)
            size += len(text)
            if size > SLICE_BYTES:
                yield out(pa.array(ids, batch.schema.field(2).type), texts, heads)
                ids, texts, heads, size = [], [], [], 0
        if ids:
            yield out(pa.array(ids, batch.schema.field(2).type), texts, heads)


def compared_with_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's fingerprint, that of its edited text, and how like they and the next document's are.

    The edited text has its last quarter of code points replaced by as many first ones of the next
    document in order of id; the first one follows the last. A null text is empty. Rows of one id have the
    same next document; of the next id's rows that of least text hash counts. A row without an id has none: its
    last quarter goes, and the next text is empty.

    Documents are dealt by ranges of ids, once, and each task goes through its range from the end; the first document of a range also goes
    to the range before. Only the first id of each range reaches the driver.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[key]
    ids = docs.select(F.col(key).alias("id")).filter("id IS NOT NULL").distinct()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = written(ids.repartitionByRange(tasks, "id").withColumn("part", F.spark_partition_id()), "ranges")
    lows = [row["low"] for row in ranges.groupBy("part").agg(F.min("id").alias("low")).orderBy("low").collect()]
    count = max(1, len(lows))

    @F.arrow_udf("int")
    def range_of(keys: pa.Array) -> pa.Array:
        """Twice the number of the range, one more for its first id."""
        keys, starts = keys.to_numpy(zero_copy_only=False), np.array(lows)
        at = np.searchsorted(starts, keys, "right") - 1
        return pa.array((2 * at + (starts[at] == keys)).astype(np.int32))

    rows = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))
    seal = F.xxhash64("text")
    placed = rows.filter("id IS NOT NULL").withColumn("code", range_of("id"))
    bucket = F.shiftright("code", 1)
    here = F.struct(bucket.alias("bucket"), F.lit(0).alias("guest"))
    before = F.struct(F.pmod(bucket - 1, F.lit(count)).alias("bucket"), F.lit(1).alias("guest"))
    homes = F.when(F.col("code") % 2 == 1, F.array(here, before)).otherwise(F.array(here))
    dealt = placed.select("id", "text", F.explode(homes).alias("home")).select("home.bucket", "home.guest", "id", "text")
    homeless = rows.filter("id IS NULL").select(
        (F.lit(count) + F.pmod(seal, F.lit(count))).cast("int").alias("bucket"), F.lit(0).alias("guest"), "id", "text"
    )
    spread = dealt.unionByName(homeless).repartitionById(2 * count, "bucket")
    ordered = spread.sortWithinPartitions("bucket", F.desc("guest"), F.desc("id"), seal)
    return ordered.mapInArrow(_compare, f"doc_id {kind}, {RESULT}").withColumnRenamed("doc_id", key)


@query("op3_fingerprints")
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against their edited texts and the next documents."""
    return compared_with_edits(table(spark, sf_dir, "documents"))
