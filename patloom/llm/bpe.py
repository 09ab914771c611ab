"""Byte-level BPE encoding and decoding with numpy, many pieces at once.

Texts are split by the vocabulary's pattern; pieces that a task has met before come from a bounded
cache. New pieces go, by length, into padded matrices of ids. In each round every row merges its leftmost pair
of least rank, and the row is compacted by one place; rows without a pair left are done. Ranks of pairs are
found in an open-addressing hash table, and only those beside a merge are looked up again.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patloom.llm.registry import query, table
from patloom.llm.words import filled, lists, slices

NONE = np.int32(2**31 - 1)  # rank of a pair that does not merge
PAD = np.int32(-1)
EMPTY = np.uint64(2**64 - 1)
STEPS = (2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256)  # matrix widths; longer pieces go by a heap
CELLS = 1 << 20  # of a matrix
CACHED = 100_000  # pieces


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file (base64 and rank per line), by rank."""
    lines = (line.split() for line in Path(path).read_bytes().splitlines() if line)
    ranks = {int(rank): base64.b64decode(token) for token, rank in lines}
    return [ranks[i] for i in range(len(ranks))]


def _hashed(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint32)


def pair_table(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and ranks of all pairs of tokens that together are a token, hashed into places."""
    ids = {token: rank for rank, token in enumerate(tokens)}
    found = [
        (ids[token[:at]], ids[token[at:]], rank)
        for rank, token in enumerate(tokens)
        for at in range(1, len(token))
        if token[:at] in ids and token[at:] in ids
    ]
    pairs = np.array(found, np.int32).reshape(-1, 3)
    keys, bits = _key(pairs[:, 0], pairs[:, 1]), max(4, (2 * len(pairs)).bit_length())
    table, ranks = np.full(1 << bits, EMPTY), np.full(1 << bits, NONE)
    left, at = np.arange(len(keys)), _hashed(keys, bits)
    while len(left):
        free = left[table[at[left]] == EMPTY]
        table[at[free]] = keys[free]  # of several keys for a place the last one gets it
        won = free[table[at[free]] == keys[free]]
        ranks[at[won]] = pairs[won, 2]
        left = left[~np.isin(left, won)]
        at[left] = (at[left] + 1) & (len(table) - 1)
    return table, ranks


class Codec:
    """Encodes pieces and decodes ids; made anew in each task from broadcast arrays."""

    def __init__(self, tokens: list[bytes], table: np.ndarray, ranks: np.ndarray, pattern: str) -> None:
        self.tokens, self.table, self.ranks = tokens, table, ranks
        self.bits = len(table).bit_length() - 1
        self.single = np.full(256, PAD)
        for rank, token in enumerate(tokens):
            if len(token) == 1:
                self.single[token[0]] = rank
        self.pieces = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.cache: dict[str, bytes] = {}
        self.sizes = np.array([len(token) for token in tokens], np.int64)
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.begins = np.cumsum(self.sizes) - self.sizes

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, `NONE` where it does not merge."""
        keys = _key(left, right)
        at, out = _hashed(keys, self.bits), np.full(len(keys), NONE)
        left = np.flatnonzero(right >= 0)
        while len(left):
            there = self.table[at[left]]
            hit = there == keys[left]
            out[left[hit]] = self.ranks[at[left[hit]]]
            left = left[~hit & (there != EMPTY)]
            at[left] = (at[left] + 1) & (len(self.table) - 1)
        return out

    def merge_rows(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row numbers, their final ids, padded) as rows of a matrix of ids are done."""
        rows = np.arange(len(ids))
        ranks = self.rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), -1)
        while len(rows):
            if not ranks.shape[1]:
                yield rows, ids
                return
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(rows)), at]
            if (done := best == NONE).any():
                yield rows[done], ids[done]
                rows, ids, ranks, at, best = rows[~done], ids[~done], ranks[~done], at[~done], best[~done]
                if not len(rows):
                    return
            n = np.arange(len(rows))
            ids[n, at] = best
            kept = np.ones(ids.shape, bool)
            kept[n, at + 1] = False
            ids = ids[kept].reshape(len(rows), -1)
            kept = np.ones(ranks.shape, bool)
            kept[n, at] = False
            ranks = ranks[kept].reshape(len(rows), -1)
            right = at < ranks.shape[1]
            ranks[n[right], at[right]] = self.rank(best[right], ids[n[right], at[right] + 1])
            left = at > 0
            ranks[n[left], at[left] - 1] = self.rank(ids[n[left], at[left] - 1], best[left])

    def merge_long(self, piece: bytes) -> list[int]:
        """The same merges in one long piece: a heap of pairs over a linked list."""
        ids = self.single[np.frombuffer(piece, np.uint8)]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        ranks = self.rank(ids[:-1], ids[1:])
        heap = [(int(r), i) for i, r in enumerate(ranks) if r != NONE]
        ids, alive, end = ids.tolist(), [True] * len(ids), len(ids)
        now = {i: r for r, i in heap}
        heapq.heapify(heap)

        def again(i: int) -> None:
            now.pop(i, None)
            if i >= 0 and after[i] < end:
                r = int(self.rank(np.array([ids[i]], np.int32), np.array([ids[after[i]]], np.int32))[0])
                if r != NONE:
                    now[i] = r
                    heapq.heappush(heap, (r, i))

        while heap:
            r, i = heapq.heappop(heap)
            if not alive[i] or now.get(i) != r:
                continue
            gone = after[i]
            alive[gone], ids[i], after[i] = False, r, after[gone]
            now.pop(gone, None)
            if after[i] < end:
                before[after[i]] = i
            again(i)
            again(before[i])
        return [ids[i] for i in range(end) if alive[i]]

    def learn(self, pieces: list[str]) -> None:
        """Put pieces into the cache, as the bytes of their ids."""
        coded = [piece.encode() for piece in pieces]
        sizes = np.array([len(x) for x in coded])
        for i in np.flatnonzero(sizes == 1):
            self.cache[pieces[i]] = self.single[coded[i][0]].astype("<u4").tobytes()
        low = 1
        for width in STEPS:
            of = np.flatnonzero((sizes > low) & (sizes <= width))
            low = width
            step = max(1, CELLS // width)
            for start in range(0, len(of), step):
                part = of[start : start + step]
                ids = np.full((len(part), width), PAD)
                within = np.arange(width) < sizes[part][:, None]
                ids[within] = self.single[np.frombuffer(b"".join([coded[i] for i in part]), np.uint8)]
                for rows, done in self.merge_rows(ids):
                    real = done >= 0
                    flat, ends = done[real].astype("<u4").tobytes(), 4 * np.cumsum(real.sum(axis=1))
                    begin = 0
                    for row, end in zip(rows.tolist(), ends.tolist()):
                        self.cache[pieces[part[row]]] = flat[begin:end]
                        begin = end
        for i in np.flatnonzero(sizes > low):
            self.cache[pieces[i]] = np.array(self.merge_long(coded[i]), "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.pieces.findall(text) for text in texts]
        new = set().union(*split).difference(self.cache)
        if len(self.cache) + len(new) > CACHED:
            self.cache.clear()
            new = set().union(*split)
        self.learn(list(new))
        of = self.cache.__getitem__
        return [b"".join(map(of, pieces)) for pieces in split]

    def decode(self, ids: np.ndarray) -> bytes:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.begins[ids] - ends + sizes, sizes) + np.arange(total)].tobytes()


def _coder(spark: SparkSession, ranks_path: str, pattern: str):
    """A function that makes the codec inside a task. What is broadcast is bounded by the vocabulary."""
    tokens = read_ranks(ranks_path)
    shared = spark.sparkContext.broadcast((tokens, *pair_table(tokens), pattern))
    return lambda: Codec(*shared.value)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of batches of (text, other columns) with their texts."""
    for batch in batches:
        texts = filled(batch.column(0))
        for start, stop in slices(texts):
            yield batch.slice(start, stop - start), texts.slice(start, stop - start).to_pylist()


def _digests(make, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = make()
        for batch, texts in _texts(batches):
            coded = codec.encode(texts)
            hexes = [hashlib.sha256(ids).hexdigest() for ids in coded]
            back = [hashlib.sha256(codec.decode(np.frombuffer(ids, "<u4"))).hexdigest() for ids in coded]
            sizes = pa.array([len(ids) // 4 for ids in coded], pa.int64())
            columns = [batch.column(1), sizes, pa.array(hexes, pa.string()), pa.array(back, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                flat = np.frombuffer(b"".join(coded), "<u4").astype(np.int32)
                columns, names = [*columns, lists(flat, sizes.to_numpy())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _ids(make):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = make()
        for batch, texts in _texts(batches):
            coded = codec.encode(texts)
            flat = np.frombuffer(b"".join(coded), "<u4").astype(np.int32)
            ids = lists(flat, np.array([len(x) // 4 for x in coded], np.int64))
            yield pa.RecordBatch.from_arrays([ids, batch.column(1)], ["ids", "row"])

    return run


def _bytes(make):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = make()
        for batch in batches:
            back = [codec.decode(np.array(ids or [], np.int64)) for ids in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(back, pa.binary()), batch.column(1)], ["decoded", "row"])

    return run


def _row(df: DataFrame):
    return F.struct(*(F.col(f"`{name}`") for name in df.columns)).alias("row")


def encode_texts(df: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """(ids array<int>, row): the ids of every text beside its row. A null or empty text has no ids.

    The row is a struct of all columns, whatever their names; rows stay in their tasks, so nothing moves.
    Special tokens are ordinary text.
    """
    given = df.select(F.col(text).cast("string").alias("text"), _row(df))
    return given.mapInArrow(_ids(_coder(df.sparkSession, ranks_path, pattern)), f"ids array<int>, row {df.schema.simpleString()}")


def decode_ids(df: DataFrame, ranks_path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """(decoded binary, row): the bytes of every list of ids; null ids are none. An id that the
    vocabulary does not have fails the job."""
    given = df.select(F.col(ids).alias("ids"), _row(df))
    return given.mapInArrow(_bytes(_coder(df.sparkSession, ranks_path, pattern)), f"decoded binary, row {df.schema.simpleString()}")


def round_trip(
    df: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text", with_ids: bool = False
) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) and maybe the ids: every text encoded and decoded in one task."""
    kind = dict(df.dtypes)[key]
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" if with_ids else ""
    given = df.select(F.col(text).cast("string").alias("text"), F.col(key).alias("doc_id"))
    return given.mapInArrow(_digests(_coder(df.sparkSession, ranks_path, pattern), with_ids), schema).withColumnRenamed("doc_id", key)


def public_vocabulary(name: str = "byte_bpe_multi_50k.tiktoken") -> tuple[str, str]:
    """Path and pattern of an installed public vocabulary; both are parameters of the operators."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


@query("op2_bpe")
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded."""
    return round_trip(table(spark, sf_dir, "documents"), *public_vocabulary())
