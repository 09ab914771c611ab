"""Word hashes of many texts at once, with numpy over Arrow batches.

A word is a run of bytes other than ASCII white space (0x20, 0x09 to 0x0D). Its hash is that of its
bytes, with ASCII letters lower-cased or not: a polynomial over a table of random 64-bit values, taken for all
words of a batch from one running sum, then mixed. Hashes are 64 bits wide and always the same.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

SPACES = (0x20, *range(0x09, 0x0E))
SLICE_BYTES = 1 << 19  # texts are hashed in slices of about so many bytes, however large the batch
BASE = 0x9E3779B97F4A7C15  # odd, so that its powers can be undone


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit over all (a public finalizer)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_values(fold: bool = True) -> np.ndarray:
    """A value per byte; with `fold` the same for upper and lower case of ASCII letters."""
    values = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    if fold:
        values[65:91] = values[97:123]
    return values


class Powers:
    """Powers of the base and of its inverse, as many as the longest slice so far has needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, SLICE_BYTES + 1)
            self.up, self.down = (
                np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, base, np.uint64), dtype=np.uint64)])
                for base in (np.uint64(BASE), np.uint64(pow(BASE, -1, 1 << 64)))
            )


@dataclass
class Words:
    """Words of consecutive texts: `first[d]` to `first[d + 1]` are those of text d of the slice."""

    hashes: np.ndarray  # uint64
    starts: np.ndarray  # byte offsets in `data`
    ends: np.ndarray
    first: np.ndarray
    text_starts: np.ndarray  # byte offset of each text in `data`
    data: np.ndarray  # the bytes


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `most` bytes, at least one text each."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1)
        yield start, min(stop, len(texts))
        start = stop


def filled(texts: pa.Array | pa.ChunkedArray) -> pa.StringArray:
    """Texts as plain strings, empty for null."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    return pa.compute.fill_null(texts.cast(pa.string()), "")


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts, one after the other, and where each begins (and the last ends)."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray, powers: Powers) -> np.ndarray:
    """Hash of each run of bytes [start, end)."""
    powers.reach(len(data) + 1)
    terms = values[data]
    terms *= powers.up[: len(data)]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(terms, out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * powers.down[starts])


def words_of(texts: pa.Array, values: np.ndarray, powers: Powers, between: Sequence[int] = SPACES) -> Words:
    """The words of some texts: runs of bytes other than those `between` them. Words end with their text."""
    data, offsets = text_bytes(texts)
    blank = np.zeros(256, bool)
    blank[list(between)] = True
    inside = ~blank[data]
    starting = inside.copy()
    starting[1:] &= blank[data[:-1]]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]
    starting[edges] = inside[edges]
    ending = inside.copy()
    ending[:-1] &= blank[data[1:]]
    ending[edges[1:] - 1] = inside[edges[1:] - 1]
    starts, ends = np.flatnonzero(starting), np.flatnonzero(ending) + 1
    hashes = hash_runs(data, starts, ends, values, powers)
    return Words(hashes, starts, ends, np.searchsorted(starts, offsets), offsets[:-1], data)


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive words, whatever texts they belong to; too short: none."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(hashes) - n + 1, np.uint64)
    for i in range(n):
        total += hashes[i : i + len(total)] * np.uint64(pow(BASE, i, 1 << 64))
    return mixed(total)


def lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """An Arrow list per count, from values one after the other; 64-bit values as signed."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64) if values.dtype == np.uint64 else values))
