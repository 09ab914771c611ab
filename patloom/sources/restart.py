"""Points at which a deflate stream can be taken up, so that one long entry is unpacked by many tasks.

A first pass unpacks the stream once. Every `span` bytes it looks for the begin of a block that brings its own codes:
bits that have the form of such a header, from which a fresh decoder, given the last 32 KB, goes on exactly as the
running one does. What is kept of a point is its place in bits, the length unpacked before it, and those 32 KB.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np

Read = Callable[[int, int], bytes]  # offset and length in the stream

SPAN = 4 << 20  # packed bytes between points
READ_BYTES = 256 << 10
SEARCHED = 128 << 10  # bytes of a read in which a point is looked for; else the next read is
PROVED = 4096  # unpacked bytes that must agree at least
WINDOW = 32768


@dataclass(frozen=True)
class Point:
    bit: int
    out: int
    window: bytes


START = Point(0, 0, b"")


def _headers(data: bytes) -> np.ndarray:
    """Bit offsets that have the form of a block header with codes of its own, not the last block of a stream."""
    bits = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")
    number = lambda at, n: sum(bits[at + i].astype(np.int32) << i for i in range(n))
    at = np.arange(max(0, len(bits) - 17 - 19 * 3))
    at = at[(bits[at] == 0) & (bits[at + 1] == 0) & (bits[at + 2] == 1)]
    at = at[(number(at + 3, 5) < 30) & (number(at + 8, 5) < 30)]  # lengths of the two codes
    lengths, filled = number(at + 13, 4) + 4, np.zeros(len(at), np.int32)
    for i in range(19):
        length = np.where(i < lengths, number(at + 17 + 3 * i, 3), 0)
        filled += np.where(length > 0, 128 >> length, 0)
    return at[filled == 128]  # the code of the lengths uses all of its room


def _shifted(data: bytes, bit: int) -> bytes:
    """Whole bytes from a bit of the first byte on."""
    if not bit:
        return data
    wide = np.frombuffer(data, np.uint8).astype(np.uint16)
    return ((wide[:-1] >> bit | wide[1:] << (8 - bit)) & 255).astype(np.uint8).tobytes()


def _goes_on(running, rest: bytes, data: bytes, bit: int, window: bytes) -> bool:
    """Whether a fresh decoder at a bit of `data` gives what the running one gives for `rest`."""
    fresh = zlib.decompressobj(-15, zdict=window)
    try:
        got = fresh.decompress(_shifted(data, bit))
    except zlib.error:
        return False
    return len(got) >= PROVED and running.copy().decompress(rest).startswith(got)


def unpacked(read: Read, size: int, span: int = SPAN) -> Iterator[tuple[bytes, Point | None]]:
    """The stream's content piece by piece, each with the point at its begin where there is one."""
    running, fed, out, window, due = zlib.decompressobj(-15), 0, 0, b"", span
    point: Point | None = START
    while fed < size and not running.eof:
        block = read(fed, min(READ_BYTES, size - fed))
        if not block:
            break
        done = 0
        places = _headers(block[:SEARCHED]) if fed >= due else ()
        for place in [*map(int, places), 8 * len(block)]:
            to = -(-place // 8)
            piece = running.decompress(block[done:to])
            done = max(done, to)
            if piece or point:
                yield piece, point
                point = None
            out, window = out + len(piece), (window + piece)[-WINDOW:]
            if to < len(block) and fed >= due and _goes_on(running, block[to:], block[place // 8 :], place % 8, window):
                point, due = Point(8 * fed + place, out, window), fed + to + span
        fed += len(block)
    if not running.eof:
        raise EOFError(f"the stream ends after {fed} bytes")


def resumed(read: Read, size: int, point: Point) -> Iterator[bytes]:
    """The stream's content from a point on, piece by piece."""
    at, bit = divmod(point.bit, 8)
    decoder = zlib.decompressobj(-15, zdict=point.window) if point.window else zlib.decompressobj(-15)
    carried = b""
    while at < size and not decoder.eof:
        block = read(at, min(READ_BYTES, size - at))
        if not block:
            break
        at += len(block)
        whole = carried + block
        carried = whole[-1:] if bit else b""
        yield decoder.decompress(_shifted(whole, bit))
    if carried and not decoder.eof:
        yield decoder.decompress(bytes([carried[0] >> bit]))
    if not decoder.eof:
        raise EOFError(f"the stream ends after {at} bytes")
