"""Words of many texts at once: byte offsets and 64-bit hashes by whole-array arithmetic.

All functions work on one buffer of UTF-8 bytes that holds several texts end to end, so the cost is a few passes over
an array, not a Python step per word. Hashes only find candidates or name values inside one job; whatever is decided on
them is verified on the bytes, or the operator says that it is not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_MUL = np.uint64(0x9E3779B97F4A7C15)
_MUL2 = np.uint64(0xC2B2AE3D27D4EB4F)
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def byte_class(member) -> np.ndarray:
    """256 booleans: does ``member(byte)`` hold?"""
    return np.array([bool(member(b)) for b in range(256)])


NOT_SPACE = byte_class(lambda b: b not in (9, 10, 11, 12, 13, 32))
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


class Texts:
    """Some texts of one Arrow batch: ``data`` (bytes, 8 spare zero bytes at the end) and ``bounds`` (n + 1 offsets)."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, first: int):
        self.data, self.bounds, self.first = data, bounds, first

    def __len__(self) -> int:
        return len(self.bounds) - 1

    @property
    def size(self) -> int:
        return int(self.bounds[-1])


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Texts]:
    """Runs of whole texts of about ``limit`` bytes (one longer text makes a run of its own). Null counts as empty."""
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    n = len(column)
    if not n:
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(ends, ends[low] + limit, side="right")) - 1)
        part = np.zeros(ends[high] - ends[low] + 8, dtype=np.uint8)
        part[:-8] = raw[ends[low] : ends[high]]
        yield Texts(part, ends[low : high + 1] - ends[low], low)
        low = high


def words(texts: Texts, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes of a class, never across texts: starts, ends, and the first word of each text (n + 1)."""
    size = texts.size
    member = inside[texts.data[: size + 1]]
    member[size] = False
    fresh = np.empty(size + 1, dtype=bool)
    fresh[0] = True
    fresh[1:] = ~member[:-1]
    fresh[texts.bounds] = True
    starts = np.flatnonzero(member & fresh)
    ends = np.flatnonzero(member[:-1] & fresh[1:] | member[:-1] & ~member[1:]) + 1
    return starts, ends, np.searchsorted(starts, texts.bounds)


#: Every white-space byte as a space.
SPACED = np.array([32 if b in (9, 10, 11, 12, 13) else b for b in range(256)], dtype=np.uint8)


def joined(texts: Texts, starts: np.ndarray, ends: np.ndarray, mapped: np.ndarray = SPACED) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Words one space apart, end to end over all texts: the bytes, and where each word starts and ends in them.

    A run of words of one text is the slice from its first start to its last end. ``mapped`` translates the bytes.
    """
    keep = NOT_SPACE[texts.data]
    keep[-8:] = False
    keep[ends] = True  # one separator after each word; where texts meet it is the next text's first byte
    place = np.concatenate([[0], np.cumsum(keep)])
    return mapped[texts.data][keep].tobytes(), place[starts], place[ends]


def lanes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every offset on, as a number (a view, nothing is copied)."""
    return np.ndarray((len(data) - 7,), dtype="<u8", buffer=data.data, strides=(1,))


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * _MUL
    return h ^ (h >> np.uint64(29))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """One 64-bit hash per run, eight bytes a step; only runs that are long enough take part in later steps."""
    view = lanes(data)
    length = (ends - starts).astype(np.int64)
    h = length.astype(np.uint64) * _MUL2 + np.uint64(seed)
    if not len(starts):
        return h
    h = mixed(h ^ (view[starts] & _MASKS[np.minimum(length, 8)]))
    at = 8
    rest = np.flatnonzero(length > 8)
    while len(rest):
        lane = view[starts[rest] + at] & _MASKS[np.minimum(length[rest] - at, 8)]
        h[rest] = mixed((h[rest] * _MUL2) ^ lane)
        at += 8
        rest = rest[length[rest] > at]
    return h


def window_hashes(h: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """A hash of every ``n`` neighbouring values, by doubling; ``len(h) - n + 1`` of them."""
    if len(h) < n:
        return np.zeros(0, dtype=np.uint64)
    base = np.uint64((0xD6E8FEB86659FD93 + 2 * seed) % (1 << 64))
    out: np.ndarray | None = None
    done, width, block, factor = 0, 1, h, base
    rest = n
    with np.errstate(over="ignore"):
        power = np.uint64(1)
        while rest:
            if rest & 1:
                part = block[done:] * power
                out = part if out is None else out[: len(part)] + part
                done += width
                power = power * factor
            rest >>= 1
            if rest:
                block = block[: len(block) - width] + block[width:] * factor
                width *= 2
                factor = factor * factor
        assert out is not None
        return mixed(out[: len(h) - n + 1])


def owner(first: np.ndarray) -> np.ndarray:
    """For each word the number of its text, from the first words of the texts."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))
