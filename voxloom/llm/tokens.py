"""Vectorised words and shingles of Arrow text columns, for use inside tasks.

Words are ``[^\\x20\\x09-\\x0D]+`` over text with A-Z lower-cased; a word's hash is a 64-bit mix of
its UTF-8 bytes, the same in every task and on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20
_MASKS = np.array([0] + [(1 << (8 * k)) - 1 for k in range(1, 9)], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit scrambling (splitmix64 constants)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """Words of several texts: those of text k are [first[k], first[k + 1])."""

    buffer: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    texts: np.ndarray

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word."""
        padded = np.concatenate([self.buffer, np.zeros(8, np.uint8)])
        wide = np.ndarray(len(self.buffer) + 1, "<u8", padded, strides=(1,))
        length = self.ends - self.starts
        out = mix(length.astype(np.uint64))
        order = np.argsort(-length, kind="stable") if len(length) and length.max() > 8 else np.arange(len(length))
        start, left = self.starts[order], length[order]
        state, done = out[order], 0
        active = len(order)
        while active:
            part = wide[start[:active] + done] & _MASKS[np.minimum(left[:active] - done, 8)]
            state[:active] = mix(state[:active] ^ part)
            done += 8
            active = int(np.searchsorted(-left[:active], -done, side="left"))
        out[order] = state
        return out


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about limit bytes of text each, one row at least."""
    column = pc.cast(column, pa.large_string())
    if not len(column):
        return
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, side="right")) - 1)
        yield at, to
        at = to


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes with A-Z lowered, and the offsets of the texts in them; a null text is empty."""
    column = pc.fill_null(pc.cast(column, pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return raw + ((raw >= 65) & (raw <= 90)) * np.uint8(32), offsets - offsets[0]


def words_of(column: pa.Array) -> Words:
    data, offsets = text_bytes(column)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    before[inner] = False
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[inner - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return Words(data, starts, ends, np.append(np.searchsorted(starts, offsets[:-1]), len(starts)), offsets)


def shingle_sets(column: pa.Array, width: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text: fewer words than width make one shingle."""
    words = words_of(column)
    hashed = words.hashes()
    n = len(hashed)
    rolled = np.zeros(max(0, n - width + 1), np.uint64)
    for k in range(width):
        rolled = mix(rolled ^ hashed[k : k + len(rolled)])
    for a, b in zip(words.first[:-1], words.first[1:], strict=True):
        if b - a >= width:
            yield np.unique(rolled[a : b - width + 1])
        elif b > a:
            short = np.array([b - a], np.uint64)
            for h in hashed[a:b]:
                short = mix(short ^ h)
            yield short
        else:
            yield np.zeros(0, np.uint64)


def long_lists(parts: list[np.ndarray]) -> pa.Array:
    """Arrow list<int64> of unsigned hashes, bit for bit."""
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.uint64).view(np.int64)))
