"""Words, hashes and shingles of whole texts, computed over the bytes of Arrow columns.

Texts are UTF-8; a word is a maximal run of bytes that are not separators. A null text counts as empty.
Everything is vectorised over a piece of about a megabyte, so the memory of a task does not follow the size of
its partition; a longer text is a piece of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20
SHINGLE_WORDS = 5
WHITE = (9, 10, 11, 12, 13, 32)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WHITE = np.zeros(256, bool)
IS_WHITE[list(WHITE)] = True
#: White space and ASCII punctuation but the apostrophe.
IS_BREAK = IS_WHITE.copy()
IS_BREAK[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) != "'"]] = True

_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit hashes."""
    h = h ^ (h >> np.uint64(30))
    h *= _M1
    h ^= h >> np.uint64(27)
    h *= _M2
    h ^= h >> np.uint64(31)
    return h


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows; null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``size`` bytes of text each and at least one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = utf8(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
            yield batch.slice(at, end - at)
            at = end


@dataclass
class Words:
    """Lower-cased bytes, the words' byte ranges, and for each text the range of its words."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def take(self, which: np.ndarray) -> list[bytes]:
        raw = self.data.tobytes()
        return [raw[a:b] for a, b in zip(self.starts[which].tolist(), self.ends[which].tolist())]


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = IS_WHITE, lower: bool = True) -> Words:
    data = LOWER[data] if lower else data
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~separators[data]
    here, before = inside[1:], inside[:-1]
    starts = np.flatnonzero(here & (~before | edge))
    ends = np.flatnonzero(before & (~here | edge))
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def word_hashes(found: Words) -> np.ndarray:
    """A 64-bit hash of each word, eight bytes at a time."""
    size = found.ends - found.starts
    padded = np.concatenate([found.data, np.zeros(8, np.uint8)])
    blocks = np.ndarray((len(found.data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    h = size.astype(np.uint64) * _GOLD
    live, at, left = slice(None), found.starts, size
    while len(at):
        part = blocks[at] & _MASKS[np.minimum(left, 8)]
        h[live] = mix((h[live] ^ part) + _GOLD)
        more = np.flatnonzero(left > 8)
        live = more if isinstance(live, slice) else live[more]
        at, left = at[more] + 8, left[more] - 8
    return h


def shingles(h: np.ndarray, bounds: np.ndarray, width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's runs of ``width`` words, in order, and their bounds.

    A text with fewer words has its whole sequence as one; a text without words has none.
    """
    counts = np.diff(bounds)
    full = np.maximum(counts - width + 1, 0)
    short = np.flatnonzero((counts > 0) & (counts < width))
    sizes = full.copy()
    sizes[short] = 1
    out_bounds = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(out_bounds[-1], np.uint64)
    if len(h) >= width:
        whole = h[: len(h) - width + 1].copy()
        for k in range(1, width):
            whole *= _STEP
            whole += h[k : len(h) - width + 1 + k]
        where = np.arange(full.sum()) - np.repeat(np.cumsum(full) - full, full)
        out[where + np.repeat(out_bounds[:-1], full)] = mix(whole[where + np.repeat(bounds[:-1], full)] + np.uint64(width))
    for d in short.tolist():
        total = np.zeros(1, np.uint64)
        for x in h[bounds[d] : bounds[d + 1]]:
            total = total * _STEP + x
        out[out_bounds[d]] = mix(total + np.uint64(counts[d]))[0]
    return out, out_bounds


def strings(values: list[bytes]) -> list[str]:
    return [v.decode("utf-8", "replace") for v in values]
