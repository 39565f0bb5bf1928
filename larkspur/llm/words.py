"""Words of whole texts as numpy arrays, a slice of documents at a time.

Texts stay in their Arrow buffer: word bounds, word hashes and window hashes are
array operations over the bytes of many documents. Memory is a fixed multiple
(about fifty) of ``SLICE_BYTES`` or of the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_U = np.uint64


@dataclass(frozen=True)
class Alphabet:
    """What separates words, and the byte each byte counts as."""

    separator: np.ndarray
    value: np.ndarray


def _lower() -> np.ndarray:
    value = np.arange(256, dtype=np.uint8)
    value[65:91] += 32
    return value


def blank_separated(lower: bool = False) -> Alphabet:
    """Words ``[^\\x20\\x09-\\x0D]+``."""
    separator = np.zeros(256, bool)
    separator[[32, *range(9, 14)]] = True
    return Alphabet(separator, _lower() if lower else np.arange(256, dtype=np.uint8))


def letters_and_digits() -> Alphabet:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    separator = np.zeros(256, bool)
    separator[:128] = True
    separator[48:58] = separator[65:91] = separator[97:123] = False
    return Alphabet(separator, _lower())


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1] \
        if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one longer text."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = min(max(end, start + 1), rows)
        yield start, end
        start = end


@dataclass
class Words:
    """Words of some documents: bounds in ``data``, document of each, counts."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    counts: np.ndarray

    def bytes(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()


def split(buffer: np.ndarray, offsets: np.ndarray, rows: tuple[int, int], alphabet: Alphabet) -> Words:
    low, high = rows
    first, last = int(offsets[low]), int(offsets[high])
    raw = buffer[first:last]
    bounds = offsets[low:high + 1] - first
    inside = ~alphabet.separator[raw]
    before = np.empty(len(raw) + 1, bool)
    before[0] = False
    before[1:] = inside
    cut = bounds[:-1][bounds[:-1] < len(raw)]
    opens = inside.copy()
    opens &= ~before[:-1]
    opens[cut] = inside[cut]
    starts = np.flatnonzero(opens)
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    ends_here = cut[cut > 0] - 1
    closes[ends_here] = inside[ends_here]
    ends = np.flatnonzero(closes) + 1
    doc = np.searchsorted(bounds, starts, "right") - 1
    return Words(alphabet.value[raw], starts, ends, doc, np.bincount(doc, minlength=high - low))


_powers: dict[int, np.ndarray] = {}


def _power(base: int, count: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < count:
        known = np.full(max(count, SLICE_BYTES + 1), base, _U)
        known[0] = 1
        known = np.cumprod(known, dtype=_U)
        if count <= SLICE_BYTES + 1:
            _powers[base] = known
    return known[:count]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def word_hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes, from one running polynomial sum."""
    size = len(words.data)
    if not len(words.starts):
        return np.zeros(0, _U)
    total = np.zeros(size + 1, _U)
    np.cumsum((words.data.astype(_U) + _U(1)) * _power(_BASE, size), out=total[1:])
    return mix((total[words.ends] - total[words.starts]) * _power(_BASE_INVERSE, size)[words.starts])


def join_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of the window made of two windows."""
    return mix(left * _U(0xD6E8FEB86659FD93) + (right ^ (right >> _U(29))) + _U(0x2545F4914F6CDD1D))


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every window of ``length`` values, by doubling; the last step may overlap."""
    have, out = 1, hashes
    while have < length:
        step = min(have, length - have)
        out = join_hashes(out[:len(out) - step], out[step:]) if len(out) > step else out[:0]
        have += step
    return out


def windows(words: Words, length: int, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of each window inside one document."""
    out = window_hashes(word_hashes(words) if hashes is None else hashes, length)
    at = np.flatnonzero(words.doc[:len(out)] == words.doc[length - 1:length - 1 + len(out)])
    return at, out[at]
