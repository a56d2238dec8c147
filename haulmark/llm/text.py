"""Words and word hashes of many texts at once, as NumPy operations on the UTF-8 bytes of an Arrow column.

A word's hash is the difference of two prefix sums of byte values times powers of an odd base, brought to
position 0 by the inverse power, so it costs a few passes over the bytes whatever the words are. The letters
A-Z count as a-z. Hashes have 64 bits; work on them is followed by a comparison of the texts where two
different words with one hash could change a result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 21  # rows are worked on in runs of about this size; one longer text is a run of its own

_BASE = 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]
_CACHE: dict[str, np.ndarray] = {}


def byte_table(inside) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(inside)] = True
    return table


#: All but space and the bytes 09-0D.
NOT_BLANK = byte_table(b for b in range(256) if b != 0x20 and not 0x09 <= b <= 0x0D)
#: ASCII digits and letters, and every byte of a character beyond ASCII.
ALNUM = byte_table([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_CACHE.get("up", ())) < n:
        size = max(n, PIECE_BYTES + (1 << 16))
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            row = np.full(size, base, dtype=np.uint64)
            row[0] = 1
            _CACHE[name] = np.multiply.accumulate(row)
    return _CACHE["up"][:n], _CACHE["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on all."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def pieces(column: pa.Array, max_bytes: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets of the rows in them) of runs of rows; null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + max_bytes, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


@dataclass
class Words:
    """Words of a run of texts: byte ranges, hashes, and for text d the words ``bounds[d]:bounds[d + 1]``."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray
    sums: np.ndarray

    def range_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of any byte ranges of the run."""
        down = _powers(max(len(self.sums), 1))[1]
        return mix((self.sums[ends] - self.sums[starts]) * down[starts])

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> Words:
    n = len(data)
    sums = np.zeros(n + 1, dtype=np.uint64)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return Words(none, none, none.astype(np.uint64), np.zeros(len(offsets), dtype=np.int64), sums)
    word = inside[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    before = np.zeros(n, dtype=bool)
    before[1:] = word[:-1]
    after = np.zeros(n, dtype=bool)
    after[:-1] = word[1:]
    starts = np.flatnonzero(word & (~before | edge[:n]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    np.cumsum(_BYTE[data] * _powers(n)[0], out=sums[1:])
    out = Words(starts, ends, sums[:0], np.searchsorted(starts, offsets), sums)
    out.hashes = out.range_hash(starts, ends)
    return out


def shingles(found: Words, width: int, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words, and the bounds of each text's. With ``short``, a text of fewer
    words, but not none, has its whole sequence as its one shingle; otherwise it has none."""
    count = np.diff(found.bounds)
    kept = np.where(count >= width, count - width + 1, ((count > 0) & short).astype(np.int64))
    bounds = np.zeros(len(count) + 1, dtype=np.int64)
    np.cumsum(kept, out=bounds[1:])
    text = np.repeat(np.arange(len(count)), kept)
    first = np.arange(bounds[-1]) - bounds[text] + found.bounds[text]
    length = np.minimum(width, count[text])
    out = np.zeros(len(first), dtype=np.uint64)
    for k in range(width):
        inside = k < length if short else slice(None)
        out[inside] = mix(out[inside] * np.uint64(_BASE) + found.hashes[first[inside] + k])
    return out, bounds


def run_hashes(tokens: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the runs of ``width`` tokens from ``starts``."""
    up, down = _powers(max(len(tokens), 1))
    sums = np.zeros(len(tokens) + 1, dtype=np.uint64)
    np.cumsum(tokens * up[:len(tokens)], out=sums[1:])
    return mix((sums[starts + width] - sums[starts]) * down[starts])


def char_positions(data: np.ndarray) -> np.ndarray:
    """For each byte offset, and the end, the number of characters before it."""
    before = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=before[1:])
    return before
