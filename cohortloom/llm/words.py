"""Words and word n-grams of Arrow text columns as numpy arrays.

Works on the bytes of the column: space, tab, line feed, vertical tab, form feed and carriage
return are single bytes that never occur inside a multi-byte character, and only A-Z is lowered.
A word's hash is a polynomial over random 64-bit values of its bytes, read off running sums; it
identifies the word up to chance collisions of about 2**-60.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
CHUNK = 1 << 18  # bytes whose running sums are held at once
SLICE = 1 << 20  # bytes of text handled at once


def _constants():
    rng = np.random.default_rng(20260117)
    table = rng.integers(1, 2 ** 63, 256, dtype=np.uint64) | U(1)
    lowered = table.copy()
    lowered[ord("A"):ord("Z") + 1] = table[ord("a"):ord("z") + 1]
    base = int(rng.integers(1, 2 ** 62, dtype=np.uint64)) | 1
    return table, lowered, base, pow(base, -1, 2 ** 64)


BYTES_AS_THEY_ARE, BYTES_LOWERED, BASE, INVERSE = _constants()
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64."""
    held = _POWERS.get(base)
    if held is None or len(held) < n:
        steps = np.full(max(n, CHUNK + 1), base, dtype=np.uint64)
        steps[0] = 1
        held = _POWERS[base] = np.multiply.accumulate(steps)
    return held[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit (splitmix64's finish)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, one after the other, and the offset of each (one more than rows). Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return held[at[0]:at[-1]], at - at[0]


@dataclass
class Words:
    """``start`` and ``end`` are byte positions; the words of text i are ``first[i]:first[i + 1]``."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.first) - 1

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.first))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray,
                values: np.ndarray = BYTES_LOWERED) -> np.ndarray:
    """Hashes of byte spans that follow each other. Running sums are held for a chunk at a time, so
    memory does not grow with the text."""
    out = np.empty(len(start), dtype=np.uint64)
    at = 0
    while at < len(start):
        low = start[at]
        upto = max(at + 1, int(np.searchsorted(end, low + CHUNK, side="right")))
        piece = data[low:end[upto - 1]]
        sums = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum(values[piece] * _powers(BASE, len(piece)), out=sums[1:])
        s, e = start[at:upto] - low, end[at:upto] - low
        out[at:upto] = (sums[e] - sums[s]) * _powers(INVERSE, len(piece))[s]
        at = upto
    return mixed(out)


def find_words(data: np.ndarray, offsets: np.ndarray, values: np.ndarray = BYTES_LOWERED) -> Words:
    inside = ~SPACE[data]
    n = len(data)
    cut = np.zeros(n + 1, dtype=bool)  # a text starts or all ends here
    cut[offsets] = True
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    start = np.flatnonzero(inside & (~before | cut[:n]))
    end = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return Words(start, end, span_hashes(data, start, end, values), np.searchsorted(start, offsets))


_STEPS = np.random.default_rng(77).integers(1, 2 ** 63, 64, dtype=np.uint64) | U(1)


def n_grams(words: Words, n: int, short_whole: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``n`` words inside one text, and ``first`` by text.

    ``short_whole``: a text of fewer words, but at least one, counts as one run.
    """
    counts = np.diff(words.first)
    total = len(words.hash)
    k = max(0, total - n + 1)
    runs = np.zeros(k, dtype=np.uint64)
    for j in range(n):
        runs += words.hash[j:j + k] * _STEPS[j]
    keep = np.ones(k, dtype=bool)
    for j in range(1, n):  # runs that start in the last n - 1 words of a text
        at = words.first[1:] - j
        at = at[(at >= 0) & (at < k)]
        keep[at] = False
    runs = mixed(runs[keep])
    sizes = np.maximum(counts - n + 1, 0)
    if short_whole and (short := np.flatnonzero((counts > 0) & (counts < n))).size:
        where = (np.concatenate([[0], np.cumsum(sizes)]))[short]
        whole = [mixed(np.array([int(words.hash[words.first[i]:words.first[i + 1]].astype(object) @
                                     _STEPS[:counts[i]].astype(object) + int(counts[i])) % 2 ** 64], dtype=np.uint64))[0]
                 for i in short]
        runs = np.insert(runs, where, whole)
        sizes[short] = 1
    return runs, np.concatenate([[0], np.cumsum(sizes)])


def parts(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges with about ``SLICE`` bytes of text each; a longer text is a range of its own."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    at = 0
    while at < len(column):
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE, side="right")) - 1)
        yield at, upto
        at = upto


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    for at, upto in parts(batch.column(column)):
        yield batch.slice(at, upto - at)


def lists(values: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values, kind))
