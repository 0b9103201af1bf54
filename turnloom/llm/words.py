"""Words of Arrow text columns as numpy arrays: places, hashes, and hashes of word windows.

A word is a run of bytes other than ASCII white space. A hash of a run is a polynomial in
the ring of 64-bit integers, so hashes of all windows of a text follow from prefix sums; a
final mixing step makes the bits usable as random ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1_000_000
KEPT_POWERS = 4_000_000
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
MASK = (1 << 64) - 1
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD1B54A32D192ED03


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64; kept for later calls up to a slice."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, 1), base & MASK, dtype=np.uint64)
        steps[0] = 1
        known = np.cumprod(steps, dtype=np.uint64)
        if n <= KEPT_POWERS:
            _powers[base] = known
    return known[:n]


def run_hashes(values: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``values[start:end]`` for each run."""
    up = powers(base, len(values))
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up, out=sums[1:])
    down = powers(pow(base, -1, 1 << 64), len(values) + 1)
    return mixed((sums[ends] - sums[starts]) * down[starts])


@dataclass
class Words:
    """``hashes`` of all words of some rows, one after another; ``at``: rows' first words.

    ``data[starts:ends]`` are the bytes of the words.
    """

    hashes: np.ndarray
    at: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, row and place in the row of every window of ``size`` words of one row."""
        counts = np.maximum(np.diff(self.at) - (size - 1), 0)
        rows = np.repeat(np.arange(len(counts)), counts)
        first = np.cumsum(counts) - counts
        places = np.arange(counts.sum()) - first[rows]
        starts = self.at[rows] + places
        return run_hashes(self.hashes, WORD_BASE, starts, starts + size), rows, places

    def whole(self, row: int) -> np.ndarray:
        """Hash of all words of one row."""
        at = self.at[row : row + 2]
        return run_hashes(self.hashes[at[0] : at[1]], WORD_BASE, np.array([0]), np.diff(at))


def hash_words(texts: pa.Array, lower: bool = False, space: np.ndarray = SPACE) -> Words:
    """The words of each text, between bytes that are ``space``; a null has none."""
    texts = pc.fill_null(texts, "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], dtype=kind)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    data = data[offsets[0] : offsets[-1]] if len(offsets) else data
    offsets = offsets - offsets[0]
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64), data, none, none)
    inside = ~space[data]
    edge = np.zeros(len(data) + 1, dtype=bool)  # a row begins or ends here
    edge[offsets] = True
    before = np.concatenate([[False], inside[:-1]])
    after = np.concatenate([inside[1:], [False]])
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    data = LOWER[data] if lower else data
    values = data.astype(np.uint64)
    values += np.uint64(1)
    hashes = run_hashes(values, BYTE_BASE, starts, ends)
    return Words(hashes, np.searchsorted(starts, offsets), data, starts, ends)


def slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in pieces of about ``limit`` bytes of ``text``; a longer row stands
    alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    first = total = 0
    for row, size in enumerate(sizes.tolist()):
        if total and total + size > limit:
            yield batch.slice(first, row - first)
            first, total = row, 0
        total += size
    if first < batch.num_rows:
        yield batch.slice(first)
