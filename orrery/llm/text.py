"""Words of many texts at once: offsets and hashes held in arrays, without one Python object per word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 4 << 20

# The bytes between words, [\x20\x09-\x0D].
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
#: Words are hashed in spans of the data, so that tables stay small however long a text is.
SPAN = 1 << 15


def _powers(base: int) -> np.ndarray:
    """The first powers modulo 2^64, enough for a span and a word that begins in it."""
    steps = np.full(2 * SPAN + 1, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


_UP, _DOWN = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every input bit moves every output bit."""
    v = values.astype(np.uint64, copy=True)
    v ^= v >> np.uint64(30)
    v *= np.uint64(0xBF58476D1CE4E5B9)
    v ^= v >> np.uint64(27)
    v *= np.uint64(0x94D049BB133111EB)
    v ^= v >> np.uint64(31)
    return v


@dataclass(frozen=True)
class Words:
    """The words of a chunk of texts, in order; ``row`` is the text of each word."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    rows: int

    @property
    def first(self) -> np.ndarray:
        """For each text the index of its first word; one more entry closes the last."""
        return np.searchsorted(self.row, np.arange(self.rows + 1))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        out = np.zeros(len(self.start), np.uint64)
        first = 0
        for last in np.searchsorted(self.start, np.arange(SPAN, len(self.data) + SPAN, SPAN)).tolist():
            short = last
            if last > first and self.end[last - 1] - self.start[first] > 2 * SPAN:
                short -= 1
                out[short] = _long_word(self.data[self.start[short] : self.end[short]])
            if short > first:
                low, high = int(self.start[first]), int(self.end[short - 1])
                total = np.zeros(high - low + 1, np.uint64)
                values = self.data[low:high].astype(np.uint64)
                values += np.uint64(1)
                values *= _UP[: high - low]
                np.cumsum(values, out=total[1:])
                start, end = self.start[first:short] - low, self.end[first:short] - low
                out[first:short] = (total[end] - total[start]) * _DOWN[start]
            first = last
        return mix(out)


def _long_word(data: np.ndarray) -> np.uint64:
    """The sum that a short word's hash is made of, for a word longer than a span."""
    total, shift = 0, 1
    for at in range(0, len(data), SPAN):
        piece = data[at : at + SPAN].astype(np.uint64) + np.uint64(1)
        total += shift * int((piece * _UP[: len(piece)]).sum(dtype=np.uint64))
        shift = shift * pow(_BASE, SPAN, 1 << 64) % (1 << 64)
    return np.uint64(total % (1 << 64))


def find_words(texts: pa.Array, lower: bool = False) -> Words:
    """Words are runs of bytes other than the fixed spaces; a null has none. ``lower`` folds A-Z."""
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return split_words(data[offsets[0] : offsets[-1]], offsets - offsets[0], lower)


def split_words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    """The words of texts that lie in ``data`` one after the other, text ``i`` from ``offsets[i]`` on."""
    if lower:
        data = _LOWER[data]
    inside = ~_IS_SPACE[data]
    marks = inside.copy()
    np.greater(inside[1:], inside[:-1], out=marks[1:])
    first = offsets[offsets < len(data)]
    marks[first] = inside[first]
    start = np.flatnonzero(marks)
    marks[-1:] = inside[-1:]
    np.greater(inside[:-1], inside[1:], out=marks[:-1])
    last = offsets[offsets > 0] - 1
    marks[last] = inside[last]
    end = np.flatnonzero(marks) + 1
    del inside, marks
    row = np.searchsorted(offsets[1:], start, side="right")
    return Words(data, start, end, row, len(offsets) - 1)


def join_words(words: Words, chosen: np.ndarray | None = None) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words (or the chosen ones) with one space after each, and where each begins and ends."""
    start = words.start if chosen is None else words.start[chosen]
    size = (words.end if chosen is None else words.end[chosen]) - start
    begin = np.cumsum(size + 1) - size - 1
    out = np.full(int((size + 1).sum()), 0x20, np.uint8)
    shift = np.repeat(start - begin, size)
    to = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(len(shift))
    out[to] = words.data[to + shift]
    return out.tobytes(), begin, begin + size


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash for each run of ``n`` word hashes (also runs across texts)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    size = len(words) - n + 1
    total = np.zeros(size, np.uint64)
    for j in range(n):
        total *= np.uint64(_BASE)
        total += words[j : j + size]
    return mix(total)


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices of about ``limit`` bytes of text; one long text may exceed it."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = (np.cumsum(sizes, dtype=np.int64) - sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)
