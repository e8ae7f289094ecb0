"""Words of whole texts, hashed in numpy a few megabytes at a time.

A word is a run of bytes other than space and \\t \\n \\v \\f \\r, as in the pattern
[^\\x20\\x09-\\x0D]+.  Hashes only propose; whatever must be exact compares the words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20
_R = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
_RINV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = h.astype(np.uint64)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_R, 0), _powers(_RINV, 0)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _UP, _DOWN
    if len(_UP) < n:
        size = max(n, CHUNK_BYTES)
        _UP, _DOWN = _powers(_R, size), _powers(_RINV, size)
    return _UP, _DOWN


class Words:
    """The words of some texts: byte bounds, 64-bit hash and text number of each."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, fold_case: bool = False):
        """data: bytes of the texts; bounds: where each text begins, and the end."""
        if fold_case:
            data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
        self.data, self.bounds = data, bounds
        ink = ~((data == 32) | ((data >= 9) & (data <= 13)))
        first, last = ink.copy(), ink.copy()
        first[1:] &= ~ink[:-1]
        last[:-1] &= ~ink[1:]
        cuts = bounds[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(data))]
        first[cuts] |= ink[cuts]
        last[cuts - 1] |= ink[cuts - 1]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        up, down = _tables(len(data) + 1)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
        self.hash = mix((sums[self.end] - sums[self.start]) * down[self.start])
        # A text's words are [first_word[t], first_word[t + 1]).
        self.first_word = np.searchsorted(self.start, bounds)
        self.text = np.repeat(np.arange(len(bounds) - 1), np.diff(self.first_word))

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k words from each place, and whether they lie in one text."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        h = np.zeros(n, np.uint64)
        for j in range(k):
            h = h * _R + self.hash[j : j + n]
        return mix(h), self.text[:n] == self.text[k - 1 : k - 1 + n]

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def chunks(batch: pa.RecordBatch, column: str = "text", size: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows of about `size` bytes of text (one row at least): the rows, their
    texts' bytes and bounds.  A null text counts as empty."""
    texts = batch.column(batch.schema.get_field_index(column))
    if pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.string())
    lengths = pc.binary_length(texts.fill_null("")).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    at = 0
    while at < len(batch):
        base = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + size, side="right")))
        part = texts.slice(at, stop - at).fill_null("")
        offsets = np.frombuffer(part.buffers()[1], dtype=np.int32)[part.offset : part.offset + len(part) + 1].astype(np.int64)
        raw = part.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
        yield batch.slice(at, stop - at), data, offsets - offsets[0]
        at = stop


def split_words(text: str | None) -> list[str]:
    """The same words one text at a time."""
    return [w.decode() for w in (text or "").encode().split()]
