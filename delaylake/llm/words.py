"""Words of Arrow text columns as numpy arrays: whole batches at once, no Python string per word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute

CHUNK_BYTES = 1 << 20
SPREAD = np.uint64(0x9E3779B97F4A7C15)
BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE and its inverse to the powers 0 to n - 1, modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 16)
        _powers[:] = []
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            _powers.append(np.cumprod(out, dtype=np.uint64))
    return _powers[0][:n], _powers[1][:n]


def sums(values: np.ndarray) -> np.ndarray:
    """Running polynomial sums (length + 1) of uint64 values, for span_hash."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values))[0], out=out[1:])
    return out


def span_hash(running: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans [start, end); equal spans have equal hashes wherever they stand."""
    raw = (running[end] - running[start]) * powers(len(running))[1][start]
    return mix(raw + (end - start).astype(np.uint64) * SPREAD)


@dataclass
class Words:
    """The words of a run of texts: bytes, bounds of each word, and where each text's words begin in those lists."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @cached_property
    def running(self) -> np.ndarray:
        return sums(self.data.astype(np.uint64) + np.uint64(1))

    @cached_property
    def hashes(self) -> np.ndarray:
        return span_hash(self.running, self.start, self.end)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @cached_property
    def text(self) -> np.ndarray:
        """Which text each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1, dtype=np.int32), self.counts)


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes and the bounds of each text; null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[bounds[0] : bounds[-1]] if held is not None and len(texts) else np.zeros(0, np.uint8)
    return data, bounds - bounds[0] if len(texts) else np.zeros(1, np.int64)


def words_of(texts: pa.Array, lower: bool = False, letters: bool = False) -> Words:
    """Words are runs of anything but space and 0x09 to 0x0D. lower: A to Z become a to z. letters: ASCII punctuation and controls part words too."""
    data, bounds = bytes_of(texts)
    if lower:
        data = data + ((data - np.uint8(65)) < 26).astype(np.uint8) * np.uint8(32)
    if letters:
        word = (data >= 128) | ((data - np.uint8(48)) < 10) | (((data | np.uint8(32)) - np.uint8(97)) < 26)
    else:
        word = ((data - np.uint8(9)) > 4) & (data != 32)
    begins, ends = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    ends[:-1] &= ~word[1:]
    inner = bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(data))]
    begins[inner] = word[inner]
    ends[inner - 1] = word[inner - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(data, start, end, np.searchsorted(start, bounds))


def chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in runs of about `limit` bytes of text; a longer text stands alone."""
    for batch in batches:
        lengths = pa.compute.binary_length(batch.column(text).cast(pa.large_string())).fill_null(0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(lengths), 0
        while at < len(ends):
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            to = min(to, at + 60_000)
            yield batch.slice(at, to - at)
            at = to


def ngrams(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every run of n words; a text of fewer words is one run, a text without words none."""
    counts = w.counts
    running = sums(w.hashes)
    begin = np.arange(len(w.start))
    last = np.repeat(w.first[1:], counts)
    full = begin + n <= last
    short = (begin == np.repeat(w.first[:-1], counts)) & ~full
    keep = full | short
    begin, last = begin[keep], last[keep]
    return span_hash(running, begin, np.minimum(begin + n, last)), w.text[keep]
