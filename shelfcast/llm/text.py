"""Vectorised word splitting and hashing over whole Arrow string columns.

A word is a maximal run of characters other than blank and ``\\t\\n\\v\\f\\r``. All six are
single bytes in UTF-8, so words are found in the column's byte buffer without decoding.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE_VALUE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, 256, dtype=np.uint64)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        steps = np.full(max(n, 1 << 20), _BASE if kind == "up" else _BASE_INVERSE, np.uint64)
        steps[0] = 1
        _powers[kind] = np.cumprod(steps, dtype=np.uint64)
    return _powers[kind][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser; a bijection, so it adds no collisions."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums of bytes (or of 64-bit hashes), wrapping at 2**64; n + 1 values."""
    values = _BYTE_VALUE[data] if data.dtype == np.uint8 else data
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(values * _power("up", len(data)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span that depends on its content only."""
    shift = _power("down", len(sums))[starts]
    return mix((sums[ends] - sums[starts]) * shift + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """The words of some texts: ``starts``/``ends`` index ``data``; text i has words ``first[i]:first[i + 1]``."""

    data: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, step: int = 1 << 21) -> np.ndarray:
        """One hash for each word; about ``step`` bytes are worked on at a time."""
        out, at = np.empty(len(self.starts), np.uint64), 0
        while at < len(out):
            begin = self.starts[at]
            to = max(at + 1, int(np.searchsorted(self.ends, begin + step, "right")))
            sums = prefix_sums(self.data[begin : self.ends[to - 1]])
            out[at:to] = span_hashes(sums, self.starts[at:to] - begin, self.ends[at:to] - begin)
            at = to
        return out


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the bounds of each; null counts as empty."""
    texts = pc.fill_null(texts, "")
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    bounds = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[bounds[0] : bounds[-1]] if raw is not None else np.empty(0, np.uint8)
    return data, bounds - bounds[0]


def split_words(data: np.ndarray, bounds: np.ndarray) -> Words:
    word = ~SPACES[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    opens = word.copy()
    opens[1:] &= ~word[:-1] | edge[1:-1]
    closes = word.copy()
    closes[:-1] &= ~word[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return Words(data, bounds, starts, ends, np.searchsorted(starts, bounds))


def words_of(texts: pa.Array, *, lower: bool = False) -> Words:
    data, bounds = buffer_of(texts)
    return split_words(LOWER[data] if lower else data, bounds)


def pieces(texts: pa.Array, most: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts have at most ``most`` bytes together (one row at least), to bound memory."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    total = np.concatenate([[0], np.cumsum(sizes)])
    at = 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(total, total[at] + most, "right")) - 1)
        yield at, to
        at = to


def lines_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of each line; every text has one more line than it has line breaks."""
    breaks = np.flatnonzero(data == 10)
    starts = np.concatenate([bounds[:-1], breaks + 1])
    text = np.concatenate([np.arange(len(bounds) - 1), np.searchsorted(bounds, breaks, "right") - 1])
    order = np.lexsort((starts, text))
    starts, text = starts[order], text[order]
    ends = bounds[1:][text]
    inner = np.flatnonzero(text[1:] == text[:-1])
    ends[inner] = starts[inner + 1] - 1
    return starts, ends, text


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
