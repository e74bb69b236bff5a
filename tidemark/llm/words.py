"""Column-at-a-time word handling inside Arrow batches, shared by the operators that run in Python."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (xor-shift and odd multiplications)."""
    x = x ^ (x >> U64(31))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(29))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(32))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 16), base, U64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if n <= 1 << 21:  # longer tables are made anew, so that a worker keeps a bounded one
            _POWERS[base] = known
    return known[:max(n, 1)]


class Rolling:
    """Hashes of stretches of a sequence: sum of value * base^position, moved back to position 0."""

    def __init__(self, values: np.ndarray, base: int = BASE):
        self._sums = np.zeros(len(values) + 1, U64)
        np.cumsum(values * powers(base, len(values)), out=self._sums[1:])
        self._back = powers(pow(base, -1, 1 << 64), len(values) + 1)

    def stretch(self, start: np.ndarray, length) -> np.ndarray:
        return (self._sums[start + length] - self._sums[start]) * self._back[start]


def strings(column: pa.Array) -> pa.Array:
    """As large_string without nulls (a null becomes '')."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def chunks(batch: pa.RecordBatch, text: str, size: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text; a longer text is a slice of its own."""
    column = batch.column(batch.schema.get_field_index(text))
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + size, side="right")))
        yield batch.slice(at, to - at)
        at = to


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Words between ASCII white space: bounds of each text's words, and all words in one array."""
    lists = pc.ascii_split_whitespace(texts)
    words, offsets = lists.values, lists.offsets.to_numpy().astype(np.int64)
    words = words[offsets[0]:offsets[-1]] if len(offsets) else words
    offsets = offsets - offsets[0]
    full = pc.greater(pc.binary_length(words), 0)
    kept = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return kept[offsets], words.filter(full)


BYTES = mix(np.arange(1, 257, dtype=U64) * U64(BASE))


def word_hashes(words: pa.Array, step: int = 1 << 20) -> np.ndarray:
    """A 64-bit hash of each word's bytes; about ``step`` bytes are spread out at a time."""
    if not len(words):
        return np.zeros(0, U64)
    words = pa.concat_arrays([words])
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    data, out, at = np.frombuffer(words.buffers()[2], np.uint8), np.empty(len(words), U64), 0
    while at < len(words):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + step, side="right")) - 1)
        part = offsets[at:to + 1]
        out[at:to] = Rolling(BYTES[data[part[0]:part[-1]]]).stretch(part[:-1] - part[0], np.diff(part))
        at = to
    return mix(out)


def distinct(words: pa.Array) -> tuple[np.ndarray, list[str]]:
    """A number for each word, and the distinct words by number."""
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_pylist()


def sums_by_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the values of each text; 0 for a text without words."""
    out = np.zeros(len(bounds) - 1, values.dtype)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        out[full] = np.add.reduceat(values, bounds[full])
    return out
