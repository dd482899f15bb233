"""Words, shingles and their 64-bit hashes for whole Arrow batches of texts, as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; a longer text is worked on alone.
SLICE_BYTES = 1 << 20

_rng = np.random.default_rng(20240601)
_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_EXACT = _VALUE.copy()
_VALUE[65:91] = _VALUE[97:123]  # A-Z as a-z
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: Bytes that are words' bytes under the two rules of words.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Each byte with A-Z as a-z.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the hash's base and of its inverse, modulo 2**64."""
    if len(_powers[0]) <= n:
        size = 1 << int(n).bit_length()
        for k, base in enumerate((_BASE, _BASE_INV)):
            full = np.full(size + 1, base, np.uint64)
            full[0] = 1
            _powers[k] = np.cumprod(full, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes and the n + 1 offsets of a string column; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[ends[0] : ends[-1]], ends - ends[0]


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of pieces of about `most` bytes, whole texts each."""
    data, ends = raw(column)
    row, n = 0, len(ends) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(ends, ends[row] + most, "right")) - 1)
        yield row, end, data[ends[row] : ends[end]], ends[row : end + 1] - ends[row]
        row = end


def word_spans(data: np.ndarray, ends: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each text the index of its first word (n + 1 values)."""
    on = np.zeros(len(data) + 2, bool)
    on[1:-1] = is_word[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = True
    starts = np.flatnonzero(on[1:] & (~on[:-1] | edge))
    stops = np.flatnonzero(on[:-1] & (~on[1:] | edge))
    return starts, stops, np.searchsorted(starts, ends)


def span_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, fold: bool = True) -> np.ndarray:
    """A 64-bit hash of each span of bytes, with fold A-Z taken as a-z; equal spans have equal hashes anywhere."""
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_VALUE if fold else _EXACT)[data] * up[: len(data)], out=total[1:])
    return mix((total[stops] - total[starts]) * down[starts])


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two hashes in order."""
    return mix(a * np.uint64(0xD6E8FEB86659FD93) + (b ^ (b >> np.uint64(32))) * np.uint64(0xA0761D6478BD642F) + np.uint64(1))


def shingle_sets(data: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed shingles of `width` words of every text, ascending in each; and n + 1 offsets.

    A text of fewer words, but not none, has its whole word sequence as its one shingle.
    """
    starts, stops, first = word_spans(data, ends, NOT_SPACE)
    h = span_hashes(data, starts, stops)
    n = np.diff(first)
    text = np.repeat(np.arange(len(n)), n)
    parts, owners = [], []
    if len(h) >= width:
        s = h[: len(h) - width + 1]
        for k in range(1, width):
            s = combine(s, h[k : len(h) - width + 1 + k])
        inside = text[: len(s)] == text[width - 1 :]
        parts.append(s[inside])
        owners.append(text[: len(s)][inside])
    for k in range(1, width):  # texts of exactly k words
        which = np.flatnonzero(n == k)
        if len(which):
            s = h[first[which]]
            for j in range(1, k):
                s = combine(s, h[first[which] + j])
            parts.append(mix(s + np.uint64(k)))
            owners.append(which)
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(len(n) + 1, np.int64)
    s, o = np.concatenate(parts), np.concatenate(owners)
    order = np.lexsort((s, o))
    s, o = s[order], o[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (o[1:] != o[:-1])
    s, o = s[new], o[new]
    return s, np.searchsorted(o, np.arange(len(n) + 1))


class Vocabulary:
    """A set of words (A-Z folded), numbered by the order of their hashes."""

    def __init__(self, words: set[bytes]):
        listed = sorted(words)
        data = np.frombuffer(b"".join(listed), np.uint8)
        stops = np.cumsum([len(w) for w in listed]).astype(np.int64)
        starts = np.concatenate([[0], stops[:-1]]).astype(np.int64)
        h = span_hashes(data, starts, stops)
        order = np.argsort(h)
        self.hashes, self.data = h[order], data
        self.starts, self.sizes = starts[order], (stops - starts)[order]
        self.number = {listed[k]: n for n, k in enumerate(order.tolist())}

    def __len__(self) -> int:
        return len(self.hashes)

    def find(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word, term) for the words that are terms: hashes select, the words themselves are compared."""
        if not len(self) or not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        h = span_hashes(data, starts, stops)
        term = np.searchsorted(self.hashes, h)
        term[term == len(self)] = 0
        at = np.flatnonzero(self.hashes[term] == h)
        term = term[at]
        same = self.sizes[term] == stops[at] - starts[at]
        at, term = at[same], term[same]
        size = self.sizes[term]
        first = np.cumsum(size) - size
        step = np.arange(int(size.sum())) - np.repeat(first, size)
        differ = FOLD[data[np.repeat(starts[at], size) + step]] != self.data[np.repeat(self.starts[term], size) + step]
        if differ.any():
            right = np.ones(len(at), bool)
            right[np.repeat(np.arange(len(at)), size)[differ]] = False
            at, term = at[right], term[right]
        return at, term
