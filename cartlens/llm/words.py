"""Words of whole texts as 64-bit hashes, for use inside tasks.

All functions work on the UTF-8 bytes of an Arrow array in blocks of fixed size, so memory beyond the words'
own arrays does not grow with the length of a text. A word's hash is a polynomial over random 64-bit values of
its bytes; two different words share one with a probability of about 2**-55.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19  # bytes looked at together
SLICE_BYTES = 2 << 20  # texts handled together; a longer text is a slice of its own

_rng = np.random.default_rng(20240601)
_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)

# Separators of a word, and A-Z in lower case.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALPHANUMERIC = np.ones(256, bool)
for low, high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    NOT_ALPHANUMERIC[low : high + 1] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(pow(base, done, 2**64))
        done += more
    return out


_POWER = _powers(_BASE, BLOCK_BYTES + 1)
_BACK = _powers(_INVERSE, BLOCK_BYTES + 1)


class Words(NamedTuple):
    """Words of some texts, in order: where they begin and end in the texts' bytes, and their hashes.

    ``first[i]:first[i + 1]`` are the words of text i, ``offset[i]`` is where its bytes begin.
    """

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    offset: np.ndarray
    data: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def of_text(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a fixed bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 and bytes of a string array; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if offsets is None or len(texts) == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    at = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return at - at[0], whole[at[0] : at[-1]]


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts with at most so many bytes together, or of one text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    offset, _ = buffers(texts)
    low, n = 0, len(texts)
    while low < n:
        high = max(low + 1, int(np.searchsorted(offset, offset[low] + most, "right")) - 1)
        yield low, min(high, n)
        low = min(high, n)


def words(texts: pa.Array, separators: np.ndarray = SPACES, fold: np.ndarray = LOWER) -> Words:
    """The words of each text: runs of bytes that are no separators, with A-Z in lower case."""
    offset, data = buffers(texts)
    n = len(data)
    value = _VALUE[fold]
    starts, ends, at_start, at_end, back = [], [], [], [], []
    total, before = 0, False  # the polynomial so far; whether the byte before belongs to a word
    for low in range(0, n, BLOCK_BYTES):
        block = data[low : low + BLOCK_BYTES]
        high = low + len(block)
        inside = ~separators[block]
        previous = np.empty(len(block), bool)
        previous[0], previous[1:] = before, inside[:-1]
        edge = np.zeros(len(block), bool)
        edge[offset[np.searchsorted(offset, low) : np.searchsorted(offset, high)] - low] = True
        begin = np.flatnonzero(inside & (~previous | edge))
        finish = np.flatnonzero(previous & (~inside | edge))
        power, power_back = pow(_BASE, low, 2**64), pow(_INVERSE, low, 2**64)
        term = value[block] * _POWER[: len(block)] * np.uint64(power)
        sums = np.empty(len(block) + 1, np.uint64)
        sums[0] = total
        np.cumsum(term, out=sums[1:])
        sums[1:] += np.uint64(total)
        starts.append(begin + low)
        ends.append(finish + low)
        at_start.append(sums[begin])
        at_end.append(sums[finish])
        back.append(_BACK[begin] * np.uint64(power_back))
        total, before = int(sums[-1]), bool(inside[-1])
    if before:
        ends.append(np.array([n]))
        at_end.append(np.array([total], np.uint64))
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    start, end = join(starts, np.int64), join(ends, np.int64)
    hashed = mix((join(at_end, np.uint64) - join(at_start, np.uint64)) * join(back, np.uint64) ^ np.uint64(_BASE))
    return Words(hashed, start, end, np.searchsorted(start, offset), offset, data)


def hash_ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of ranges of bytes, in order and without gaps between the first and the last."""
    out = np.zeros(len(start), np.uint64)
    low = int(start[0]) if len(start) else 0
    while len(start) and low < end[-1]:
        block = data[low : min(low + BLOCK_BYTES, int(end[-1]))]
        sums = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(_VALUE[block] * _POWER[: len(block)], out=sums[1:])
        a, b = np.searchsorted(end, low, "right"), np.searchsorted(start, low + len(block), "left")
        inside = slice(a, b)
        first, last = np.maximum(start[inside], low) - low, np.minimum(end[inside], low + len(block)) - low
        part = (sums[last] - sums[first]) * _BACK[first]
        # A range that began in an earlier block goes on where its own powers left off.
        if b > a and start[a] < low:
            part[:1] *= np.uint64(pow(_BASE, low - int(start[a]), 2**64))
        out[inside] += part
        low += len(block)
    return mix(out ^ np.uint64(_BASE))


def hash_word(word: str) -> int:
    """The hash that ``words`` gives a single word."""
    return int(words(pa.array([word], pa.string())).hash[0])


def distinct_per_text(hashed: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each text, sorted, and where each text's values begin."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.argsort(hashed, kind="stable")
    order = order[np.argsort(text[order], kind="stable")]
    text, hashed = text[order], hashed[order]
    new = np.ones(len(hashed), bool)
    new[1:] = (hashed[1:] != hashed[:-1]) | (text[1:] != text[:-1])
    return hashed[new], np.searchsorted(text[new], np.arange(len(first)))


_ODD = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(found: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's distinct shingles, sorted, and where each text's begin; a text of fewer words
    has the whole sequence as its only one, a text without words has none."""
    count = found.counts()
    number = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    first = np.concatenate([[0], np.cumsum(number)])
    at = np.arange(first[-1]) + np.repeat(found.first[:-1] - first[:-1], number)
    length = np.repeat(np.minimum(count, size), number)
    out = length.astype(np.uint64)
    for i in range(size):
        if len(found.hash):
            word = found.hash[np.minimum(at + i, len(found.hash) - 1)]
            out += np.where(i < length, mix(word + _ODD[i]) * _ODD[i + 32], np.uint64(0))
    return distinct_per_text(mix(out), first)
