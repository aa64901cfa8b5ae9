"""Token ids of whole texts with a given byte-pair vocabulary, for use inside tasks.

A text falls into pieces that can be encoded apart: one begins at each white space behind a character that is
none. Equal pieces of a block are encoded once, all new ones in one call, and put together by numpy. The ids
are exactly those of the vocabulary's own encoder on the whole text.
"""

from __future__ import annotations

import base64
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import tiktoken

from cartlens.llm.words import SPACES, buffers, hash_ranges, slices

BLOCK = 4 << 20  # bytes encoded together; a longer text is encoded in several blocks
REMEMBERED = 1 << 18  # pieces whose ids a worker remembers

# Fixed value: the pattern of the public vocabularies' pre-tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Vocabulary(NamedTuple):
    """The bytes of a vocabulary file (a token in base 64 and its id in each line), sent to the tasks."""

    ranks: bytes
    pattern: str = PATTERN

    @staticmethod
    def read(path: str, pattern: str = PATTERN) -> Vocabulary:
        with open(path, "rb") as file:
            return Vocabulary(file.read(), pattern)

    @property
    def size(self) -> int:
        """Ids of tokens; the number itself is free, and ends a text."""
        return 1 + max(int(line.split()[1]) for line in self.ranks.splitlines())

    @property
    def kind(self) -> np.dtype:
        return np.dtype(">u2" if self.size < 1 << 16 else ">u4")


def _breaks(data: np.ndarray) -> np.ndarray:
    """Where a piece may begin: at white space behind a character that is none, whatever stands around."""
    space = SPACES[data]
    p1, p2, p3 = (np.concatenate([np.zeros(k, np.uint8), data[:-k]])[: len(data)] for k in (1, 2, 3))
    before = np.concatenate([[True], space[:-1]])[: len(data)]
    wide = ((p2 == 0xC2) & ((p1 == 0x85) | (p1 == 0xA0))) | (
        (p3 >= 0xE1) & (p3 <= 0xE3) & ((p2 == 0x9A) | (p2 == 0x80) | (p2 == 0x81))
    )
    return space & ~before & ~wide


class Encoder:
    def __init__(self, vocabulary: Vocabulary) -> None:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.ranks.splitlines())}
        self.inner = tiktoken.Encoding("given", pat_str=vocabulary.pattern, mergeable_ranks=ranks, special_tokens={})
        self.end, self.kind = vocabulary.size, vocabulary.kind
        self.length = np.zeros(vocabulary.size, np.int64)
        for token, number in ranks.items():
            self.length[number] = len(token)
        self.keys = np.zeros(0, np.uint64)
        self.begin = self.number = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _plain(self, data: bytes) -> np.ndarray:
        return np.array(self.inner.encode_ordinary(data.decode("utf-8")), np.uint32)

    def _new(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these pieces, one after another, and how many each has."""
        # A line break keeps apart what doesn't begin with white space; it is a token of its own.
        lead = ~SPACES[data[start]]
        size = end - start + lead
        place = np.concatenate([[0], np.cumsum(size)])
        joined = np.empty(place[-1], np.uint8)
        joined[place[:-1][lead]] = 0x0A
        at = np.arange(place[-1]) - np.repeat(place[:-1] + lead, size)
        body = at >= 0
        joined[body] = data[(at + np.repeat(start, size))[body]]
        ids = self._plain(joined.tobytes())
        stop = np.cumsum(self.length[ids])
        number = np.diff(np.searchsorted(stop, place, "right"))
        drop = np.searchsorted(stop, place[:-1][lead], "right")
        return np.delete(ids, drop), number - lead

    def _pieces(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all these pieces in order, and how many each has."""
        coded = pa.array(hash_ranges(data, start, end)).dictionary_encode()
        which, keys = coded.indices.to_numpy(), coded.dictionary.to_numpy()
        sample = np.empty(len(keys), np.int64)
        sample[which[::-1]] = np.arange(len(which))[::-1]
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        known = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        # What doesn't begin or end as a piece among others does (at the ends of a text) is encoded alone.
        opening = data[start[sample]]
        follows = _breaks_after(data, end[sample]) & ~np.isin(opening, (0xC2, 0xE1, 0xE2, 0xE3))
        number, begin = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        number[known], begin[known] = self.number[at[known]], self.begin[at[known]]
        parts, total = [self.ids], len(self.ids)
        new = np.flatnonzero(~known & follows)
        if len(new):
            ids, number[new] = self._new(data, start[sample[new]], end[sample[new]])
            begin[new] = total + np.cumsum(number[new]) - number[new]
            parts.append(ids)
            total += len(ids)
        for i in np.flatnonzero(~known & ~follows):
            ids = self._plain(data[start[sample[i]] : end[sample[i]]].tobytes())
            begin[i], number[i] = total, len(ids)
            parts.append(ids)
            total += len(ids)
        table = np.concatenate(parts)
        if len(self.keys) < REMEMBERED and len(new):
            seen = np.bincount(which, minlength=len(keys))
            keep = new[seen[new] > 1][: REMEMBERED - len(self.keys)]
            self._remember(keys[keep], begin[keep], number[keep], table)
        return _expand(table, begin[which], number[which]), number[which]

    def _remember(self, keys: np.ndarray, begin: np.ndarray, number: np.ndarray, table: np.ndarray) -> None:
        ids = _expand(table, begin, number)
        keys = np.concatenate([self.keys, keys])
        begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(number) - number])
        order = np.argsort(keys)
        self.number = np.concatenate([self.number, number])[order]
        self.keys, self.begin, self.ids = keys[order], begin[order], np.concatenate([self.ids, ids])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, one after another, and where each text's begin. A null is an empty text."""
        if len(texts) == 1:
            return self._long(texts)
        offset, data = buffers(texts)
        starts = _breaks(data)
        starts[offset[:-1][np.diff(offset) > 0]] = True
        start = np.flatnonzero(starts)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(offset), np.int64)
        ids, number = self._pieces(data, start, np.append(start[1:], len(data)))
        ends = np.concatenate([[0], np.cumsum(number)])
        return ids, ends[np.searchsorted(start, offset)]

    def _long(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        _, data = buffers(texts)
        parts, low = [np.zeros(0, np.uint32)], 0
        while low < len(data):
            part = data[low : low + 2 * BLOCK]
            start = np.flatnonzero(_breaks(part))
            start = np.concatenate([[0], start[start > 0]])
            if low + len(part) < len(data):
                start = start[start <= BLOCK] if len(start) > 1 and start[1] <= BLOCK else start
                if len(start) == 1:  # one piece that is longer than the block
                    rest = np.flatnonzero(_breaks(data[low:]))
                    rest = rest[rest > 0]
                    stop = int(rest[0]) if len(rest) else len(data) - low
                    parts.append(self._plain(data[low : low + stop].tobytes()))
                    low += stop
                    continue
                ids, _ = self._pieces(part, start[:-1], start[1:])
                low += int(start[-1])
            else:
                ids, _ = self._pieces(part, start, np.append(start[1:], len(part)))
                low = len(data)
            parts.append(ids)
        ids = np.concatenate(parts)
        return ids, np.array([0, len(ids)])


def _breaks_after(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a piece could begin at these places if white space stood there."""
    window = data[np.maximum(at[:, None] - np.arange(3, 0, -1), 0)]
    window[at[:, None] - np.arange(3, 0, -1) < 0] = 0
    p3, p2, p1 = window.T
    wide = ((p2 == 0xC2) & ((p1 == 0x85) | (p1 == 0xA0))) | (
        (p3 >= 0xE1) & (p3 <= 0xE3) & ((p2 == 0x9A) | (p2 == 0x80) | (p2 == 0x81))
    )
    return ~SPACES[p1] & ~wide


def _expand(table: np.ndarray, begin: np.ndarray, number: np.ndarray) -> np.ndarray:
    """The entries of ``table`` in ranges of these beginnings and numbers, one after another."""
    ends = np.cumsum(number)
    return table[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - number), number)]


@lru_cache(maxsize=2)
def encoder(vocabulary: Vocabulary) -> Encoder:
    """A worker's encoder of this vocabulary."""
    return Encoder(vocabulary)


def encoded(vocabulary: Vocabulary, texts: pa.Array):  # noqa: ANN201
    """For each slice of the texts: its first text, the ids, and where each text's begin."""
    for low, high in slices(texts, BLOCK):
        ids, first = encoder(vocabulary).encode(texts.slice(low, high - low))
        yield low, ids, first
