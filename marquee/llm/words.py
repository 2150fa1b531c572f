"""Words of texts as 64-bit hashes, found on the UTF-8 bytes of a whole Arrow batch at once.

A word is a run of bytes other than space and 0x09-0x0D, with A-Z lower-cased, or all letters if asked for. Its hash is a sum of
random values of its bytes times random odd values of their positions, mixed; two different words get
the same hash with a chance of about 2**-63. Work is done in chunks of whole texts of about a megabyte.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
SEPARATORS = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the finalizer of splitmix64)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def folding(separators: list[int]) -> np.ndarray:
    """Table from byte to lower-cased byte, 0 for separators."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[separators] = 0
    table[0] = 1 if 0 not in separators else 0
    return table


def case_folded(column: pa.Array) -> pa.Array:
    """Texts without case in any language, so that capitals meet their small letters (also SS and ß); bytes that are no UTF-8 stay."""
    texts = column.cast(pa.large_binary()).to_pylist()
    return pa.array([t if t.isascii() else t.decode("utf-8", "surrogateescape").casefold().encode("utf-8", "surrogateescape") for t in texts], pa.large_binary())


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where the texts begin, and the end; and their bytes."""
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


class Words(NamedTuple):
    first: int  # position of the chunk's first text in the batch
    offsets: np.ndarray  # of each text's words, and the end
    hashes: np.ndarray  # uint64 of each word
    starts: np.ndarray  # byte of each word in data
    ends: np.ndarray  # byte after each word
    data: np.ndarray  # bytes of the chunk's texts
    texts: np.ndarray  # byte of each text in data, and the end
    prefixes: list[np.ndarray]  # uint64 of each word's first bytes, for every asked length; the word's if it is no longer


class Splitter:
    def __init__(self, separators: list[int] | None = None, prefixes: tuple[int, ...] = (), unicode: bool = False):
        self.prefixes, self.unicode, self.chunk_bytes = prefixes, unicode, CHUNK_BYTES
        self.fold = folding(SEPARATORS if separators is None else separators)
        self.of_byte = mixed(np.arange(256, dtype=np.uint64) << np.uint64(20))
        self.of_byte[0] = 0
        self.of_place = self._places(64)

    @staticmethod
    def _places(n: int) -> np.ndarray:
        return mixed(np.arange(n, dtype=np.uint64) + np.uint64(1 << 40)) | np.uint64(1)

    def chunks(self, column: pa.Array) -> Iterator[Words]:
        column = column.cast(pa.large_string()).fill_null("")
        offsets, data = _bytes_of(column)
        at = 0
        while at < len(column):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + self.chunk_bytes, "right")) - 1)
            if self.unicode:
                places, folded = _bytes_of(case_folded(column[at:to]))
                yield self._split(at, folded[: places[-1]], places)
            else:
                yield self._split(at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
            at = to

    def _split(self, first: int, data: np.ndarray, texts: np.ndarray) -> Words:
        low = self.fold[data]
        word = low != 0
        begin, end = word.copy(), word.copy()
        begin[1:] &= ~word[:-1]
        end[:-1] &= ~word[1:]
        edges = texts[:-1][texts[:-1] < texts[1:]]  # texts do not run into each other
        begin[edges] = word[edges]
        last = texts[1:][texts[:-1] < texts[1:]] - 1
        end[last] = word[last]
        starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
        if not len(starts):
            return Words(first, np.zeros(len(texts), np.int64), np.zeros(0, np.uint64), starts, ends, data, texts, [np.zeros(0, np.uint64) for _ in self.prefixes])
        longest = int((ends - starts).max())
        if longest > len(self.of_place):
            self.of_place = self._places(2 * longest)
        origin = np.zeros(len(data), np.int32)
        origin[starts] = starts
        place = np.arange(len(data), dtype=np.int32) - np.maximum.accumulate(origin)
        np.minimum(place, len(self.of_place) - 1, out=place)  # separators behind a word; they count 0
        with np.errstate(over="ignore"):
            values = self.of_byte[low] * self.of_place[place]
            hashes = mixed(np.add.reduceat(values, starts))
            prefixes = [mixed(np.add.reduceat(np.where(place < k, values, np.uint64(0)), starts)) for k in self.prefixes]
        return Words(first, np.searchsorted(starts, texts), hashes, starts, ends, data, texts, prefixes)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n neighbours; crossing the end of a text is for the caller to drop."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = hashes[: len(hashes) - n + 1].copy()
        for k in range(1, n):
            out *= np.uint64(0x2545F4914F6CDD1D)
            out += hashes[k : len(hashes) - n + 1 + k]
        return mixed(out + np.uint64(n))
