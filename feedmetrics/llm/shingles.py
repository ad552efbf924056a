"""Word shingles of texts as sets of 64-bit numbers, in numpy over batches of rows."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash

SHINGLE = 5
LOWER_AZ = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
CHUNK_BYTES = 1 << 19           # texts worked on at once
WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
LONG_WORD = 256
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(32))


def lowered_words(text: str | None) -> list[bytes]:
    """``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased, as UTF-8; null has none."""
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER_AZ).split()


def released(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows; when a task is through with them, the memory it held goes back to the machine.

    A worker process serves many tasks and would keep the largest size any of them had.
    """
    yield from rows
    give_back()


def give_back() -> None:
    """Memory that was freed goes back to the machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc has it
    if trim:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of few, so that no more than these are Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def chunks(texts: Sequence[str | None], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about ``limit`` characters; a longer text is a range of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text or "") > limit:
            yield start, i
            start, size = i, 0
        size += len(text or "")
    if start < len(texts):
        yield start, len(texts)


class WordHashes:
    """64-bit hashes of the words of many texts at once.

    A word is taken eight bytes at a time, each eight scrambled into the hash of those before. Words of up
    to eight bytes of one length never share a hash; any others do by chance only, about 2**-64 a pair.
    Words of more than ``LONG_WORD`` bytes are hashed one by one with XXH3.
    """

    def __init__(self, lower: bool = True):
        """``lower`` takes A-Z as a-z; else words keep their case."""
        self.signs = LOWER_AZ if lower else bytes(range(256))

    def __call__(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of the words of all texts in order, and how many words each text has."""
        words = self.read(texts)
        return words.hashes, words.counts

    def read(self, texts: Sequence[str | None]) -> "Words":
        encoded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        line = b" ".join(encoded).translate(self.signs) + b" " * 9
        signs = np.frombuffer(line, np.uint8)
        gap = WHITE[signs]
        starts = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))
        stops = np.flatnonzero(gap & np.concatenate([[False], ~gap[:-1]]))
        ends = np.cumsum([len(e) + 1 for e in encoded])
        counts = np.diff(np.concatenate([[0], np.searchsorted(starts, ends)]))
        return Words(line, starts, stops, self._hashes(line, starts, stops - starts), counts)

    @staticmethod
    def _hashes(line: bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        eights = np.ndarray(len(line) - 7, "<u8", line, strides=(1,))      # the eight bytes from every place on
        out = mix(lengths.astype(np.uint64) + _ODD)
        rows, at, left = np.arange(len(starts)), starts, lengths
        long = np.flatnonzero(lengths > LONG_WORD)
        if len(long):
            out[long] = [xxhash.xxh3_64_intdigest(line[a: a + n]) for a, n in zip(starts[long].tolist(), lengths[long].tolist())]
            rows = np.flatnonzero(lengths <= LONG_WORD)
            at, left = starts[rows], lengths[rows]
        while len(rows):
            own = eights[at] & _FIRST_BYTES[np.minimum(left, 8)]
            out[rows] = mix(out[rows] * _ODD + own)
            more = left > 8
            rows, at, left = rows[more], at[more] + 8, left[more] - 8
        return out


@dataclass
class Words:
    """The words of some texts laid end to end: places in ``line``, hashes, and words per text."""

    line: bytes
    starts: np.ndarray
    stops: np.ndarray
    hashes: np.ndarray
    counts: np.ndarray

    def word(self, i: int) -> bytes:
        return self.line[self.starts[i]: self.stops[i]]

    def some(self, places: np.ndarray) -> list[bytes]:
        line = self.line
        return [line[a:b] for a, b in zip(self.starts[places].tolist(), self.stops[places].tolist())]

    @cached_property
    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The distinct hashes in order, where each stands first, which of them every word has, and their counts."""
        return np.unique(self.hashes, return_index=True, return_inverse=True, return_counts=True)


class WordRows:
    """A row of numbers for every word, described once per word and remembered within a bound."""

    def __init__(self, describe: Callable[[str], Sequence], columns: int, kind: type, bound: int = 300_000):
        self.describe, self.bound = describe, bound
        self.keys, self.places = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.table = np.zeros((0, columns), kind)

    def __call__(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """The rows of the distinct words, and for each word which of them is its own."""
        unique, first, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, unique), max(len(self.keys) - 1, 0))
        known = self.keys[at] == unique if len(self.keys) else np.zeros(len(unique), bool)
        rows = np.zeros((len(unique), self.table.shape[1]), self.table.dtype)
        rows[known] = self.table[self.places[at[known]]]
        new = np.flatnonzero(~known)
        if len(new):
            rows[new] = [self.describe(words.word(i).decode("utf-8", "surrogatepass")) for i in first[new].tolist()]
            if len(self.table) + len(new) <= self.bound:
                where = np.searchsorted(self.keys, unique[new])
                self.keys = np.insert(self.keys, where, unique[new])
                self.places = np.insert(self.places, where, len(self.table) + np.arange(len(new)))
                self.table = np.concatenate([self.table, rows[new]])
        return rows, inverse


def shingle_sets(texts: Sequence[str | None], words: WordHashes, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, sorted: all of them in one array, and the texts' ends in it.

    A text with fewer words is one shingle; a text without words has none.
    """
    flat, counts = words(texts)
    starts = np.concatenate([[0], np.cumsum(counts)])
    rolled = np.full(max(len(flat) - size + 1, 0), size, np.uint64)
    for i in range(size):
        rolled = mix(rolled * _ODD + flat[i: len(rolled) + i])
    out = []
    for a, n in zip(starts, counts):
        if n >= size:
            out.append(np.unique(rolled[a: a + n - size + 1]))
        elif n:
            h = np.array([n], np.uint64)
            for w in flat[a: a + n]:
                h = mix(h * _ODD + w)
            out.append(h)
        else:
            out.append(flat[:0])
    ends = np.cumsum([len(s) for s in out]) if out else np.zeros(0, np.int64)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), ends
