"""Words and their hashes, whole Arrow batches at a time, on the UTF-8 bytes of the texts.

All arithmetic is modulo 2**64. A word of up to 64 bytes is hashed as the mixed sum of byte * base**position; longer ones, for which
such sums can be equal whatever the base, by BLAKE2. The hash of a run of words is built from those of its halves, with a mix
at each step.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Texts are taken in slices of about so many bytes, which bounds memory; a longer text is a slice of its own.
SLICE_BYTES = 2 << 20


def handing_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run``, a function of ``mapInArrow``, and then what it freed goes back to the system.

    A Python worker stays for a minute after its task, beside an executor that needs the memory for the next stage.
    """

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return wrapped


def byte_class(separators: bytes) -> np.ndarray:
    """Which byte values belong to a word."""
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


#: Words of ``[^\x20\x09-\x0D]+``.
NON_SPACE = byte_class(b" \t\n\x0b\x0c\r")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
SAME = np.arange(256, dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64: a bijection whose output bits all depend on all input bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


#: Longest word that is hashed by a sum, and how many bytes are taken at a time.
SHORT, PIECE_BYTES = 64, 4 << 20


def _powers(base: int) -> np.ndarray:
    return np.cumprod(np.array([1] + [base] * (SHORT - 1), U64), dtype=U64)


#: Two independent ways to hash a word.
BYTE_POWERS = (_powers(0x9E3779B97F4A7C15), _powers(0xD6E8FEB86659FD93))
BYTE_VALUES = (mix(np.arange(1, 257, dtype=U64) * U64(0x632BE59BD9B4E019)), mix(np.arange(257, 513, dtype=U64)))
#: And two to hash two runs as one.
LEFT = (U64(0xC2B2AE3D27D4EB4F), U64(0x9FB21C651E98DF25))


@dataclass
class Words:
    """The words of some texts. ``first[i]:first[i + 1]`` are the words of text i."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        """For each word the number of its text."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, which: int = 0) -> np.ndarray:
        """A hash per word; ``which`` picks one of two independent ones."""
        out = np.empty(len(self.starts), U64)
        at = 0
        while at < len(out):
            to = max(at + 1, int(np.searchsorted(self.ends, self.starts[at] + PIECE_BYTES, "right")))
            out[at:to] = self._piece(at, to, which)
            at = to
        for i in np.flatnonzero(self.ends - self.starts > SHORT).tolist():
            word = self.data[self.starts[i] : self.ends[i]]
            out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8, salt=bytes([which])).digest(), "little")
        return out

    def _piece(self, at: int, to: int, which: int) -> np.ndarray:
        """The sums of words ``at`` to ``to``, of their first bytes if they are long."""
        starts = self.starts[at:to]
        sizes = np.minimum(self.ends[at:to] - starts, SHORT)
        ends = np.cumsum(sizes)
        place = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)
        data = self.data[np.repeat(starts, sizes) + place]
        return mix(np.add.reduceat(BYTE_VALUES[which][data] * BYTE_POWERS[which][place], ends - sizes))

    def window_starts(self, size: int) -> np.ndarray:
        """Numbers of the words at which ``size`` words of one text begin."""
        left = np.repeat(self.first[1:], self.counts) - np.arange(len(self.starts))
        return np.flatnonzero(left >= size)


def window_hashes(hashes: np.ndarray, begin: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """The hash of the ``size`` words from each of ``begin`` on; ``which`` picks one of two independent ones.

    Runs of 1, 2, 4 and so on words are hashed from every word on, and a window is put together from those it needs.
    """
    run, at, out = hashes, begin, None
    for bit in range(size.bit_length()):
        if size >> bit & 1:
            out = run[at] if out is None else mix(out * LEFT[which] + run[at])
            at = at + (1 << bit)
        if size >> (bit + 1):
            run = mix(run[: -(1 << bit)] * LEFT[which] + run[1 << bit :])
    return mix(out + U64(size))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and where each text begins; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary())
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def split_words(data: np.ndarray, offsets: np.ndarray, word: np.ndarray) -> Words:
    inside = word[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    heads = offsets[:-1][np.diff(offsets) > 0]
    begins[heads] = inside[heads]
    tails = offsets[1:][np.diff(offsets) > 0] - 1
    stops[tails] = inside[tails]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes together."""
    n, at = len(offsets) - 1, 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, to
        at = to


def batches_of_words(column: pa.Array, word: np.ndarray, case: np.ndarray = SAME) -> Iterator[tuple[int, int, Words]]:
    """The words of a text column, slice by slice, with the range of rows of each."""
    data, offsets = utf8(column)
    for at, to in slices(offsets):
        part = data[offsets[at] : offsets[to]]
        yield at, to, split_words(case[part] if case is not SAME else part, offsets[at : to + 1] - offsets[at], word)
