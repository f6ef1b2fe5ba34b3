"""Hashes of words and of word runs for whole Arrow batches, with arrays instead of loops over words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads each 64-bit value over all bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTE_VALUES = mixed(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
BYTE_VALUES[65:91] = BYTE_VALUES[97:123]  # A-Z as a-z
BASE, INVERSE = U(0xD1342543DE82EF95), U(pow(0xD1342543DE82EF95, -1, 1 << 64))

# Fixed value: the bytes that separate words.
SPACE_BYTE = np.zeros(256, bool)
SPACE_BYTE[[0x20, *range(0x09, 0x0E)]] = True


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, U)
    out[0] = 1
    return np.cumprod(out, dtype=U)


class Words:
    """The words of a column of texts: hash of each word, and where each text's words begin.

    ``first[i]:first[i + 1]`` are the words of text ``i``; null has none.
    """

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw else np.empty(0, np.uint8)
        data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
        word = ~SPACE_BYTE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True  # a text's end ends its last word
        start = word.copy()
        start[1:] &= ~word[:-1] | edge[1:-1]
        end = word.copy()
        end[:-1] &= ~word[1:] | edge[1:-1]
        starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
        # A polynomial over the bytes, summed up once for all words.
        sums = np.zeros(len(data) + 1, U)
        np.cumsum(BYTE_VALUES[data] * powers(BASE, len(data))[:-1], out=sums[1:])
        value = (sums[ends] - sums[starts]) * powers(INVERSE, len(data))[starts]
        self.hashes = mixed(value + (ends - starts).astype(U))
        self.first = np.searchsorted(starts, offsets)

    def runs(self, size: int) -> np.ndarray:
        """Hash of the run that begins at each word; runs across the end of a text mean nothing."""
        h = self.hashes
        out = np.zeros(len(h), U)
        for k, factor in enumerate(mixed(np.arange(1, size + 1, dtype=U))):
            out[: max(len(h) - k, 0)] += h[k:] * (factor | U(1))
        return mixed(out + U(size))


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different hashes of each text's runs of ``size`` words, one text after the other, and their bounds.

    A text of fewer words, but not none, has its whole sequence as its one run.
    """
    words = Words(texts)
    counts = np.diff(words.first)
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(owner)) - words.first[:-1][owner]
    runs = words.runs(size)
    keep = place + size <= counts[owner]
    for short in range(1, size):
        own = (place == 0) & (counts[owner] == short)
        if own.any():
            runs[own] = words.runs(short)[own]
            keep |= own
    owner, runs = owner[keep], runs[keep]
    order = np.lexsort((runs, owner))
    owner, runs = owner[order], runs[order]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:] != runs[:-1]) | (owner[1:] != owner[:-1])
    owner, runs = owner[new], runs[new]
    return runs, np.searchsorted(owner, np.arange(len(counts) + 1))
