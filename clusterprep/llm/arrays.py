"""Numpy views of Arrow text, and hashes of words and k-grams.

Tasks work on slabs: runs of rows with about `SLAB` bytes of text. A single
longer text is a slab of its own, so memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

SLAB = 1 << 18

_LETTERS = np.arange(256, dtype=np.uint8)
LOWER = np.where((_LETTERS >= 65) & (_LETTERS <= 90), _LETTERS + 32, _LETTERS).astype(np.uint8)
# Digits, lower-case letters and every byte of a non-ASCII character.
WORD_BYTE = (
    ((_LETTERS >= 48) & (_LETTERS <= 57)) | ((_LETTERS >= 97) & (_LETTERS <= 122)) | (_LETTERS >= 128)
)

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def slabs(batches: Iterable[pa.RecordBatch], text: str, size: int = SLAB) -> Iterator[pa.RecordBatch]:
    """The batches' rows in runs of at most `size` text bytes, or of one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets = text_bytes(batch.column(text))[1]
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1
            end = min(max(end, start + 1), batch.num_rows, start + 4096)
            yield batch.slice(start, end - start)
            start = end


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the n + 1 offsets into them; null is empty."""
    if not pa.types.is_string(texts.type):
        texts = texts.cast(pa.string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    if len(texts) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def powers(count: int, down: bool = False) -> np.ndarray:
    """First powers of the hash base, or of its inverse, modulo 2^64."""
    name = "down" if down else "up"
    if len(_powers[name]) < count:
        table = np.full(max(count, SLAB + 1), _INVERSE if down else _BASE, np.uint64)
        table[0] = 1
        _powers[name] = np.cumprod(table, dtype=np.uint64)
    return _powers[name][:count]


class Words:
    """Words of the texts of one slab: maximal runs of word bytes, lower case.

    `start` and `end` are byte positions, `of` the first word of each text
    (n + 1 values), `hash` a 64-bit hash of each word's bytes.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        # Bytes wrap round, so one comparison tests a range; faster than a table.
        self.data = data | (((data - np.uint8(65)) < 26).view(np.uint8) << np.uint8(5))
        inside = (self.data - np.uint8(97)) < 26
        inside |= (data - np.uint8(48)) < 10
        inside |= data >= 128
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        borders = offsets[1:-1]
        borders = borders[borders < len(inside)]
        first[borders] = inside[borders]
        last = inside.copy()
        last[:-1] &= first[1:] | ~inside[1:]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.of = np.searchsorted(self.start, offsets)
        self.hash = self._hashes()

    def _hashes(self) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, np.uint64)
        terms = np.add(self.data, np.uint64(1), dtype=np.uint64)
        terms *= powers(len(terms))
        total = np.zeros(len(terms) + 1, np.uint64)
        np.cumsum(terms, out=total[1:])
        sums = total[self.end] - total[self.start]
        sums *= powers(len(terms), down=True)[self.start]
        sums += (self.end - self.start).astype(np.uint64)
        return mix(sums)

    def text(self, first: int, last: int) -> bytes:
        """Words first to last - 1, joined by spaces."""
        return b" ".join(self.data[self.start[i] : self.end[i]].tobytes() for i in range(first, last))


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k values from each position on (len - k + 1 of them)."""
    count = len(hashes) - k + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for j in range(k):
        total *= np.uint64(0xD1342543DE82EF95)
        total += hashes[j : j + count]
    return mix(total)
