"""Words of many texts as numbers, and bounded filters of number sets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 17  # bytes hashed at once: arrays that stay in the processor's cache
BITS_PER_KEY = 16
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 28
MASK = (1 << 64) - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers whose bits all depend on all bits of the input (one to one)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHasher:
    """Hashes the words between ``blanks``; with ``fold`` A-Z count as a-z.

    A word's hash is a polynomial in its bytes: differences of one running sum give the
    hashes of all words at once. Equal words have equal hashes in every task.
    """

    def __init__(self, blanks: bytes, fold: bool = False, seed: int = 0):
        self.inside = np.ones(256, bool)
        self.inside[list(blanks)] = False
        values = mixed(np.arange(1, 257, dtype=np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) & MASK))
        if fold:
            values[65:91] = values[97:123]
        self.values = values
        self.base = int(mixed(np.array([seed + 12345], np.uint64))[0]) | 1
        inverse = pow(self.base, -1, 1 << 64)
        self.powers = np.cumprod(np.full(CHUNK, self.base, np.uint64)) * np.uint64(inverse)
        self.back = np.cumprod(np.full(CHUNK + 1, inverse, np.uint64)) * np.uint64(self.base)

    def __call__(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, start and end of each word."""
        found, whole = [], np.frombuffer(data, np.uint8)
        open_ = None  # a word that goes on behind the chunk: hash, start, length
        for at in range(0, len(whole), CHUNK):
            part = whole[at : at + CHUNK]
            inside = self.inside[part]
            edge = np.empty(len(part) + 1, bool)
            edge[0], edge[-1] = inside[0], inside[-1]
            np.not_equal(inside[1:], inside[:-1], out=edge[1:-1])
            edges = np.flatnonzero(edge)
            starts, ends = edges[::2], edges[1::2]
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(self.values[part] * self.powers[: len(part)], out=sums[1:])
            hashes = (sums[ends] - sums[starts]) * self.back[starts]
            starts, ends = starts + at, ends + at
            if open_ is not None:
                value, start = open_
                if len(starts) and starts[0] == at:
                    further = pow(self.base, at - start, 1 << 64)
                    hashes[0] = (value + int(hashes[0]) * further) & MASK
                    starts[0] = start
                else:
                    found.append((np.array([value], np.uint64), np.array([start]), np.array([at])))
                open_ = None
            if len(ends) and ends[-1] == at + len(part) and at + len(part) < len(whole):
                open_ = int(hashes[-1]), int(starts[-1])
                hashes, starts, ends = hashes[:-1], starts[:-1], ends[:-1]
            found.append((hashes, starts, ends))
        if not found:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        hashes, starts, ends = (np.concatenate(parts) for parts in zip(*found))
        return mixed(hashes), starts, ends


def combined(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n neighbouring words (fewer than n words: none)."""
    count = max(0, len(hashes) - n + 1)
    total = np.zeros(count, np.uint64)
    for k in range(n):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + count]
    return mixed(total)


def slices(batch: pa.RecordBatch, text: int, size: int):
    """Parts (first row, texts as bytes) of a batch with some ``size`` bytes of text each."""
    column = batch.column(text).cast(pa.binary())
    first, parts, held = 0, [], 0
    for row, value in enumerate(column):
        parts.append(value.as_py() or b"")
        held += len(parts[-1])
        if held >= size:
            yield first, parts
            first, parts, held = row + 1, [], 0
    if parts:
        yield first, parts


def as_long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def key_filter(keys: DataFrame, key: str) -> tuple[int, bytes]:
    """A filter with one bit per cell of key hashes: (cells, bits).

    Its size is bounded by ``MOST_BITS`` (32 MB), whatever the number of keys: beyond
    1/16 of it more foreign keys pass, but never fewer of its own. ``keys`` is read twice.
    """
    cells, least = LEAST_BITS, BITS_PER_KEY * keys.count()
    while cells < min(least, MOST_BITS):
        cells *= 2
    number = F.col(key).bitwiseAND(F.lit(cells - 1).cast("long")) + 1
    blocks = (
        keys.groupBy(F.bitmap_bucket_number(number).alias("block"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))
        .collect()
    )
    out = bytearray(cells // 8)
    for block, bits in blocks:
        out[(block - 1) * 4096 : block * 4096] = bits
    return cells, bytes(out)


def passes(keys: np.ndarray, cells: int, bits: np.ndarray) -> np.ndarray:
    """Which keys the filter lets through."""
    cell = keys & np.uint64(cells - 1)
    return (bits[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 != 0
