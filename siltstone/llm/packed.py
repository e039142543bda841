"""Whole-batch text work on Arrow buffers: words, their hashes, and compact integer arrays.

A batch is walked in chunks of about a megabyte, so temporary arrays stay small whatever the size of
the batch; only a single document longer than a chunk makes its chunk longer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
CHUNK_ROWS = 1 << 13

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Bytes of words as `[^\x20\x09-\x0D]+` has them.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

# Bytes of words as `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` has them, after A-Z are lower-cased.
LETTER_DIGIT = np.zeros(256, dtype=bool)
LETTER_DIGIT[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


@dataclass
class Chunk:
    """Rows [first, last) of a batch: their bytes, and where each row starts and ends in them."""

    first: int
    last: int
    data: np.ndarray
    bounds: np.ndarray


@dataclass
class Words:
    """Words of a chunk: byte spans, and for row i its words are [rows[i], rows[i + 1])."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray


def chunks(column: pa.Array, limit: int = CHUNK_BYTES, rows: int = CHUNK_ROWS) -> Iterator[Chunk]:
    """Consecutive rows of a string column, about `limit` bytes and at most `rows` rows at a time.

    Null counts as empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    n, at = len(column), column.offset
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64 if wide else np.int32)[at : at + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), first + rows, n)
        low, high = offsets[first], offsets[last]
        yield Chunk(first, last, data[low:high], offsets[first : last + 1] - low)
        first = last


def words(chunk: Chunk, inside: np.ndarray = NOT_SPACE) -> Words:
    """Maximal runs of `inside` bytes per row, in lower case (A-Z only)."""
    data = LOWER[chunk.data]
    flag = np.zeros(len(data) + 2, dtype=bool)
    flag[1:-1] = inside[data]
    edge = flag[1:] != flag[:-1]  # edge[i]: a run starts or ends before byte i
    starts = edge & flag[1:]
    ends = edge & flag[:-1]
    # A run that goes over a row's end is two words.
    cuts = chunk.bounds[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    over = cuts[flag[cuts] & flag[cuts + 1]]
    starts[over] = True
    ends[over] = True
    first = np.flatnonzero(starts)
    return Words(data, first, np.flatnonzero(ends), np.searchsorted(first, chunk.bounds))


_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = np.random.Generator(np.random.PCG64(20240)).integers(0, 1 << 64, 256, dtype=np.uint64)
_WORDS_AT_ONCE = 1 << 14


def powers(base: np.uint64, n: int) -> np.ndarray:
    """The first n powers of `base` modulo 2^64."""
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out)


_HELD = {int(base): powers(base, 1 << 18) for base in (_BASE, _INVERSE)}


def _first_powers(base: np.uint64, n: int) -> np.ndarray:
    held = _HELD[int(base)]
    return held[:n] if n <= len(held) else powers(base, n)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the splitmix finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(w: Words) -> np.ndarray:
    """64-bit hash of every word: a polynomial in random byte values, read off prefix sums.

    Some thousand words at a time, so that temporary arrays stay in the processor's cache.
    """
    out = np.empty(len(w.starts), dtype=np.uint64)
    for k in range(0, len(out), _WORDS_AT_ONCE):
        starts, ends = w.starts[k : k + _WORDS_AT_ONCE], w.ends[k : k + _WORDS_AT_ONCE]
        low, n = starts[0], int(ends[-1] - starts[0])
        prefix = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE[w.data[low : low + n]] * _first_powers(_BASE, n), out=prefix[1:])
        h = (prefix[ends - low] - prefix[starts - low]) * _first_powers(_INVERSE, n + 1)[starts - low]
        out[k : k + len(h)] = mixed(h + (ends - starts).astype(np.uint64))
    return out
