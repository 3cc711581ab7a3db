"""Words of many texts at once as numpy arrays, straight from Arrow string buffers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are turned into arrays at a time; a longer single text is taken whole.
CHUNK_BYTES = 1 << 20

_rng = np.random.default_rng(20240129)
#: One random odd 64-bit number for each byte value; capitals hash like small letters.
_BYTE_CODE = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
EXACT_CODE = _BYTE_CODE
LOWER_CODE = _BYTE_CODE.copy()
LOWER_CODE[65:91] = _BYTE_CODE[97:123]
#: A multiplier and its inverse modulo 2**64, for hashes of slices by prefix sums.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


@dataclass
class Texts:
    """A chunk of texts: their bytes, and for each text its range of bytes."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: int  # row of the first text within the column


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The texts of a column in chunks of about ``limit`` bytes; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    everything = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(at, at[row] + limit, side="right")) - 1)
        end = min(end, n)
        yield Texts(
            everything[at[row] : at[end]],
            at[row:end] - at[row],
            at[row + 1 : end + 1] - at[row],
            row,
        )
        row = end


def parts(
    batches: Iterable[pa.RecordBatch], column: int, limit: int = 8 << 20
) -> Iterator[pa.RecordBatch]:
    """Batches cut so that a column has at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        row = 0
        while row < batch.num_rows:
            before = ends[row - 1] if row else 0
            end = max(row + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(row, end - row)
            row = end


_power_table: dict[int, np.ndarray] = {}


def _powers(n: int, base: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64; kept by the process up to some 16 MB."""
    known = _power_table.get(base)
    if known is not None and len(known) >= n:
        return known[:n]
    size = max(-(-n // (1 << 18)), 1) << 18
    out = np.ones(size, dtype=np.uint64)
    done = 1
    while done < size:
        more = min(done, size - done)
        out[done : done + more] = out[:more] * np.uint64(pow(base, done, 2**64))
        done += more
    if size <= 1 << 21:
        _power_table[base] = out
    return out[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word of the chunk: first byte, byte behind it, and text (row in the chunk)."""
    if not len(texts.data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~_IS_SPACE[texts.data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    opened = texts.starts[(texts.starts < texts.ends)]
    begins[opened] = inside[opened]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    last = texts.ends[(texts.starts < texts.ends)] - 1
    stops[last] = inside[last]
    first = np.flatnonzero(begins)
    behind = np.flatnonzero(stops) + 1
    return first, behind, np.searchsorted(texts.ends, first, side="right")


def word_hashes(
    texts: Texts, first: np.ndarray, behind: np.ndarray, codes: np.ndarray = LOWER_CODE
) -> np.ndarray:
    """A 64-bit hash of each word; with the default codes A-Z hash like a-z."""
    n = len(texts.data)
    if not len(first):
        return np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(codes[texts.data] * _powers(n, _BASE), dtype=np.uint64, out=sums[1:])
    shifted = (sums[behind] - sums[first]) * _powers(n, _INVERSE)[first]
    return mix(shifted + (behind - first).astype(np.uint64))


def hash_of(word: str) -> int:
    """The hash that ``word_hashes`` gives to one word."""
    data = np.frombuffer(word.encode(), np.uint8)
    one = Texts(data, np.array([0]), np.array([len(data)]), 0)
    return int(word_hashes(one, np.array([0]), np.array([len(data)]))[0])


def shingle_hashes(hashes: np.ndarray, row: np.ndarray, n_rows: int, size: int) -> tuple:
    """64-bit hashes of the runs of ``size`` words of each text, and their texts.

    A text with fewer words, but at least one, has its whole sequence as its only shingle.
    """
    n = len(hashes)
    counts = np.bincount(row, minlength=n_rows)
    mixed = np.zeros(max(n - size + 1, 0), dtype=np.uint64)
    for k in range(size):
        mixed = mix(mixed + hashes[k : n - size + 1 + k]) if n >= size else mixed
    whole = row[: n - size + 1] == row[size - 1 :] if n >= size else np.zeros(0, bool)
    out, rows = mixed[whole], row[: len(mixed)][whole]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        begin = np.concatenate([[0], np.cumsum(counts)])
        extra = np.zeros(len(short), dtype=np.uint64)
        for k in range(size - 1):
            has = counts[short] > k
            at = begin[short[has]] + k
            extra[has] = mix(extra[has] + hashes[at])
        extra = mix(extra ^ (np.uint64(0xA5A5A5A5) + counts[short].astype(np.uint64)))
        out, rows = np.concatenate([out, extra]), np.concatenate([rows, short])
    return out, rows
