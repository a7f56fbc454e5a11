"""Vectorised text hashing inside tasks (numpy over Arrow buffers).

Texts arrive in Arrow batches whose partitions Spark made; these helpers turn
the UTF-8 bytes of a batch into word and shingle hashes without a Python
object per word. Hashes are 64-bit and depend on the text only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE, _MASK = 0x9E3779B97F4A7C15 | 1, (1 << 64) - 1
_CHUNK = 1 << 20  # bytes hashed at a time (a longer text is a chunk by itself)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit scrambler (splitmix64 finaliser) for each seed."""
    x = x ^ U((seed * 0xD6E8FEB86659FD93) & _MASK)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _power(n: int, base: int, name: str) -> np.ndarray:
    if len(_powers.get(name, ())) < n:
        size = max(n, _CHUNK + 1)
        out = np.full(size, base, U)
        out[0] = 1
        _powers[name] = np.multiply.accumulate(out)
    return _powers[name][:n]


def as_large(column: pa.Array) -> pa.Array:
    """A string column without nulls, as large_string in one piece."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_string()).fill_null("")


def chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, offsets)`` of runs of texts of about ``_CHUNK`` bytes."""
    column = as_large(column)
    if not len(column):
        return
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(off, off[row] + _CHUNK, "right")) - 1)
        yield row, data[off[row]:off[end]], off[row:end + 1] - off[row]
        row = end


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of a chunk, and for each text the
    place of its first word (one more entry at the end)."""
    n = len(data)
    word = ~_SPACE[data]
    start = word.copy()
    start[1:] &= ~word[:-1]
    cut = offsets[(offsets > 0) & (offsets < n)]  # texts end words
    start[cut] = word[cut]
    end = word.copy()
    end[:-1] &= ~word[1:]
    end[cut - 1] = word[cut - 1]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    sums = np.zeros(n + 1, U)
    np.cumsum((_LOWER[data].astype(U) + U(1)) * _power(n + 1, _BASE, "up")[:n], out=sums[1:])
    inverse = _power(n + 1, pow(_BASE, -1, 1 << 64), "down")
    hashes = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(U) * U(0x2545F4914F6CDD1D))
    return hashes, np.searchsorted(s, offsets)


def windows_hash(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of every run of ``k`` words."""
    out = np.zeros(len(words) - k + 1, U)
    for j in range(k):
        out = out * U(0xD1342543DE82EF95) + words[j:len(words) - k + 1 + j]
    return mix(out)


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, sorted distinct shingle hashes)`` of each text; a text with
    fewer than ``k`` words has its whole sequence as one shingle, one
    without words has none."""
    for first, data, offsets in chunks(column):
        words, at = word_hashes(data, offsets)
        # windows of the whole chunk; those across two texts are never read
        windows = windows_hash(words, k) if len(words) >= k else words[:0]
        for i, (begin, end) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
            if end - begin >= k:
                h = np.sort(windows[begin:end - k + 1])
                new = h[1:] != h[:-1]
                yield first + i, h if new.all() else h[np.append(True, new)]
            elif end > begin:
                yield first + i, windows_hash(words[begin:end], end - begin) ^ U(end - begin)
            else:
                yield first + i, words[begin:end]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


#: A filter of fixed size: 2^25 bits, 4 MB, whatever the data.
FILTER_BITS = 25


def bit_of(h: np.ndarray) -> np.ndarray:
    return (mix(h, 77) >> U(64 - FILTER_BITS)).astype(np.int64)


def in_filter(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    b = bit_of(h)
    return (bits[b >> 3] >> (b & 7).astype(np.uint8)) & 1 == 1


def build_filter(df, column: str) -> np.ndarray:
    """The filter of all values of a long column.

    Bits are gathered in the tasks and combined by an aggregation of at most
    2^19 words, so what reaches the driver is 4 MB at most. A full filter
    lets everything pass: it saves work and decides nothing.
    """
    from pyspark.sql import functions as F

    def bits(batches):
        for b in batches:
            i = np.unique(bit_of(b.column(0).to_numpy(zero_copy_only=False).view(U)))
            word, first = np.unique(i >> 6, return_index=True)
            value = np.bitwise_or.reduceat(U(1) << (i & 63).astype(U), first) if len(i) else i.astype(U)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(signed(value))], ["word", "value"])

    out = np.zeros(1 << (FILTER_BITS - 6), U)
    rows = (df.select(column).where(F.col(column).isNotNull())
            .mapInArrow(bits, "word bigint, value bigint")
            .groupBy("word").agg(F.bit_or("value").alias("value")).toPandas())
    out[rows["word"].to_numpy(np.int64)] = rows["value"].to_numpy(np.int64).view(U)
    return out.view(np.uint8)
