"""Word and hash arrays over the raw UTF-8 buffers of Arrow text columns.

The operators that scan text work on whole Arrow batches: a batch's texts are
one byte buffer with row offsets, and words, word hashes and windows of words
are numpy arrays over it.  Rows are taken in runs of about ``RUN_BYTES`` so that
memory follows the longest single text, not the batch.

A null text has no bytes and so no words.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

RUN_BYTES = 1 << 19
SEGMENT = 1 << 18

_ALL = np.arange(256)
#: A-Z to a-z, every other byte as it is.
LOWER = np.where((_ALL >= 0x41) & (_ALL <= 0x5A), _ALL + 32, _ALL).astype(np.uint8)
#: Bytes of a word, after lower-casing: digits, a-z and everything beyond ASCII.
ALNUM = ((_ALL >= 0x30) & (_ALL <= 0x39)) | ((_ALL >= 0x61) & (_ALL <= 0x7A)) | (_ALL >= 0x80)
#: Bytes of a word that white space delimits.
SOLID = ~((_ALL == 0x20) | ((_ALL >= 0x09) & (_ALL <= 0x0D)))

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_PRIME), -1, 1 << 64))


class Cache(dict):
    """A dict of computed tables that travels to tasks empty."""

    def __reduce__(self):
        return Cache, ()


_powers: dict[str, np.ndarray] = Cache()


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit permutation that spreads every input bit (splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit multipliers."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) * _PRIME) | np.uint64(1)


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        have = np.full(max(n, SEGMENT + 1), base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if len(have) <= 4 * SEGMENT:
            _powers[name] = have
    return have[:n]


@dataclass
class Words:
    """Words of a run of rows; ``first[r]:first[r + 1]`` are the words of row r."""

    low: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def window(self, i: int, n: int) -> bytes:
        """The words from word i on, joined by single blanks."""
        low = self.low
        return b" ".join(low[s:e].tobytes() for s, e in zip(self.starts[i:i + n], self.ends[i:i + n]))


def words(buf: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> Words:
    low = LOWER[buf]
    inside = kind[low]
    n = len(low)
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    at = offsets[:-1][offsets[:-1] < offsets[1:]]
    opens[at] = inside[at]
    closes[offsets[1:][offsets[:-1] < offsets[1:]] - 1] |= inside[offsets[1:][offsets[:-1] < offsets[1:]] - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return Words(low, starts, ends, _word_hashes(low, starts, ends, n), np.searchsorted(starts, offsets))


def _word_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """A polynomial hash of each word's bytes, from prefix sums over segments cut between words."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        begin = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, begin + SEGMENT, "right")))
        stop = ends[j - 1]
        size = int(stop - begin)
        total = np.zeros(size + 1, np.uint64)
        np.cumsum((low[begin:stop].astype(np.uint64) + np.uint64(1)) * _power("up", _PRIME, size), out=total[1:])
        s, e = starts[i:j] - begin, ends[i:j] - begin
        out[i:j] = (total[e] - total[s]) * _power("down", _INVERSE, size)[s]
        i = j
    return mix(out)


def windows(w: Words, size: int, mult: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, hash) of every run of ``size`` words inside one row."""
    n = len(w.hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    total = w.hashes[:n] * mult[0]
    for k in range(1, size):
        total += w.hashes[k:n + k] * mult[k]
    last = np.repeat(w.first[1:], np.diff(w.first))[:n]  # the end of each word's row
    at = np.flatnonzero(np.arange(n) + size <= last)
    return at, mix(total[at] + np.uint64(size))


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string or binary column; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    if not len(col):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    o = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    b = np.frombuffer(data, np.uint8)[o[0]:o[-1]] if data is not None else np.empty(0, np.uint8)
    return b, o - o[0]


def runs(col: pa.Array, most: int = RUN_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive runs of rows, at least one row each."""
    buf, offs = buffers(col)
    row, n = 0, len(offs) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offs, offs[row] + most, "right")) - 1)
        end = min(end, row + 65536, n)
        yield row, end, buf[offs[row]:offs[end]], offs[row:end + 1] - offs[row]
        row = end


def give_back() -> None:
    """Freed memory goes back to the system; Python processes stay for later tasks and would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:  # glibc
        trim(0)


def worker_cache(name: str) -> dict:
    """A dict of this Python process, which later tasks of a reused worker find again."""
    home = sys.modules.setdefault("_metricstore_worker_cache", ModuleType("_metricstore_worker_cache"))
    return home.__dict__.setdefault(name, {})


def fresh(taken: list[str], name: str) -> str:
    """``name``, or it with underscores until no column has that name."""
    have = {c.lower() for c in taken}
    while name.lower() in have:
        name += "_"
    return name


def with_struct(df: DataFrame, name: str, fields: T.StructType,
                make: Callable[[], Callable[[pa.RecordBatch], pa.Array]]) -> DataFrame:
    """``df`` with one more struct column, computed batch by batch.

    ``make`` runs once per task and returns the function of a batch.  Every
    input column passes through, whatever its name.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(name, fields, True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, one(batch)], names=[*batch.schema.names, name])

    return df.mapInArrow(run, schema)
