"""Words, hashes and shingles of a batch of texts, computed on Arrow buffers.

A batch's texts stay one UTF-8 byte array; word bounds and 64-bit word hashes
come from a few numpy passes over it, so no Python string is made per word.
Words are runs of bytes other than space and 0x09-0x0D; A-Z are lower-cased.
All of these bytes are ASCII, so words are the same on bytes as on characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
_P = U(0x9E3779B97F4A7C15 | 1)
_P_INV = U(pow(int(_P), -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}
# Texts of one Arrow batch are worked on in slices of about this many bytes.
SLICE_BYTES = 4 << 20


def _power_table(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64, at least ``n`` long."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        have = np.full(size, base, dtype=U)
        have[0] = U(1)
        have = np.cumprod(have, dtype=U)
        _powers.clear() if len(_powers) > 2 else None
        _powers[int(base)] = have
    return have


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the output."""
    with np.errstate(over="ignore"):
        x = x + U((0x9E3779B97F4A7C15 * (2 * salt + 1)) & 0xFFFFFFFFFFFFFFFF)
        x ^= x >> U(30)
        x *= U(0xBF58476D1CE4E5B9)
        x ^= x >> U(27)
        x *= U(0x94D049BB133111EB)
        x ^= x >> U(31)
        return x


def sorted_distinct(x: np.ndarray) -> np.ndarray:
    """The different values of ``x``, sorted.  By sorting: ``np.unique`` of values alone goes through a
    hash table of a node a value, which takes many times the time and memory where most differ."""
    x = np.sort(x)
    return x[np.concatenate((np.ones(min(len(x), 1), bool), x[1:] != x[:-1]))]


@dataclass
class Words:
    """Words of several texts: ``hashes[offsets[i]:offsets[i + 1]]`` are the
    word hashes of text ``i``; ``starts`` and ``ends`` are byte positions in
    ``data``, the texts' bytes (lower-cased)."""

    hashes: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray

    def texts(self) -> int:
        return len(self.offsets) - 1


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets (``n + 1``) of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if len(offsets) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch cut into runs of whole rows of about ``size`` text bytes, so
    temporaries stay bounded (a single longer text is a slice of its own)."""
    if batch.num_rows == 0:
        return
    _, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte run ``data[start:end]``."""
    if len(starts) == 0:
        return np.zeros(0, U)
    n = len(data)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, dtype=U)
        np.cumsum((data.astype(U) + U(1)) * _power_table(_P, n + 1)[:n], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * _power_table(_P_INV, n + 1)[starts])


def lower_ascii(data: np.ndarray) -> np.ndarray:
    upper = (data >= 65) & (data <= 90)
    return np.where(upper, data + np.uint8(32), data)


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def runs(keep: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of maximal runs of kept bytes that don't cross text bounds."""
    cut = np.zeros(len(keep) + 1, dtype=bool)
    cut[offsets] = True
    cut[0] = cut[-1] = True
    gap = np.concatenate(([True], ~keep, [True]))
    starts = np.flatnonzero(keep & (gap[:-2] | cut[:-1]))
    ends = np.flatnonzero(keep & (gap[2:] | cut[1:])) + 1
    return starts, ends


def words_of(column: pa.Array) -> Words:
    """Lower-cased words of every text of a string column."""
    data, offsets = text_bytes(column)
    data = lower_ascii(data)
    if len(data) == 0:
        empty = np.zeros(0, np.int64)
        return Words(np.zeros(0, U), np.zeros(len(offsets), np.int64), empty, empty, data)
    starts, ends = runs(~is_space(data), offsets)
    return Words(run_hashes(data, starts, ends), np.searchsorted(starts, offsets), starts, ends, data)


def combine(parts: list[np.ndarray], salt: int = 0) -> np.ndarray:
    """One hash of several hashes, in order (element-wise)."""
    with np.errstate(over="ignore"):
        out = mix(parts[0], salt)
        for p in parts[1:]:
            out *= U(0xD6E8FEB86659FD93)
            out += p
            out = mix(out, salt)
        return out


def shingles(words: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Hashes of the windows of ``k`` consecutive words (windows that cross
    texts included: cut by the caller's offsets)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    return combine([words[i:i + n] for i in range(k)], salt + k)


def text_shingles(words: np.ndarray, k: int, whole_if_short: bool = True) -> np.ndarray:
    """Distinct ``k``-word shingle hashes of one text's words, sorted.  With
    fewer words the whole sequence is one shingle (or there is none)."""
    if len(words) >= k:
        return sorted_distinct(shingles(words, k))
    if len(words) and whole_if_short:
        return shingles(words, len(words), salt=1000)
    return np.zeros(0, U)
