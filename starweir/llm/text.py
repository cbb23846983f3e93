"""Words and hashes of whole batches of text, as numpy arrays.

Words are runs of anything but ASCII white space. A batch is handled as one array of
bytes, so that no Python object is made for a word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa

#: Odd multipliers of the polynomial hashes, modulo 2**64.
BYTE_BASE = np.uint64(0x9E3779B97F4A7C15)
CHECK_BASE = np.uint64(0xC2B2AE3D27D4EB4F)
WORD_BASES = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))

#: Pieces up to this length are hashed by polynomials.
LONG_BYTES = 256

#: Bytes handled at once; a longer text is handled alone.
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all their bits, one to one."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


_POWERS: dict[int, np.ndarray] = {}


def _table(base: np.uint64, n: int) -> np.ndarray:
    known = _POWERS.get(int(base))
    if known is None or len(known) < n:
        known = powers(base, max(n, CHUNK_BYTES + 64))
        if n <= 8 * CHUNK_BYTES:
            _POWERS[int(base)] = known
    return known[:n]


def byte_values(data: np.ndarray) -> np.ndarray:
    """A number for each byte, spread over 64 bits."""
    return _BYTE_VALUE[data]


def prefix_hashes(data: np.ndarray, base: np.uint64 = BYTE_BASE) -> np.ndarray:
    """n + 1 sums; two of them give the hash of any piece of ``data``."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * _table(base, len(data)), out=sums[1:])
    return sums


def piece_hashes(
    sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64 = BYTE_BASE
) -> np.ndarray:
    """Hashes of data[starts:ends], equal for equal bytes wherever they stand. For pieces of
    up to ``LONG_BYTES`` only: see :func:`string_hashes`."""
    back = _table(inverse(base), len(sums))
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def string_hashes(
    data: np.ndarray, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64 = BYTE_BASE
) -> np.ndarray:
    """Hashes of data[starts:ends] of any length, by the sums of the same ``base``.

    Modulo 2**64, any polynomial takes certain unlike strings of a thousand letters or more
    for equal. Long pieces have a cryptographic hash instead; there are few of them.
    """
    out = piece_hashes(sums, starts, ends, base)
    key = int(base).to_bytes(8, "little")
    for i in np.flatnonzero(ends - starts > LONG_BYTES).tolist():
        digest = blake2b(data[starts[i] : ends[i]], digest_size=8, key=key).digest()
        out[i] = int.from_bytes(digest, "little")
    return out


def window_hashes(items: np.ndarray, length: int, base: np.uint64) -> np.ndarray:
    """Rabin-Karp hash of every ``length`` consecutive items, modulo 2**64.

    Built by joining windows whose lengths are powers of two.
    """
    if length > len(items):
        return np.zeros(0, np.uint64)
    done, total, size, part = 0, None, 1, items
    while True:
        if length & size:
            n = len(items) - done - size + 1
            shifted = part[done : done + n]
            total = shifted.copy() if total is None else total[:n] * _power(base, size) + shifted
            done += size
        if done == length:
            return total[: len(items) - length + 1]
        n = len(part) - size
        part = part[:n] * _power(base, size) + part[size : size + n]
        size *= 2


def _power(base: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(base), n, 1 << 64))


def window_minima(items: np.ndarray, length: int) -> np.ndarray:
    """Where the least of every ``length`` consecutive items is, the first one if several."""
    if length > len(items):
        return np.zeros(0, np.int64)

    def lesser(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.where(items[right] < items[left], right, left)

    size, part = 1, np.arange(len(items))
    while 2 * size <= length:
        part = lesser(part[:-size], part[size:])
        size *= 2
    n = len(items) - length + 1
    return lesser(part[:n], part[length - size : length - size + n])


@dataclass
class Words:
    """The words of some texts: ``starts`` and ``ends`` in ``data``, and for each text
    its first word in ``first`` (with the number of all words at the end)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        return string_hashes(self.data, prefix_hashes(self.data), self.starts, self.ends)


def words_of(data: np.ndarray, bounds: np.ndarray) -> Words:
    """Words of the texts data[bounds[i]:bounds[i + 1]]."""
    # A word begins at a byte that is no space and follows a space or the text's start.
    inside = ~_SPACE[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    before[bounds[:-1]] = False
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    after[bounds[1:]] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return Words(data, starts, ends, np.searchsorted(starts, bounds))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column, NULL as empty, and the bounds of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    bounds = bounds.astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), bounds - bounds[0]
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def chunks(bounds: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``size`` bytes, one row at least."""
    at, n = 0, len(bounds) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + size, "right")) - 1)
        yield at, end
        at = end


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start and length, joined."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int64)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)


def batches(tables: Iterable[pa.RecordBatch], size: int = 8 * CHUNK_BYTES, text: str = "text"):
    """Record batches cut so that their texts have about ``size`` bytes."""
    for batch in tables:
        _, bounds = utf8(batch.column(text))
        for at, end in chunks(bounds, size):
            yield batch.slice(at, end - at)
