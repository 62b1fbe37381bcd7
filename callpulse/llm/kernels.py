"""Vectorised text kernels over Arrow batches, shared by the operators of this subpackage.

All functions work on whole UTF-8 texts laid end to end, in pieces of about
``PIECE`` bytes (a longer text is one piece), so the memory of a task follows
the longest text and not the number of rows of a batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 18

U64 = np.uint64
_rng = np.random.default_rng(20240229)
#: random 64-bit value of each byte, and of each byte with A-Z folded to a-z
BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
FOLDED = BYTE.copy()
FOLDED[65:91] = BYTE[97:123]
#: the separators of words: space and the bytes 0x09 to 0x0D
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: words of more bytes than this get a hash without algebraic structure
LONG_WORD = 32
BASE = 0x9E3779B97F4A7C15 | 1
BASE2 = 0xC2B2AE3D27D4EB4F | 1


@lru_cache(maxsize=8)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, U64)
    out[0] = 1
    return np.cumprod(out, dtype=U64)


def powers(base: int, n: int) -> np.ndarray:
    """base**i modulo 2**64 for i below n; sizes are rounded up so few arrays are kept."""
    return _powers(base, 1 << max(19, (n - 1).bit_length()))[:n]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser with good avalanche, in place on a fresh array."""
    h = h ^ (h >> U64(30))
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows end to end (null: empty) and the n + 1 offsets between rows."""
    if pa.types.is_string(col.type):
        col = col.cast(pa.large_string())
    if pa.types.is_large_string(col.type):
        col = pc.fill_null(col, "").cast(pa.large_binary())
    else:
        col = pc.fill_null(col.cast(pa.large_binary()), b"")
    if len(col) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    buf = col.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.empty(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def pieces(off: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) of about ``limit`` bytes each; every row is in exactly one."""
    a, n = 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
        b = min(b, n)
        yield a, b
        a = b


def words(data: np.ndarray, off: np.ndarray, separator: np.ndarray = SEPARATOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every maximal run of non-separator bytes."""
    n = len(data)
    if n == 0:
        e = np.empty(0, np.int64)
        return e, e, e
    sep = separator[data]
    first = np.empty(n, bool)
    first[0] = True
    first[1:] = sep[:-1]
    edge = off[1:-1]
    first[edge[edge < n]] = True
    last = np.empty(n, bool)
    last[-1] = True
    last[:-1] = sep[1:]
    last[edge[edge > 0] - 1] = True
    np.logical_not(sep, out=sep)
    starts = np.flatnonzero(first & sep)
    ends = np.flatnonzero(last & sep) + 1
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASE) -> np.ndarray:
    """Mixed polynomial hash of values[start:end] for each span, through one prefix sum."""
    n = len(values)
    p = powers(base, n + 1)
    pre = np.empty(n + 1, U64)
    pre[0] = 0
    np.cumsum(values * p[:n], out=pre[1:])
    return mix((pre[ends] - pre[starts]) * powers(inverse(base), n + 1)[starts])


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False, base: int = BASE) -> np.ndarray:
    """64-bit hash of each word; another ``base`` gives an independent one.

    A polynomial modulo 2**64 is weak on long structured words (two Thue-Morse words of 2,048 letters
    collide under every odd base), so words over ``LONG_WORD`` bytes are hashed by BLAKE2b.
    """
    h = span_hash((FOLDED if fold else BYTE)[data], starts, ends, base)
    h = mix(h + (ends - starts).astype(U64) * U64(BASE2))
    long = np.flatnonzero(ends - starts > LONG_WORD)
    key = base.to_bytes(8, "little")
    for i, a, b in zip(long.tolist(), starts[long].tolist(), ends[long].tolist()):
        word = LOWER[data[a:b]] if fold else data[a:b]
        h[i] = int.from_bytes(hashlib.blake2b(word.tobytes(), digest_size=8, key=key).digest(), "little")
    return h


def digests(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit BLAKE2b digest of values[start:end] for each span, as two 64-bit numbers."""
    out = np.empty((len(starts), 2), U64)
    for i, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
        out[i] = np.frombuffer(hashlib.blake2b(values[a:b].tobytes(), digest_size=16).digest(), "<u8")
    return out[:, 0].copy(), out[:, 1].copy()


def run_hash(values: np.ndarray, size: int, base: int = BASE2) -> np.ndarray:
    """Hash of every ``size`` consecutive values; the result has len - size + 1 entries."""
    n = len(values)
    if n < size:
        return np.empty(0, U64)
    pre = np.empty(n + 1, U64)
    pre[0] = 0
    np.cumsum(values * powers(base, n), out=pre[1:])
    return mix((pre[size:] - pre[:-size]) * powers(inverse(base), n)[: n - size + 1])


def covered(marks: np.ndarray, size: int, n: int) -> np.ndarray:
    """Boolean mask of n places covered by runs of ``size`` that start at ``marks``."""
    d = np.bincount(marks, minlength=n + 1) - np.bincount(np.minimum(marks + size, n), minlength=n + 1)
    return np.cumsum(d[:n]) > 0


def segments(lengths: np.ndarray) -> np.ndarray:
    """0, 1, .. within each of consecutive groups of the given lengths."""
    total = int(lengths.sum())
    out = np.arange(total)
    return out - np.repeat(np.cumsum(lengths) - lengths, lengths)
