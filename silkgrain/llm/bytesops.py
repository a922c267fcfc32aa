"""Vectorised work on UTF-8 bytes, for the operators that run in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACES = bytes([9, 10, 11, 12, 13, 32])
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Rolling hashes are sums of CODE[byte] * STEP ** position modulo 2 ** 64.
_STEP = 0x9E3779B97F4A7C15
_STEP_INVERSE = pow(_STEP, -1, 1 << 64)
CODE = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
CODE_2 = np.random.default_rng(12).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """STEP ** i and its inverse for i < n; kept for the next call."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_STEP, _STEP_INVERSE)):
            x = np.full(n, base, np.uint64)
            x[0] = 1
            _powers[k] = np.cumprod(x)
    return _powers[0][:n], _powers[1][:n]


def prefix_sums(data: np.ndarray, code: np.ndarray = CODE) -> np.ndarray:
    """Partial sums of the rolling hash, one more than there are bytes."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(code[data] * powers(len(data) + 1)[0][: len(data)], out=out[1:])
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    """The same hashes with their bits spread (splitmix64's last steps)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One hash for each slice [start, end) of the bytes that sums was made of."""
    return mixed((sums[end] - sums[start]) * powers(len(sums))[1][start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs without white space."""
    edge = np.diff(np.concatenate([[False], ~IS_SPACE[data], [False]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def texts(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each string of an Arrow column, straight from its buffers; null: empty."""
    if pa.types.is_large_string(column.type):
        width = np.int64
    elif pa.types.is_string(column.type):
        width = np.int32
    else:
        yield from (b"" if x is None else str(x).encode() for x in column.to_pylist())
        return
    if not len(column):
        return
    at = np.frombuffer(column.buffers()[1], width)[column.offset : column.offset + len(column) + 1]
    data = memoryview(column.buffers()[2] or b"")
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    for k in range(len(column)):
        yield bytes(data[at[k] : at[k + 1]]) if valid[k] else b""


def pieces(text: bytes, limit: int) -> Iterator[bytes]:
    """The text cut at white space into pieces of about limit bytes, so that no array grows
    with the longest text. A longer run without white space stays whole."""
    at = 0
    while len(text) - at > limit:
        cut = max(text.rfind(bytes([c]), at + 1, at + limit) for c in SPACES)
        if cut < 0:
            found = [x for x in (text.find(bytes([c]), at + limit) for c in SPACES) if x >= 0]
            if not found:
                break
            cut = min(found)
        yield text[at : cut + 1]
        at = cut + 1
    yield text[at:]
