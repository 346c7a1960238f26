"""Words of whole texts as 64-bit hashes, computed on the bytes of Arrow columns.

A word is a maximal run of bytes other than ``\\x20`` and ``\\x09-\\x0D`` (in UTF-8 these bytes never
lie inside another character). ``A-Z`` are lower-cased on request.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

CHUNK = 1 << 20  # bytes hashed at a time; a longer word gets a longer chunk
PLAIN = 32

_rng = np.random.Generator(np.random.PCG64(20240917))
_BYTE = _rng.integers(0, 1 << 64, 256, np.uint64, endpoint=False)
_STEP = np.uint64(int(_rng.integers(0, 1 << 63)) * 2 + 1)
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))
_IN_WORD = np.ones(256, bool)
_IN_WORD[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (fixed values: the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(step: np.uint64, n: int) -> np.ndarray:
    known = _powers.get(int(step))
    if known is None or len(known) < n:
        size = max(n, CHUNK + 1)
        known = np.full(size, step, np.uint64)
        known[0] = 1
        known = np.cumprod(known)
        if size == CHUNK + 1:
            _powers[int(step)] = known
    return known[:n]


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, and where each row starts (one more entry than rows); null is empty."""
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span. Up to ``PLAIN`` bytes a polynomial sum tells spans apart; sums modulo 2 ** 64 of longer
    ones can agree by the structure of the text alone, whatever the base, so these are hashed byte by byte."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power(_STEP, len(data)), out=sums[1:])
    value = (sums[end] - sums[start]) * _power(_BACK, len(data))[start]
    value = mix(value + (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    long = np.flatnonzero(end - start > PLAIN)
    if len(long):
        raw = memoryview(np.ascontiguousarray(data))
        value[long] = np.array(
            [xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(start[long].tolist(), end[long].tolist(), strict=True)], np.uint64)
    return value


def word_hashes(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(row of each word, hash of each word), in order."""
    data, rows = bytes_of(column)
    found_rows, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    lo = 0
    while lo < len(data):
        hi = _chunk_end(data, rows, lo)
        part = data[lo:hi]
        inside = _IN_WORD[part]
        bounds = rows[(rows > lo) & (rows < hi)] - lo
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        first[bounds] = inside[bounds]
        last[bounds - 1] = inside[bounds - 1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        if len(start):
            found.append(span_hashes(_LOWER[part] if lower else part, start, end))
            found_rows.append(np.searchsorted(rows, start + lo, "right") - 1)
        lo = hi
    return np.concatenate(found_rows), np.concatenate(found)


def _chunk_end(data: np.ndarray, rows: np.ndarray, lo: int) -> int:
    """A place about CHUNK bytes on that is not inside a word."""
    hi = lo + CHUNK
    if hi >= len(data):
        return len(data)
    k = np.searchsorted(rows, hi, "right") - 1
    if rows[k] > lo:
        return int(rows[k])  # the start of a row
    gaps = np.flatnonzero(~_IN_WORD[data[lo + 1 : hi]])
    if len(gaps):
        return lo + 1 + int(gaps[-1])
    until = int(rows[k + 1]) if k + 1 < len(rows) else len(data)
    for at in range(hi, until, CHUNK):
        gaps = np.flatnonzero(~_IN_WORD[data[at : min(at + CHUNK, until)]])
        if len(gaps):
            return at + int(gaps[0])
    return until


def windows(rows: np.ndarray, words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every window of ``size`` words; a row with fewer words has one window of them all."""
    factor = mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)
    n = len(words)
    out_rows, out = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    if n >= size:
        whole = rows[: n - size + 1] == rows[size - 1 :]
        value = np.zeros(n - size + 1, np.uint64)
        for j in range(size):
            value += words[j : n - size + 1 + j] * factor[j]
        out_rows.append(rows[: n - size + 1][whole])
        out.append(mix(value[whole]))
    present, first, count = np.unique(rows, return_index=True, return_counts=True)
    for k in range(1, size):
        at = first[count == k]
        if len(at):
            value = np.full(len(at), k, np.uint64)
            for j in range(k):
                value += words[at + j] * factor[j]
            out_rows.append(present[count == k])
            out.append(mix(value ^ np.uint64(k << 56)))
    return np.concatenate(out_rows), np.concatenate(out)


def per_row(rows: np.ndarray, values: np.ndarray, n: int) -> list[np.ndarray]:
    """The values of each of ``n`` rows."""
    order = np.argsort(rows, kind="stable")
    return np.split(values[order], np.searchsorted(rows[order], np.arange(1, n))) if n else []
