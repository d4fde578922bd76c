"""Word and shingle hashing over whole Arrow string columns.

A column's UTF-8 buffer is read in place. Words are runs of bytes outside
0x20 and 0x09-0x0D, compared after lower-casing A-Z. Hashes are 64-bit and the
same in every process, so that they can be joined across executors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
#: Bytes that one pass of the vector code works on; a longer document gets a pass of its own.
PASS_BYTES = 512 << 10


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over the output."""
    x = x.astype(U64)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


BYTE_CODE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
LOWER_CODE = BYTE_CODE[LOWER]
BASE = 0x5851F42D4C957F2D
BASE_INV = pow(BASE, -1, 1 << 64)
STEPS = mix(np.arange(1001, 1001 + 64, dtype=U64)) | U64(1)


class _OfProcess(dict):
    """Tables that each process makes for itself: pickled with a function, it arrives empty."""

    def __reduce__(self):
        return _OfProcess, ()


_powers = _OfProcess()


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i below n at least; grown on demand, kept by the process."""
    if len(_powers.get("up", ())) < n:
        size = max(n, PASS_BYTES + 1)
        for key, b in (("up", BASE), ("down", BASE_INV)):
            step = np.full(size, b, U64)
            step[0] = 1
            _powers[key] = np.multiply.accumulate(step)
    return _powers["up"], _powers["down"]


def utf8(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the n + 1 offsets of its rows; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not pa.types.is_string(col.type) and not pa.types.is_large_string(col.type):
        col = pc.cast(col, pa.large_string())
    if col.null_count:
        col = pc.fill_null(col, "")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, at, data = col.buffers()
    at = np.frombuffer(at, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def passes(at: np.ndarray, most: int = PASS_BYTES):
    """Row ranges (lo, hi) that cover all rows, each of at most `most` bytes or one row."""
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = int(np.searchsorted(at, at[lo] + most, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def word_hashes(data: np.ndarray, at: np.ndarray, blank: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words in row order, the n + 1 offsets of each row's words, and the words' byte bounds."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return np.zeros(0, U64), np.zeros(len(at), np.int64), none, none
    inside = ~blank[data]
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    starts = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate(([False], inside[:-1]))))
    ends = np.flatnonzero(inside & (edge[1:] | ~np.concatenate((inside[1:], [False])))) + 1
    up, down = powers(n + 1)
    total = np.zeros(n + 1, U64)
    np.cumsum(LOWER_CODE[data] * up[:n], out=total[1:])
    h = mix((total[ends] - total[starts]) * down[starts])
    return h, np.searchsorted(starts, at), starts, ends


def shingle_hashes(h: np.ndarray, word_at: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k-word runs in row order and the n + 1 offsets of each row's runs.

    A row of one to k - 1 words has one run, all its words; a row without words has none.
    """
    m = np.diff(word_at)
    count = np.where(m >= k, m - k + 1, (m > 0).astype(m.dtype))
    out_at = np.concatenate(([0], np.cumsum(count)))
    out = np.zeros(int(out_at[-1]), U64)
    full = np.flatnonzero(m >= k)
    if len(full):
        size = len(h) - k + 1
        run = np.zeros(size, U64)
        for j in range(k):
            run += h[j : j + size] * STEPS[j % 64]
        run = mix(run + U64(k))
        keep = np.zeros(len(h) + 1, np.int64)
        np.add.at(keep, word_at[full], 1)
        np.add.at(keep, word_at[full] + count[full], -1)
        out_full = np.zeros(len(out) + 1, np.int64)
        np.add.at(out_full, out_at[full], 1)
        np.add.at(out_full, out_at[full] + count[full], -1)
        out[np.cumsum(out_full)[:-1] > 0] = run[np.cumsum(keep)[:size] > 0]
    for i in np.flatnonzero((m > 0) & (m < k)):
        words = h[word_at[i] : word_at[i + 1]]
        out[out_at[i]] = mix(np.array([(words * STEPS[: len(words)]).sum(dtype=U64) + U64(len(words))]))[0]
    return out, out_at


def shingle_sets(col, k: int = 5):
    """For each row of a string column, its sorted distinct k-word shingle hashes."""
    data, at = utf8(col)
    for lo, hi in passes(at):
        part = at[lo : hi + 1]
        h, word_at, _, _ = word_hashes(data[part[0] : part[-1]], part - part[0])
        runs, run_at = shingle_hashes(h, word_at, k)
        for i in range(hi - lo):
            yield np.unique(runs[run_at[i] : run_at[i + 1]])
