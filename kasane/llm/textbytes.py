"""Words of many texts at once: UTF-8 buffers of Arrow columns read by numpy.

All separators used here are ASCII, so a byte of 0x80 or more always belongs to a word and whole texts
can be cut without decoding them.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that one numpy step works on; a longer single text is one step.
STEP_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False

ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base & (2**64 - 1), dtype=np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, n + 1 offsets) of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    large = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


def give_back() -> None:
    """Return freed memory to the system: a Python worker outlives its tasks, and what it keeps is missing to the others of its executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def steps(batches: Iterator[pa.RecordBatch], column: str, step_bytes: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``step_bytes`` of the named text column."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(np.diff(utf8(batch.column(column))[1]))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + step_bytes, "right")))
            yield batch.slice(at, to - at)
            at = to
    give_back()


def spans(data: np.ndarray, offs: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of bytes in ``table``, cut at text borders, and the first run of each text (n + 1)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    w = table[data]
    st, en = w.copy(), w.copy()
    st[1:] &= ~w[:-1]
    en[:-1] &= ~w[1:]
    b = offs[:-1][offs[:-1] < len(data)]
    st[b] = w[b]
    e = offs[1:][offs[1:] > 0] - 1
    en[e] = w[e]
    s, e = np.flatnonzero(st), np.flatnonzero(en) + 1
    return s, e, np.searchsorted(s, offs)


def span_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each of the ordered, disjoint spans, with the length mixed in."""
    out = np.zeros(len(s), np.uint64)
    if not len(s):
        return out
    at = 0
    while at < len(s):  # in pieces, so that the tables of powers stay small
        to = max(at + 1, int(np.searchsorted(e, s[at] + STEP_BYTES, "right")))
        lo, hi = int(s[at]), int(e[to - 1])
        power = _powers(_BASE, hi - lo)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_BYTE[data[lo:hi]] * power, out=sums[1:])
        back = _powers(pow(_BASE, -1, 1 << 64), hi - lo)
        out[at:to] = (sums[e[at:to] - lo] - sums[s[at:to] - lo]) * back[s[at:to] - lo]
        at = to
    return mix(out ^ (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def grams(hashes: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Hashes of k consecutive items; the last k - 1 places have none."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, (salt * 2 + 1) * 0x2545F4914F6CDD1D & (2**64 - 1), np.uint64)
    for j in range(k):
        out = (out ^ hashes[j : j + n]) * np.uint64(0x9FB21C651E98DF25)
        out ^= out >> np.uint64(29)
    return mix(out)


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values[bounds[i]:bounds[i + 1]]."""
    sums = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def window_minima(gram: np.ndarray, width: int, ok: np.ndarray) -> np.ndarray:
    """Places that hold the rightmost minimum of some window of ``width`` grams; ok[i]: the window from i counts."""
    n = len(gram) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, at = gram[:n].copy(), np.arange(n)
    for j in range(1, width):
        less = gram[j : j + n] <= best
        best[less] = gram[j : j + n][less]
        at[less] = np.flatnonzero(less) + j
    return np.unique(at[ok[:n]])


def lines(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all lines, blank ones too, and the first line of each text (n + 1); an empty text has one line."""
    ends = np.flatnonzero(data == 0x0A)
    s = np.sort(np.concatenate([offs[:-1], ends + 1]), kind="stable")
    e = np.sort(np.concatenate([ends, offs[1:]]), kind="stable")
    return s, e, np.searchsorted(ends, offs) + np.arange(len(offs))


def line_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hashes of the lines; lines of blanks alone share one."""
    full = np.flatnonzero(e > s)
    out = np.full(len(s), 0x5851F42D4C957F2D, np.uint64)
    out[full] = span_hashes(data, s[full], e[full])
    return out


def line_words(data: np.ndarray, offs: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Number of words of each line."""
    ws, _, _ = spans(data, offs, NOT_BLANK)
    return np.searchsorted(ws, e) - np.searchsorted(ws, s)
