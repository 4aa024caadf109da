"""Vectorised byte-level helpers shared by the text operators.

All functions work on an Arrow batch at once: the UTF-8 bytes of all texts
lie in one buffer, and numpy computes words and hashes without a Python loop
over words. Words are runs of bytes outside ASCII space and \\t..\\r; lower
case means A-Z only. Both hold byte by byte in UTF-8.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
#: Odd base of the polynomial hashes (modulo 2**64) and its inverse.
BASE = 0x9E3779B97F4A7C15
BASE_INV = pow(BASE, -1, 1 << 64)

_rng = np.random.default_rng(20240131)
BYTE_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64 (xor-shift-multiply)."""
    x = x ^ (x >> U(31))
    x = x * U(0x7FB5D329728EA185)
    x = x ^ (x >> U(27))
    x = x * U(0x81DADEF4BC2DD44D)
    return x ^ (x >> U(33))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.empty(max(n, 1), np.uint64)
    out[0] = 1
    k = 1
    while k < n:
        m = min(k, n - k)
        out[k:k + m] = out[:m] * U(pow(base, k, 1 << 64))
        k += m
    return out[:n]


def utf8_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string())
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64, len(col) + 1 + col.offset)[col.offset:]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the number of words before each text.

    A word never crosses two texts. Words of text i are [first[i], first[i+1]).
    """
    n = len(raw)
    edge = np.zeros(n + 1, bool)
    ink = np.zeros(n + 2, bool)
    ink[1:-1] = ~IS_SPACE[raw]
    edge[offsets] = True
    # a word starts at ink preceded by space or by a text boundary, and ends likewise
    start = np.flatnonzero(ink[1:-1] & (~ink[:-2] | edge[:-1]))
    end = np.flatnonzero(ink[1:-1] & (~ink[2:] | edge[1:])) + 1
    return start, end, np.searchsorted(start, offsets)


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of raw[start:end] for many sorted, disjoint spans.

    Chunks of the buffer keep the power tables small. Equal bytes give equal
    hashes whatever their place, task or executor.
    """
    out = np.empty(len(start), np.uint64)
    step = 1 << 16  # the working arrays stay in cache
    pw, inv = powers(BASE, step + 1), powers(BASE_INV, step + 1)
    lo = 0
    while lo < len(start):
        base = int(start[lo])
        hi = max(lo + 1, int(np.searchsorted(end, base + step, "right")))
        part = raw[base:int(end[hi - 1])]
        n = len(part)
        if n >= len(pw):
            pw, inv = powers(BASE, n + 1), powers(BASE_INV, n + 1)
        acc = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_CODE[part] * pw[:n], out=acc[1:])
        s, e = start[lo:hi] - base, end[lo:hi] - base
        out[lo:hi] = mix((acc[e] - acc[s]) * inv[s] + (e - s).astype(np.uint64) * U(0xD6E8FEB86659FD93))
        lo = hi
    return out


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the first word's index of every text (one more at the end)."""
    start, end, first = word_spans(raw, offsets)
    return span_hashes(raw, start, end), first


def shingle_hashes(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of word n-grams of each text, as (values, offsets).

    A text with fewer than ``width`` words has its whole sequence as its only
    shingle; a text without words has none.
    """
    n_texts = len(first) - 1
    count = np.diff(first)
    n = len(words)
    gram = np.zeros(n, np.uint64)
    mult = [U(pow(0xC2B2AE3D27D4EB4F, k + 1, 1 << 64)) for k in range(width)]
    if n >= width:
        m = n - width + 1
        for k in range(width):
            gram[:m] += words[k:k + m] * mult[k]
    text_of = np.repeat(np.arange(n_texts), count)
    keep = np.arange(n) + width <= first[1:][text_of] if n else np.zeros(0, bool)
    vals, owner = mix(gram[keep]), text_of[keep]
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        whole = np.array([mix(np.sum(words[first[i]:first[i + 1]] * np.array(mult[:count[i]]), keepdims=True)
                              + U(int(count[i])))[0] for i in short], np.uint64)
        vals, owner = np.concatenate([vals, whole]), np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        vals, owner = vals[order], owner[order]
    offsets = np.searchsorted(owner, np.arange(n_texts + 1))
    for a, b in zip(offsets[:-1], offsets[1:]):
        vals[a:b].sort()
    if len(vals):
        new = np.ones(len(vals), bool)
        new[1:] = (vals[1:] != vals[:-1]) | (owner[1:] != owner[:-1])
        vals = vals[new]
        offsets = np.concatenate([[0], np.cumsum(new)])[offsets]
    return vals, offsets


def binary_column(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Arrow binary column whose row i holds the bytes of values[offsets[i]:offsets[i+1]]."""
    data = np.ascontiguousarray(values)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1,
        [None, pa.py_buffer((offsets * data.itemsize).astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())
