"""Whole-batch tokenising and hashing with numpy over Arrow buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit values."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def odd(n: int, seed: int = 1) -> np.ndarray:
    """n fixed odd multipliers, made by a rule."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed)) | U64(1)


def table(separators: bytes) -> np.ndarray:
    """Which byte values belong to words: all but the separators."""
    out = np.ones(256, bool)
    out[np.frombuffer(separators, np.uint8)] = False
    return out


def lower_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    return out


#: Words are what white space leaves.
SPACES = bytes([0x20, *range(0x09, 0x0E)])


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column (null: empty) and the n + 1 offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return flat, at - at[0]


def slices(offsets: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one longer row."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the n + 1 places of the rows' first words."""
    inside = is_word[data]
    if not inside.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


#: An odd base and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[:1] = 1
    return np.cumprod(out)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: np.ndarray | None = None, piece: int = 1 << 18) -> np.ndarray:
    """A 64-bit hash of each byte span (spans ascend and don't overlap): differences of one running polynomial, ``piece`` bytes at a time."""
    out = np.zeros(len(starts), U64)
    if not len(starts):
        return out
    piece = min(piece, int(ends[-1] - starts[0]))
    up, down = powers(BASE, piece), powers(INVERSE, piece)

    def letters(a: int, b: int) -> np.ndarray:
        part = data[a:b]
        return (part if lower is None else lower[part]).astype(U64) + U64(1)

    a = 0
    while a < len(starts):
        first = int(starts[a])
        b = int(np.searchsorted(ends, first + piece, "right"))
        if b <= a:  # a span longer than a piece: its pieces' sums, each moved to its place
            total, last = 0, int(ends[a])
            for at in range(first, last, piece):
                part = letters(at, min(at + piece, last))
                total += int((part * up[: len(part)]).sum()) * pow(BASE, at - first, 1 << 64)
            out[a] = (total + last - first) & 0xFFFFFFFFFFFFFFFF
            a += 1
            continue
        size = int(ends[b - 1]) - first
        run = np.zeros(size + 1, U64)
        np.cumsum(letters(first, first + size) * up[:size], out=run[1:])
        s, e = starts[a:b] - first, ends[a:b] - first
        out[a:b] = (run[e] - run[s]) * down[s] + (e - s).astype(U64)
        a = b
    return mix(out)


def stretches(data: np.ndarray, is_word: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Byte ranges of about ``limit`` that cut no word in two (a longer word makes a longer range)."""
    a, n = 0, len(data)
    while a < n:
        b = min(n, a + limit)
        while b < n:
            gaps = np.flatnonzero(~is_word[data[max(a, b - limit) : b]])
            if len(gaps):
                b = max(a, b - limit) + int(gaps[-1]) + 1
                break
            b = min(n, b + limit)
        yield a, b
        a = b


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, lower: np.ndarray | None = None, limit: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words, and the n + 1 places of the rows' first words. Beyond the limit rows are read a stretch at a time, so that the work needs little more than the hashes."""
    if len(data) <= limit:
        starts, ends, first = spans(data, offsets, is_word)
        return hashes(data, starts, ends, lower), first
    got, first = [], [0]
    for a, b in zip(offsets[:-1], offsets[1:]):
        row, n = data[a:b], 0
        for c, d in stretches(row, is_word, limit):
            starts, ends, _ = spans(row[c:d], np.array([0, d - c]), is_word)
            got.append(hashes(row[c:d], starts, ends, lower))
            n += len(starts)
        first.append(first[-1] + n)
    return np.concatenate([np.zeros(0, U64), *got]), np.array(first)


def windows(words: np.ndarray, first: np.ndarray, width: int) -> list[np.ndarray]:
    """For each row the hashes of its windows of ``width`` words; a shorter row gives one for the whole row, an empty row none."""
    by = odd(width, seed=7)
    n = len(words) - width + 1
    rolled = np.zeros(max(0, n), U64)
    for k in range(width if n > 0 else 0):
        rolled += words[k : k + n] * by[k]
    rolled = mix(rolled)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= width:
            out.append(rolled[a : b - width + 1])
        elif b > a:
            out.append(mix((words[a:b] * by[: b - a]).sum(keepdims=True) + U64(b - a)))
        else:
            out.append(rolled[:0])
    return out
