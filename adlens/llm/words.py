"""Vectorised word and shingle hashing of Arrow text columns.

Words are the maximal runs of bytes other than space and 0x09-0x0D, with A-Z
lower-cased; a shingle is ``WIDTH`` consecutive words, and a text of fewer
words is one shingle as a whole. Hashes have 64 bits: tabulation hashing of
each word's bytes by position, summed, then mixed. They depend on the text
alone, so every task, run and machine agrees on them.

Texts are handled whole, in slices of about ``SLICE`` bytes cut at white
space, so memory follows the slice and the number of words of one text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WIDTH = 5
SLICE = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (wrapping arithmetic)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _table() -> np.ndarray:
    """Random words for (byte position mod 64, byte); upper case as lower case."""
    t = mix(np.arange(1, 64 * 256 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(64, 256)
    t[:, 65:91] = t[:, 97:123]
    return t.reshape(-1)


_TABLE = _table()
_STEP = mix(np.arange(101, 101 + WIDTH, dtype=np.uint64)) | np.uint64(1)


def _slice_words(b: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and word starts of one slice; ``fresh`` are text starts in it."""
    solid = ~_SPACE[b]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    fresh = fresh[fresh < len(b)]
    first[fresh] = solid[fresh]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64), starts
    at = np.arange(len(b), dtype=np.int64)
    place = at[starts[0]:] - np.repeat(starts, np.diff(np.append(starts, len(b))))
    values = _TABLE[((place & 63) << 8) + b[starts[0]:]]
    far = place >= 64
    if far.any():
        values[far] *= (place[far] >> 6).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    values[~solid[starts[0]:]] = 0
    sums = np.add.reduceat(values, starts - starts[0])
    sizes = np.add.reduceat(solid[starts[0]:].astype(np.uint64), starts - starts[0])
    return mix(sums + sizes * np.uint64(0x9E3779B97F4A7C15)), starts


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.cast(pa.large_string()).fill_null("")
    if len(texts) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offs = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def _cuts(raw: np.ndarray, offs: np.ndarray) -> list[int]:
    """Ends of slices of about SLICE bytes, none of them inside a word."""
    out, at, end = [], 0, len(raw)
    while end - at > 2 * SLICE:
        edge = offs[np.searchsorted(offs, at + SLICE, "right") - 1]
        if edge <= at:
            edge, near = end, at + SLICE
            while near < end:
                gap = np.flatnonzero(_SPACE[raw[near:near + SLICE]])
                if len(gap):
                    edge = near + int(gap[0])
                    break
                near += SLICE
            later = offs[np.searchsorted(offs, at, "right"):]
            if len(later) and later[0] < edge:
                edge = later[0]
        out.append(int(edge))
        at = int(edge)
    return [*out, end]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All word hashes in order, and each text's bounds in them (length + 1)."""
    raw, offs = _buffers(texts)
    hashes, starts, at = [], [], 0
    for end in _cuts(raw, offs):
        fresh = offs[np.searchsorted(offs, at):np.searchsorted(offs, end)] - at
        h, s = _slice_words(raw[at:end], fresh)
        hashes.append(h)
        starts.append(s + at)
        at = end
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offs)


def shingles(texts: pa.Array, width: int = WIDTH) -> Iterator[np.ndarray]:
    """For each text (null as empty) its distinct shingle hashes, ascending."""
    words, bounds = word_hashes(texts)
    step = _STEP[:width]
    n = len(words) - width + 1
    runs = np.zeros(max(n, 0), np.uint64)
    for j in range(width if n > 0 else 0):
        runs += words[j:j + n] * step[j]
    runs = mix(runs)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= width:
            h = np.sort(runs[a:b - width + 1])
            yield h[np.append(True, h[1:] != h[:-1])]
        elif b > a:
            whole = (words[a:b] * step[:b - a]).sum(dtype=np.uint64) + np.uint64(int(b - a))
            yield mix(np.array([whole], np.uint64))
        else:
            yield np.empty(0, np.uint64)


def pieces_of(texts: pa.Array, limit: int = 2 * SLICE) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive runs of texts of about ``limit`` bytes: (first index, run)."""
    _, offs = _buffers(texts)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
        yield at, texts.slice(at, to - at)
        at = to
