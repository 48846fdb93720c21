"""Vectorised word splitting and hashing inside tasks (numpy only).

``word_hashes`` splits one text into words (maximal runs of bytes that are
not separators) and gives a 64-bit hash per word. ``window_hashes`` combines
consecutive word hashes. Both are polynomials modulo 2**64 with odd bases,
evaluated through prefix sums, so no Python loop runs over words or bytes.
Texts are cut at separators into pieces of about a megabyte, which bounds the
working memory for very long texts.
"""

from __future__ import annotations

import numpy as np

# Odd multipliers of the two polynomials and their mixers.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xC2B2AE3D27D4EB4F
MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)

PIECE = 1 << 20
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


_POWERS: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and its inverse modulo 2**64 for i < n (kept per process,
    by the next power of two of the length)."""
    size = 1 << max(16, (n - 1).bit_length())
    if (base, size) not in _POWERS:
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        _POWERS[base, size] = (out[0], out[1])
    up, down = _POWERS[base, size]
    return up[:n], down[:n]


def spans(raw: np.ndarray, separators: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the words in an array of bytes."""
    word = np.zeros(len(raw) + 2, dtype=np.int8)
    word[1:-1] = ~separators[raw]
    edge = np.diff(word)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _piece_hashes(raw: np.ndarray, separators: np.ndarray) -> np.ndarray:
    start, end = spans(raw, separators)
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    up, down = powers(BYTE_BASE, len(raw))
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    # +1: a zero byte counts too.
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up, out=total[1:])
    return mix((total[end] - total[start]) * down[start])


def word_hashes(text: bytes, separators: np.ndarray = SPACES) -> np.ndarray:
    """One hash per word of ``text``, in order."""
    raw = np.frombuffer(text, dtype=np.uint8)
    if len(raw) <= 2 * PIECE:
        return _piece_hashes(raw, separators)
    parts, at = [], 0
    while at < len(raw):
        stop = min(len(raw), at + PIECE)
        while stop < len(raw) and not separators[raw[stop]]:
            gap = np.flatnonzero(separators[raw[stop : stop + PIECE]])
            stop = stop + int(gap[0]) if len(gap) else min(len(raw), stop + PIECE)
        parts.append(_piece_hashes(raw[at:stop], separators))
        at = stop
    return np.concatenate(parts)


def grouped(texts, size: int = PIECE):
    """Lists of consecutive texts (bytes) of about ``size`` bytes in all."""
    held: list[bytes] = []
    n = 0
    for text in texts:
        held.append(text)
        n += len(text)
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def word_hashes_of(texts: list[bytes], separators: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """The word hashes of several texts in a row, and each text's number of
    words; one evaluation for all of them unless they are long. A line feed
    must be a separator."""
    if sum(map(len, texts)) > 2 * PIECE:
        parts = [word_hashes(t, separators) for t in texts]
        return np.concatenate(parts), np.array([len(x) for x in parts])
    raw = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    start, _ = spans(raw, separators)
    return _piece_hashes(raw, separators), np.diff(np.searchsorted(start, ends), prepend=0)


def window_hashes(words: np.ndarray, starts: np.ndarray, width: int, base: int = WORD_BASE) -> np.ndarray:
    """Hash of the ``width`` words from each start (all starts must fit)."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    up, down = powers(base, len(words) + 1)
    total = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * up[:-1], out=total[1:])
    return mix((total[starts + width] - total[starts]) * down[starts])
