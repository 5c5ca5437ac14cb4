"""Anchors: places in a text that equal windows choose alike, for exact search of repeated windows.

A text is a sequence of symbols (words or bytes), each with 64 random bits. A window of ``length`` symbols chooses,
among its ``gram``-symbol strings, the one with the least hash, leftmost first. Equal windows choose equal strings at
equal offsets, so a window that repeats lies around an anchor that repeats. Consecutive windows with the same anchor
form a run; the symbols that they span are its phrase.
"""

from __future__ import annotations

from functools import cache

import numpy as np

MULTIPLIER = 0x9E3779B97F4A7C15  # odd, hence invertible modulo 2**64
CHUNK = 1 << 20  # window starts handled at once
PLACE = np.uint64(CHUNK * 2 - 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits (the finaliser of SplitMix64, whose constants are fixed values)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier, and their inverses, up to 2**bits."""
    out = []
    for base in (MULTIPLIER, pow(MULTIPLIER, -1, 1 << 64)):
        p = np.full(1 << bits, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return tuple(out)


class Hashes:
    """Hashes of any stretch of a sequence, from one running sum."""

    def __init__(self, symbols: np.ndarray):
        self.up, self.down = _powers(max(10, len(symbols).bit_length()))
        self.sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(symbols * self.up[: len(symbols)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def all(self, length: int) -> np.ndarray:
        """Of every stretch of this length."""
        n = max(0, len(self.sums) - length)
        return mix((self.sums[length : length + n] - self.sums[:n]) * self.down[:n])


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return x if done == width else np.minimum(x[: len(x) - (width - done)], x[width - done :])


def runs(symbols: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """Runs of the texts that ``symbols`` holds one after the other, each up to its place in ``ends``.

    Returns (text, start in ``symbols``, windows, anchor's hash, anchor's place, phrase's hash). A run that meets
    the end of a chunk is cut there, which costs a comparison later but loses nothing.
    """
    parts, total = [], len(symbols)
    for low in range(0, max(total - length + 1, 0), CHUNK):
        high = min(low + CHUNK, total - length + 1)
        part = symbols[low : high + length - 1]
        hashes = Hashes(part)
        grams = hashes.all(gram)
        places = np.arange(len(grams), dtype=np.uint64)
        least = _least((mix(grams + np.uint64(1)) & ~PLACE) | places, length - gram + 1)
        at = (least & PLACE).astype(np.int64)
        text = np.searchsorted(ends, np.arange(low, high), "right")
        valid = np.arange(low, high) + length <= ends[text]
        new = valid & np.concatenate([[True], (at[1:] != at[:-1]) | ~valid[:-1] | (text[1:] != text[:-1])])
        last = valid & np.concatenate([new[1:] | ~valid[1:], [True]])
        start, end = np.nonzero(new)[0], np.nonzero(last)[0] + 1
        parts.append((text[start], start + low, end - start, grams[at[start]], at[start] + low, hashes.of(start, end + length - 1)))
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none, none.astype(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts))


def columns_of(lists):
    """Each row's list of structs, in an Arrow array, as numpy columns."""
    offsets, fields = lists.offsets.to_numpy(), [f.to_numpy() for f in lists.values.flatten()]
    return [[f[a:b] for f in fields] for a, b in zip(offsets[:-1], offsets[1:])]
