"""Hashes of the words of many texts at once."""

from __future__ import annotations

import numpy as np

PART = 1 << 19  # bytes of text hashed at a time

MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_BASE = 0xD6E8FEB86659FD93  # odd, so that it has an inverse


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX[1]
    x = (x ^ (x >> np.uint64(27))) * MIX[2]
    return x ^ (x >> np.uint64(31))


def _byte_values() -> np.ndarray:
    """A 64-bit number per byte: capitals have that of their small letter, blanks have none."""
    values = mixed(np.arange(1, 257, dtype=np.uint64) * MIX[0])
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    values[_BLANKS] = 0
    return values


_BLANKS = np.array([0x20, *range(0x09, 0x0E)])
_VALUES = _byte_values()
NOT_BLANK = np.ones(256, np.uint8)
NOT_BLANK[_BLANKS] = 0
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, PART + 1)
        _POWERS[:] = [
            np.multiply.accumulate(np.r_[np.uint64(1), np.full(size - 1, x, np.uint64)])
            for x in (_BASE, pow(_BASE, -1, 2**64))
        ]
    return _POWERS


def hashed(text: bytes, kinds: np.ndarray = NOT_BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of each word: a polynomial of its bytes, read off their running sum.

    A word is a run of bytes of one kind; bytes of kind 0 stand between words.
    """
    points = np.frombuffer(text, np.uint8)
    up, down = _powers(len(points) + 1)
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(_VALUES[points] * up[: len(points)], out=sums[1:])
    kind = np.zeros(len(points) + 2, np.uint8)
    kind[1:-1] = kinds[points]
    edge = kind[1:] != kind[:-1]
    starts, stops = np.flatnonzero(edge & (kind[1:] > 0)), np.flatnonzero(edge & (kind[:-1] > 0))
    value = (sums[stops] - sums[starts]) * down[starts]
    return mixed(value + (stops - starts).astype(np.uint64) * MIX[0]), starts, stops


def word_hashes(texts: list[bytes | None]) -> list[np.ndarray]:
    """Per text the hashes of its words: A-Z lower-cased, cut at ASCII blanks."""
    out: list[np.ndarray] = []
    group: list[bytes] = []

    def flush() -> None:
        ends = np.cumsum([len(t) + 1 for t in group])
        value, starts, _ = hashed(b" ".join(group))
        cuts = np.searchsorted(starts, ends[:-1])
        out.extend(np.split(value, cuts))
        group.clear()

    size = 0
    for text in texts:
        text = text or b""
        if size + len(text) > PART and group:
            flush()
            size = 0
        if len(text) > 4 * PART:  # hashed in parts that end between words
            parts, rest = [], text
            while rest:
                cut = rest.find(b" ", 4 * PART)
                parts.append(hashed(rest[:cut] if cut >= 0 else rest)[0])
                rest = rest[cut:] if cut >= 0 else b""
            out.append(np.concatenate(parts))
            continue
        group.append(text)
        size += len(text) + 1
    if group:
        flush()
    return out
