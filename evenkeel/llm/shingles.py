"""Sets of five-word shingles as sorted 64-bit hashes, computed without a loop over words."""

from __future__ import annotations

import numpy as np

WORDS = 5
# Any odd numbers do; these fix the hash.
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
PLACES = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA5A3564E27F8862F, 0xC2B2AE3D27D4EB4F], np.uint64)
SHORT = np.uint64(0x2545F4914F6CDD1D)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
AT_ONCE = 1 << 18  # bytes of texts at a time: the arrays of 64-bit numbers take some fifty times that

_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        for i, base in enumerate((BASE, BASE_INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps)
    return _POWERS


def _group(texts: list[bytes]) -> list[np.ndarray]:
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    inside = ~SPACE[data]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    first, last = edges[::2], edges[1::2]
    # Hash of a word: sum of byte * BASE ** place, freed of where the word stands.
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((LOWER[data].astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    words = mix((sums[last] - sums[first]) * down[first])
    bounds = np.searchsorted(first, np.concatenate([[0], np.cumsum(lengths)]))
    full = max(0, len(words) - WORDS + 1)
    shingles = np.zeros(full, np.uint64)
    for place in range(WORDS):
        shingles += words[place : place + full] * PLACES[place]
    shingles = mix(shingles)
    out = []
    for left, right in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        n = right - left
        if n >= WORDS:
            out.append(np.unique(shingles[left : right - WORDS + 1]))
        elif n:
            whole = (words[left:right] * PLACES[:n]).sum(dtype=np.uint64)
            out.append(mix(np.array([whole + np.uint64(n) * SHORT], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """One sorted array of distinct hashes for each text; empty without words or text."""
    out: list[np.ndarray] = []
    group, size = [], 0
    for text in texts:
        group.append((text or "").encode("utf-8", "surrogatepass"))
        size += len(group[-1]) + 1
        if size > AT_ONCE:
            out += _group(group)
            group, size = [], 0
    return out + (_group(group) if group else [])
