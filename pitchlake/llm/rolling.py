"""Rolling hashes over arrays and sliding minima, shared by the suffix operators."""

from __future__ import annotations

import numpy as np

_MULT = 0x9E3779B97F4A7C15
_INV = pow(_MULT, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}
_MOST = np.iinfo(np.uint64).max
#: Bits of an anchor's key that hold its place; the others are the front of its hash.
_PLACE = np.uint64(32)
#: Random 64-bit value of each byte, drawn from a fixed seed.
BYTE = np.random.default_rng(20240229).integers(0, 1 << 64, 256, dtype=np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, 0 to n at least."""
    if "up" not in _POWERS or len(_POWERS["up"]) <= n:
        size = 1 << max(n + 1, 1 << 16).bit_length()
        for name, base in (("up", _MULT), ("down", _INV)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"], _POWERS["down"]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums from which the hash of any stretch of 64-bit values follows."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(len(values))[1][:len(values)], out=out[1:])
    return out


def stretch(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the stretches from ``start`` to ``end``."""
    return (prefix[end] - prefix[start]) * _powers(len(prefix))[0][start]


def window_min(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of ``width`` keys, from running minima of blocks in both directions."""
    n = len(keys)
    k = np.concatenate([keys, np.full(-n % width, _MOST, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(k, axis=1).ravel()
    back = np.minimum.accumulate(k[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def owners(h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The place of the smallest hash (the leftmost, if equal) in every window of ``width`` hashes, as runs:
    the place, and the first and last window that chose it. The choice depends on the window's hashes alone."""
    keys = (h >> _PLACE << _PLACE) | np.arange(len(h), dtype=np.uint64)
    place = (window_min(keys, width) & ((np.uint64(1) << _PLACE) - np.uint64(1))).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    return place[first], first, np.concatenate((first[1:], [len(place)])) - 1
