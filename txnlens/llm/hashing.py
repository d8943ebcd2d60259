"""Prefix polynomial hashes of byte strings, and blobs of packed integers.

The hash of a substring is a difference of prefix sums of T[byte] * B**i
(modulo 2**64, B odd) times the inverse power of its start, so any number of
substrings is hashed by two look-ups each. T holds a mixed word per byte."""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15
OTHER_BASE = 0xC2B2AE3D27D4EB4F  # of a second, independent hash
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; wraps."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
OTHER_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(OTHER_BASE))


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        step = np.full(max(n, 1 << 16), base, np.uint64)
        step[0] = 1
        have = _POWERS[base] = np.cumprod(step)
    return have[:n]


def forget_long(most: int = 1 << 20) -> None:
    """Drop tables of powers that one long buffer needed."""
    for base in [b for b, p in _POWERS.items() if len(p) > most]:
        del _POWERS[base]


class Prefix:
    """Prefix hashes of one buffer of bytes."""

    def __init__(self, data: np.ndarray, table: np.ndarray = BYTE, base: int = BASE):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(table[data] * _powers(base, n), out=self.sums[1:])
        self.inverse = _powers(pow(base, -1, 1 << 64), n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of data[start:end], not yet mixed."""
        return (self.sums[end] - self.sums[start]) * self.inverse[start]


def planes(x: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of unsigned 64-bit integers, byte by byte of
    all integers, so that equal high bytes compress away."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8).T[:width].tobytes()


def from_planes(blob: bytes, width: int) -> np.ndarray:
    n = len(blob) // width
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(blob, np.uint8).reshape(width, n).T
    return out.view("<u8").ravel()
