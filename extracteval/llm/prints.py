"""Fingerprints of a chunk's parts, sent packed to the ranges of their values and answered with bits.

A chunk is a bounded piece of the input that one row holds.  It sends its distinct 48-bit fingerprints as
one packed row for each range of values, and gets one bit back for each, so a shuffle moves six bytes a
fingerprint and no row for each.  Fingerprints only choose candidates: two values that
meet by chance add work and change no result.
"""

from __future__ import annotations

import numpy as np

LEFT_OUT = np.uint64(16)  # bits of a 64-bit hash that its fingerprint leaves out


def pack48(prints: np.ndarray) -> bytes:
    return prints.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack48(blob: bytes) -> np.ndarray:
    wide = np.zeros((len(blob) // 6, 8), dtype=np.uint8)
    wide[:, :6] = np.frombuffer(blob, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel().astype(np.uint64)


def range_bounds(ranges: int) -> np.ndarray:
    """First fingerprint of each range, and the end of the last."""
    return np.array([-(-(r << 48) // ranges) for r in range(ranges + 1)], dtype=np.uint64)


def counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and how often each occurs."""
    values = np.sort(values)
    first = starts(values)
    return values[first], np.diff(np.append(first, len(values)))


def starts(ranked: np.ndarray) -> np.ndarray:
    """Where a new value begins in a sorted array."""
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(ranked)), bool), ranked[1:] != ranked[:-1]]))


def flagged(prints: np.ndarray, at: np.ndarray, answers: list[tuple[int, bytes]]) -> np.ndarray:
    """Those of the sorted ``prints`` whose bit is set; ``at`` has the bounds of the ranges in them."""
    kept = [prints[:0]]
    for r, blob in answers:
        some = prints[at[r] : at[r + 1]]
        kept.append(some[np.unpackbits(np.frombuffer(blob, np.uint8), count=len(some)).astype(bool)])
    return np.sort(np.concatenate(kept))


class Polynomial:
    """Hashes modulo 2**64 of any part of a byte string, from one running sum over it."""

    def __init__(self, seed: int):
        rnd = np.random.default_rng(seed)
        self.table = rnd.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base, *odd = (int(x) * 2 + 1 for x in rnd.integers(1 << 40, 1 << 63, 3, dtype=np.uint64))
        self.join, self.last = (np.uint64(x) for x in odd)
        self.up = self.down = np.ones(1, np.uint64)

    def powers(self, n: int) -> None:
        if n >= len(self.up):
            self.up, self.down = (
                np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, x, np.uint64)]), dtype=np.uint64)
                for x in (self.base, pow(self.base, -1, 1 << 64))
            )

    def mix(self, h: np.ndarray) -> np.ndarray:
        h = (h ^ (h >> np.uint64(32))) * self.last
        return h ^ (h >> np.uint64(29))

    def sums(self, raw: np.ndarray) -> np.ndarray:
        self.powers(len(raw))
        total = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(self.table[raw] * self.up[: len(raw)], out=total[1:])
        return total

    def parts(self, total: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of each raw[begin:end], the same wherever the part stands."""
        return self.mix((total[end] - total[begin]) * self.down[begin])

    def windows(self, total: np.ndarray, size: int) -> np.ndarray:
        """Hash of every part of ``size`` bytes."""
        n = max(0, len(total) - size)
        return self.mix((total[size : size + n] - total[:n]) * self.down[:n])

    def longer(self, h: np.ndarray, word: np.ndarray) -> np.ndarray:
        return self.mix(h * self.join ^ word)
