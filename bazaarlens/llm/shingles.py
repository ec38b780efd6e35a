"""Word shingles of a text as 64-bit hashes, computed on its bytes at once."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.Generator(np.random.Philox(7)).integers(1, 1 << 63, 256, dtype=np.uint64)


class Powers:
    """Powers of the base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int):
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, factor in (("up", _BASE), ("down", _INVERSE)):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))
        return self.up, self.down


POWERS = Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def prefix_hashes(data: np.ndarray, table: np.ndarray = _BYTE) -> np.ndarray:
    """Sums from which ``span_hashes`` takes the hash of any span."""
    up, _ = POWERS.get(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * up[: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = POWERS.get(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_shingles(text: str | None, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` lower-cased words; a shorter text is one shingle, a blank one has none."""
    data = np.frombuffer(" ".join((text or "").lower().split()).encode("utf-8", "surrogatepass"), np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64)
    blanks = np.flatnonzero(data == 32)
    starts = np.concatenate([[0], blanks + 1])
    ends = np.concatenate([blanks, [len(data)]])
    n = min(size, len(starts))
    return span_hashes(prefix_hashes(data), starts[: len(starts) - n + 1], ends[n - 1:])
