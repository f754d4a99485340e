"""Texts as arrays of code points, and rolling hashes over them."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts one after the other, and where each text starts, with the end at last."""
    whole = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return whole, np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(64)
def _powers(base: int, size: int) -> np.ndarray:
    """Powers of ``base`` modulo 2 ** 64, by doubling."""
    out = np.ones(size, dtype=np.uint64)
    done, factor = 1, base
    while done < size:
        n = min(done, size - done)
        out[done : done + n] = out[:n] * np.uint64(factor)
        factor = factor * factor & 0xFFFFFFFFFFFFFFFF
        done += n
    return out


def rolling(values: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """64-bit hash of every run of ``width`` values; shorter input gives an empty array."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    size = 1 << max(16, len(values).bit_length())
    spread = mix(values.astype(np.uint64) + np.uint64(seed * 0x632BE59BD9B4E019 + 1 & 0xFFFFFFFFFFFFFFFF))
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(spread * _powers(_INVERSE, size)[: len(values)], out=total[1:])
    return mix((total[width:] - total[:n]) * _powers(_BASE, size)[:n])


def run_hashes(values: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit hash of each run of values from ``first`` to before ``stop``, wherever it stands."""
    size = 1 << max(16, len(values).bit_length())
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(mix(values) * _powers(_INVERSE, size)[: len(values)], out=total[1:])
    return mix((total[stop] - total[first]) * _powers(_BASE, size)[first] + (stop - first).astype(np.uint64))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` neighbours, by doubling."""
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[:-step], out[step:])
        done += step
    return out


def pieces(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours whose sizes sum to ``most`` at the most, or of one if it is larger."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)
