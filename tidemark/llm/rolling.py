"""Rolling hashes over byte arrays, vectorised: every step is a few passes over whole arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Pseudo-random words for the 256 bytes, from a fixed generator.
TABLE64 = np.random.Generator(np.random.PCG64(20240229)).integers(0, 1 << 64, 256, np.uint64)
TABLE32 = (TABLE64 >> np.uint64(32)).astype(np.uint32)

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S = np.uint64(33)


def slabs(texts: list[bytes], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about ``limit`` bytes, one text at least: bounds the arrays of a step."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield first, i
            first, size = i, 0
        size += len(t)
    if first < len(texts):
        yield first, len(texts)


def mixed(h: np.ndarray) -> np.ndarray:
    """Finalizer: every output bit depends on every input bit."""
    h = h ^ (h >> _S)
    h = h * _M1
    h ^= h >> _S
    h = h * _M2
    h ^= h >> _S
    return h


def gear(data: np.ndarray) -> np.ndarray:
    """At each byte, a hash of the 32 bytes that end there (fewer at the start)."""
    h = TABLE32[data]
    step = 1
    while step < 32:
        h[step:] += h[:-step].copy() << np.uint32(step)
        step *= 2
    return h


def windows(values: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each run of ``width`` values, by doubling; one per start."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    have, result, done, base = values.astype(np.uint64), None, 0, 0x9E3779B97F4A7C15
    size = 1
    while size <= width:
        power = np.uint64(base)
        if width & size:
            if result is None:
                result, done = have[:n].copy(), size
            else:
                # append ``size`` more values behind those already in the hash
                result = result * power + have[done:done + n]
                done += size
        if size * 2 <= width:
            have = have[:-size] * power + have[size:]
            base = base * base % (1 << 64)
        size *= 2
    return mixed(result)


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of two hashes in their order. Addition, exclusive or and the finalizer between two levels leave no linear
    combination of values that could cancel out."""
    return mixed(left * _M1 ^ (right + _M2))


def joined_windows(values: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each run of ``width`` hashes, by doubling, as a tree of ``joined``; one per start."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    have, result, done, size = values.astype(np.uint64), None, 0, 1
    while size <= width:
        if width & size:
            result = joined(result, have[done:done + n]) if done else have[:n].copy()
            done += size
        if size * 2 <= width:
            have = joined(have[:-size], have[size:])
        size *= 2
    return mixed(result + _M2)


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest value in each run of ``width``; the first of equal ones."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best = np.arange(len(values))
    low = values
    size = 1
    while size * 2 <= width:
        right = low[size:] < low[:-size]
        best = np.where(right, best[size:], best[:-size])
        low = np.where(right, low[size:], low[:-size])
        size *= 2
    shift = width - size
    if shift:
        right = low[shift:shift + n] < low[:n]
        return np.where(right, best[shift:shift + n], best[:n])
    return best[:n]
