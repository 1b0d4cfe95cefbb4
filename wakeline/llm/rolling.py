"""Rolling hashes of byte windows, for all positions of a batch at once."""

import numpy as np

# One fixed odd multiplier for each hash family, and the finalising multipliers.
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    values = (values ^ (values >> np.uint64(30))) * _MIX[0]
    values = (values ^ (values >> np.uint64(27))) * _MIX[1]
    return values ^ (values >> np.uint64(31))


def byte_values(family: int = 0) -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASES[family]))


def window_hashes(values: np.ndarray, width: int, family: int = 0) -> np.ndarray:
    """Polynomial hash of each run of ``width`` values, by its first position.

    Windows double: a hash of 2m values is made of two hashes of m.
    """
    count = len(values) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    base = _BASES[family] | 1
    power, size = values.astype(np.uint64), 1
    total, covered, rest = None, 0, width
    while rest:
        if rest & 1:
            part = power[covered : covered + count]
            total = part.copy() if total is None else total * _factor(base, size) + part
            covered += size
        rest >>= 1
        if rest:
            power = power[:-size] * _factor(base, size) + power[size:]
            size *= 2
    return total


def _factor(base: int, size: int) -> np.uint64:
    return np.uint64(pow(base, size, 1 << 64))


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of each run of ``width`` values, by its first position."""
    count = len(values) - width + 1
    if count <= 0:
        return values[:0]
    size, low = 1, values
    while 2 * size <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    return np.minimum(low[:count], low[width - size : width - size + count])
