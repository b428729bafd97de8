"""Vectorised rolling hashes and window anchors over sequences of words or bytes.

A window of ``size`` elements chooses its anchor: among its first ``reach`` positions the
one whose ``order``-gram has the least hash, the leftmost of equals. The choice depends
on the window's own content alone, so equal windows choose equal anchors at the same
place, and every window that chooses position j contains the ``size - reach + 1``
elements from j on, which name the anchor. Neighbouring windows mostly share an anchor:
about 2 / (reach + 1) of the positions are one.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240607))
BYTE_VALUES = _rng.integers(0, 1 << 64, 256, dtype=U)
BASES = tuple(int(x) | 1 for x in _rng.integers(1 << 32, 1 << 62, 2))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a base and of its inverse, modulo 2**64."""
    if which not in _powers or len(_powers[which][0]) < n:
        m = max(n, 1 << 16)
        out = []
        for b in (BASES[which], pow(BASES[which], -1, 1 << 64)):
            p = np.ones(m, dtype=U)
            if m > 1:
                p[1:] = U(b)
                np.multiply.accumulate(p, out=p)
            out.append(p)
        _powers[which] = tuple(out)
    return tuple(p[:n] for p in _powers[which])


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the differences of equal-length hashes over all bits."""
    x = x ^ (x >> U(31))
    x = x * U(0x9E3779B97F4A7C15)
    return x ^ (x >> U(29))


class Rolling:
    """Hashes of any span of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray, which: int = 0):
        up, self.down = powers(which, len(values) + 1)
        self.sums = np.zeros(len(values) + 1, dtype=U)
        np.cumsum(values * up[:-1], out=self.sums[1:])

    def spans(self, start: np.ndarray, length) -> np.ndarray:
        return mix((self.sums[start + length] - self.sums[start]) * self.down[start])

    def all_of(self, length: int) -> np.ndarray:
        n = max(0, len(self.sums) - length)
        return mix((self.sums[length:] - self.sums[:n]) * self.down[:n])


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = np.minimum(x[:-step], x[step:])
        done += step
    return x


def anchors(roll: Rolling, n: int, size: int, reach: int, order: int, bound: int = 1 << 22):
    """(place, first, last) arrays: each anchor with the first and last window start that
    chooses it, over the n elements of one sequence."""
    if n < size:
        none = np.empty(0, dtype=np.int64)
        return none, none, none
    if n <= bound:
        return _anchors(roll, 0, n, size, reach, order)
    parts = [_anchors(roll, a, min(n, a + bound + size - 1), size, reach, order) for a in range(0, n - size + 1, bound)]
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _anchors(roll: Rolling, a: int, b: int, size: int, reach: int, order: int):
    starts = np.arange(a, b - order + 1)
    h = roll.spans(starts, order)
    # The low 24 bits hold the place, so the least value is the leftmost of equals.
    keyed = (h & U(0xFFFFFFFFFF000000)) | (starts - a).astype(U)
    chosen = (sliding_least(keyed, reach)[: b - a - size + 1] & U(0xFFFFFF)).astype(np.int64)
    cut = np.flatnonzero(np.diff(chosen)) + 1
    first = np.r_[0, cut]
    last = np.r_[cut, len(chosen)] - 1
    return chosen[first] + a, first + a, last + a


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
