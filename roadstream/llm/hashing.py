"""64-bit hashing of many numbers at once."""

from __future__ import annotations

import numpy as np

#: Powers that are kept; also the bytes of text that operators hash at once.
KEPT = 1 << 18

_base = np.uint64(0x9E3779B97F4A7C15)
_back = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse."""
    if len(_powers.get("base", ())) < n:
        size = max(n, KEPT + 1)
        made = {}
        for name, x in (("base", _base), ("back", _back)):
            row = np.full(size, x, np.uint64)
            row[0] = 1
            made[name] = np.cumprod(row)
        if size > 16 * KEPT:  # not worth keeping
            return made["base"], made["back"]
        _powers.update(made)
    return _powers["base"], _powers["back"]
