"""Seeded draws that depend only on (seed, purpose, key).

A draw never depends on partitioning, row order or retries, so a lost executor recomputes the same value
and any SQL engine with md5 can check it. ``draw_hash`` is uniform on 0 .. 2**32-1.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SPACE = 1 << 32
_MASK = HASH_SPACE - 1
# Odd constants of a multiplicative 32-bit mixer; products stay below 2**63.
_STEP = 2654435761
_MIX = 0x45D9F3B


def _col(value) -> Column:
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(value)


def draw_hash(seed: int, purpose: str, *keys) -> Column:
    """32-bit hash of the keys (columns or column names), as bigint."""
    key = F.concat_ws("|", *[_col(k).cast("string") for k in keys])
    digest = F.md5(F.concat(F.lit(f"{seed}:{purpose}:"), key))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def draw_uniform(seed: int, purpose: str, *keys) -> Column:
    """Uniform double in [0, 1)."""
    return draw_hash(seed, purpose, *keys) / F.lit(float(HASH_SPACE))


def scale_hash(h: Column, low, high) -> Column:
    """Map a 32-bit hash to an integer in low..high, both ends included."""
    low, high = _col(low).cast("bigint"), _col(high).cast("bigint")
    return low + F.shiftright(h * (high - low + F.lit(1)), 32)


def draw_int(low, high, seed: int, purpose: str, *keys) -> Column:
    """Uniform integer in low..high, both ends included."""
    return scale_hash(draw_hash(seed, purpose, *keys), low, high)


def draw_choice(options: Sequence[str], seed: int, purpose: str, *keys) -> Column:
    """One of a short list of literals, uniformly."""
    index = draw_int(1, len(options), seed, purpose, *keys).cast("int")
    return F.element_at(F.array(*[F.lit(o) for o in options]), index)


def stream_draw(h: np.ndarray, i: np.ndarray) -> np.ndarray:
    """32-bit draw number ``i`` of the stream that starts at ``h``, for arrays of int64."""
    x = (h + i * _STEP) & _MASK
    return ((x ^ (x >> 16)) * _MIX) & _MASK
