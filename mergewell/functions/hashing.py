"""Hash-based identities and random orders, the same on every run and cluster."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, functions as F


def feature_hash(dataset: Column, feature: Column) -> Column:
    """Identity of a feature: equal names in different datasets stay apart."""
    return F.md5(F.concat_ws("_", dataset, feature))


def seeded_hash(*parts: Column) -> Column:
    """Hex md5 of the parts joined by ':'; ordering by it is a reproducible shuffle."""
    return F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))


def hash_fraction(digest: Column) -> Column:
    """Number in [0, 1) that grows with the hex digest's sort order."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(16**8))


_A, _B, _C, _D = (np.uint64(x) for x in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))


def hashed_ints(before: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Spark's xxhash64(..., value) of ints, given xxhash64 of the columns ahead of it."""
    def turned(x, bits):
        return x ^ (x >> np.uint64(bits))

    x = (before.view(np.uint64) + _D + np.uint64(4)) ^ (values.astype(np.uint64) & np.uint64(0xFFFFFFFF)) * _A
    x = (x << np.uint64(23) | x >> np.uint64(41)) * _B + _C
    return turned(turned(turned(x, 33) * _B, 29) * _C, 32).view(np.int64)
