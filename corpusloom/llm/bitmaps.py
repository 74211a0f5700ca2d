"""Sets of hashes as bitmaps of a fixed size: what is in the set is always found, and little else is.

A bitmap is made from a distributed table of any size, but no more than its BITS ever reach the driver and the workers
(8 MB). It only spares work: whoever uses one must decide exactly afterwards, so a bitmap that is full costs time, not
correctness."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26


def bitmap(df: DataFrame, hashed: Column) -> np.ndarray:
    """The lowest bits of hashed, a long column, as a bitmap of BITS; nulls are left out."""
    at = hashed.bitwiseAND(F.lit(BITS - 1)).alias("at")
    words = df.select(at).where("at IS NOT NULL").groupBy(F.expr("shiftright(at, 6)").alias("w")).agg(F.expr("bit_or(shiftleft(1L, CAST(at & 63 AS INT)))").alias("b"))
    got = words.toArrow()
    out = np.zeros(BITS // 64, np.int64)
    out[got["w"].to_numpy()] = got["b"].to_numpy()
    return out.view(np.uint8)


def holds(bits: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Which of hashed, as uint64, may be in the set."""
    at = hashed & np.uint64(BITS - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def holds_one(bits: np.ndarray, hashed: int) -> bool:
    at = hashed & (BITS - 1)
    return bool(bits[at >> 3] >> (at & 7) & 1)
