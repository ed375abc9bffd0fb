"""Bitmaps of hashed keys: a bounded summary that tasks ask before they shuffle anything.

Spark builds them with its own bitmap aggregates, map side first.  The number of bits is bounded, so the driver
and every worker hold at most ``MOST_BITS / 8`` bytes at any size of the table.  A full bitmap lets more keys pass and
never loses one; what passes is joined exactly.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_BITS = 1 << 30  # 128 MB
_BUCKET = 1 << 15  # bits that Spark puts into one row


def bits_for(n: int, each: int, most: int = MOST_BITS) -> int:
    """A power of two with ``each`` bits for each of ``n`` keys, within the bounds."""
    return min(most, max(1 << 16, 1 << max(0, n * each - 1).bit_length()))


def key_bitmap(df: DataFrame, key: Column, bits: int) -> np.ndarray:
    """Bytes of a bitmap in which the low bits of each 64-bit key are set."""
    at = key.bitwiseAND(F.lit(bits - 1)) + 1
    rows = (
        df.select(at.alias("at"))
        .groupBy(F.bitmap_bucket_number("at").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bitmap"))
    )
    out = np.zeros(bits // 8, np.uint8)
    for row in rows.toLocalIterator():  # a row holds 4 KB
        start = (row["bucket"] - 1) * (_BUCKET // 8)
        out[start : start + _BUCKET // 8] = np.frombuffer(row["bitmap"], np.uint8)
    return out


def is_set(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the bit of each unsigned 64-bit key is set."""
    at = keys & np.uint64(8 * len(bitmap) - 1)
    return (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
