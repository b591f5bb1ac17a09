"""Bitmaps of a fixed size that let through every value of a set, and few others."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 2 MB, whatever the number of values; with very many values it lets everything through.
BITS = 1 << 24

_BUCKET = 32768


def build(df: DataFrame, value: str) -> bytes:
    """Bit ``value mod BITS`` of every long; at most BITS / 32768 + 1 rows of 4 KB reach the driver."""
    bit = F.pmod(F.col(value), F.lit(BITS))
    rows = (
        df.groupBy(F.bitmap_bucket_number(bit).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
        .collect()
    )
    out = np.zeros((BITS // _BUCKET + 2, _BUCKET // 8), np.uint8)
    for row in rows:
        if row["bucket"] is not None:
            out[row["bucket"]] = np.frombuffer(row["bits"], np.uint8)
    return out.tobytes()


def contains(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the 64-bit ``values`` the bitmap lets through."""
    # bucket numbers start at 1 for bits 1 to 32768; bit 0 lies in bucket 0
    bit = values.view(np.int64) % BITS
    bucket = np.where(bit > 0, (bit - 1) // _BUCKET + 1, 0)
    place = np.where(bit > 0, (bit - 1) % _BUCKET, 0)
    return (bitmap[bucket * (_BUCKET // 8) + place // 8] >> (place % 8).astype(np.uint8)) & 1 > 0
