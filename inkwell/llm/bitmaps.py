"""Sets of 64-bit hashes as bitmaps of bounded size, to tell readers which rows are wanted.

A row that isn't in the set may be taken for one (never the other way round), so whoever reads by a bitmap
joins exactly afterwards; the size decides what is read for nothing, not what results.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Least and greatest size, as powers of two: 128 KB to 16 MB.
MIN_BITS, MAX_BITS = 20, 27


@dataclass
class Bitmap:
    held: np.ndarray
    bits: int

    @classmethod
    def of(cls, rows: DataFrame, column: str, n: int) -> Bitmap:
        """Of about n hashes; each sets two bits."""
        bits = min(MAX_BITS, max(MIN_BITS, int(n * 16).bit_length()))
        mask = (1 << bits) - 1
        both = (F.col(column).bitwiseAND(F.lit(mask)), F.shiftrightunsigned(F.col(column), 64 - bits))
        places = rows.select(F.explode(F.array(*[x + 1 for x in both])).alias("place"))
        parts = places.groupBy(F.bitmap_bucket_number("place").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bitmap"))
        held = np.zeros(1 << (bits - 3), np.uint8)
        for part, bitmap in parts.collect():  # at most 2^(MAX_BITS - 15) rows of 4 KB
            held[(part - 1) * 4096 : part * 4096] = np.frombuffer(bitmap, np.uint8)
        return cls(held, bits)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        h = hashes.view(np.uint64)
        both = (h & np.uint64((1 << self.bits) - 1), h >> np.uint64(64 - self.bits))
        return np.logical_and(*[(self.held[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 for p in both])
