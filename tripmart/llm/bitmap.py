"""A set of 64-bit hashes as a bit map of fixed size, for tasks to leave out rows early.

It may hold hashes that were never put in, so whoever uses it joins exactly afterwards. More members fill it and make
it less selective; its size, and what reaches the driver to build it, stay the same.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET_BYTES = 4096  # of Spark's bitmap functions


@dataclass(frozen=True)
class BitMap:
    bits: int
    flags: np.ndarray

    @classmethod
    def of(cls, frame: DataFrame, column: str, bits: int) -> BitMap:
        """The hashes (bigint) of a column. At most 2^bits / 8 bytes are collected."""
        slot = F.shiftrightunsigned(F.col(column), 64 - bits) + 1
        rows = (
            frame.select(slot.alias("slot"))
            .groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
            .collect()
        )
        flags = np.zeros(max((1 << bits) // 8, BUCKET_BYTES), np.uint8)
        for row in rows:
            at = (row["bucket"] - 1) * BUCKET_BYTES
            flags[at:at + BUCKET_BYTES] = np.frombuffer(bytes(row["bits"]), np.uint8)
        return cls(bits, flags)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        slots = hashes >> np.uint64(64 - self.bits)
        return (self.flags[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8)) & 1 == 1
