"""A bitmap of 64-bit hashes of fixed size: a bit that is not set proves that a hash is not among them. It thins rows before an exact join, whatever the number of hashes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 2**26 bits are 8 MB.
BITS = 26
_CHUNK = 1 << 15  # bits of one row of Spark's bitmap aggregate


def bitmap(df: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """The bits of the low ``bits`` bits of the hashes in a column, as bytes; that is all that reaches the driver."""
    low = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    rows = df.select(F.floor(low / _CHUNK).alias("chunk"), (low % _CHUNK).alias("bit")).groupBy("chunk").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    out = np.zeros(((1 << bits) // _CHUNK, _CHUNK // 8), np.uint8)
    for r in rows:
        out[r.chunk] = np.frombuffer(r.bits, np.uint8)
    return out.ravel()


def known(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes have their bit set."""
    low = hashes.view(np.uint64) & np.uint64(8 * len(table) - 1)
    return (table[low >> np.uint64(3)] >> (low & np.uint64(7)).astype(np.uint8)) & 1 > 0
