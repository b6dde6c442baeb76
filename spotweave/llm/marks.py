"""Fixed-size bit marks: a small, bounded pre-filter of large tables.

A set of keys of any number is noted as bits of a bitmap whose size never
depends on the data.  A scan drops rows whose bit is not set; what passes is a
superset, which an exact join or aggregate then decides.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 22  # 2**22 bits are 512 KB, whatever the number of keys
MANY_BITS = 25  # 2**25 bits are 4 MB, for keys that are as many as shingles
_ROW_BITS = 32_768  # bits in one row of Spark's bitmap functions


def position(key: Column, bits: int = BITS) -> Column:
    """Bit position, from 1, of a 64-bit key."""
    return F.pmod(key, F.lit(1 << bits)) + 1


def marked(keys: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """Rows (bucket, bits) that note the keys of a table: at most 2**bits / 32768, 128 for ``BITS``."""
    at = keys.select(position(F.col(key), bits).alias("_at"))
    rows = at.select(F.bitmap_bucket_number("_at").alias("_bucket"), F.bitmap_bit_position("_at").alias("_bit"))
    return rows.groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bits"))


def is_marked(bits: Column, key: Column) -> Column:
    """Whether the bit of a key is set in its bucket's bits (null: no bucket)."""
    bit = F.bitmap_bit_position(position(key))
    byte = F.conv(F.hex(F.substring(bits, (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))


def with_marks(df: DataFrame, key: str, marks: DataFrame) -> DataFrame:
    """Rows of ``df`` with ``_passes``; the marks (at most 128 rows, 512 KB) are broadcast."""
    bucket = F.bitmap_bucket_number(position(F.col(key)))
    joined = df.join(F.broadcast(marks), bucket == F.col("_bucket"), "left")
    return joined.withColumn("_passes", is_marked(F.col("_bits"), F.col(key))).drop("_bucket", "_bits")


def to_array(marks: DataFrame, bits: int = BITS) -> np.ndarray:
    """The marks as one array of 2**bits bits for use inside tasks."""
    out = np.zeros((1 << bits) // 8, dtype=np.uint8)
    width = _ROW_BITS // 8
    for row in marks.collect():  # rows of 4 KB, 2**bits / 8 bytes in all
        start = (row["_bucket"] - 1) * width
        out[start : start + width] = np.frombuffer(row["_bits"], dtype=np.uint8)
    return out


def test(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the bits of signed 64-bit keys are set."""
    at = keys.astype(np.int64) & (8 * len(bitmap) - 1)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
