"""A filter of fixed size for keys that a later join settles.

Rows that cannot match stay out of the shuffle. The filter is a bitmap in one row, so its
size does not grow with the keys; the fuller it is, the less it removes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 1 << 20
#: The largest bitmap, 8 MB.
MOST_SLOTS = 1 << 26


def _slot(key: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots))


def bit_filter(keys: DataFrame, column: str, slots: int = SLOTS) -> DataFrame:
    """One row, one array: a bitmap of ``slots`` bits (``slots / 8`` bytes) with the slot of every key set."""
    filled = keys.select(_slot(F.col(column), slots).alias("_slot")).selectExpr(
        "shiftright(_slot, 6) AS _word", "shiftleft(1L, CAST(_slot & 63 AS INT)) AS _bit"
    )
    words = filled.groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    blank = keys.sparkSession.range(0, slots // 64, 1, 1).select(
        F.col("id").alias("_word"), F.lit(0).cast("bigint").alias("_bits")
    )
    dense = blank.unionByName(words).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    ordered = F.sort_array(F.collect_list(F.struct("_word", "_bits")))
    return dense.agg(F.transform(ordered, lambda x: x["_bits"]).alias("bitmap"))


def passes(bitmap: DataFrame, key: Column, slots: int = SLOTS) -> Column:
    """Whether the slot of ``key`` is set; true for every key the bitmap was made from."""
    at = _slot(key, slots)
    word = F.get(bitmap.scalar(), F.shiftright(at, 6).cast("int"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(F.lit(63)).cast("int"))
    return word.bitwiseAND(bit) != 0
