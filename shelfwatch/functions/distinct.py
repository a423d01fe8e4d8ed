"""Exact distinct counts of ids that can be merged, by bitmaps.

Per group an id is a bit: its bucket names a bitmap of 32,768 bits, its position the bit in
it. Bitmaps of the same group and bucket merge by OR, so counts of days add up to months
without counting an id twice and without reading the rows again. A task holds one bitmap
(4 KiB) per group and bucket it meets, never the ids of a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_bitmaps(df: DataFrame, groups: Sequence[str], id_column: str) -> DataFrame:
    """``groups, bucket, bitmap`` of the ids of every group; NULL ids are left out, NULL groups are one group."""
    marked = df.where(F.col(id_column).isNotNull()).select(
        *groups, F.bitmap_bucket_number(id_column).alias("bucket"), F.bitmap_bit_position(id_column).alias("_bit")
    )
    return marked.groupBy(*groups, "bucket").agg(F.bitmap_construct_agg("_bit").alias("bitmap"))


def merge_bitmaps(bitmaps: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Bitmaps of fewer groups: of the columns that remain."""
    return bitmaps.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def count_bitmaps(bitmaps: DataFrame, groups: Sequence[str], name: str = "distinct_count") -> DataFrame:
    """Distinct ids per group; bitmaps of one group and bucket must have been merged."""
    return bitmaps.groupBy(*groups).agg(F.sum(F.bitmap_count("bitmap")).alias(name))


def count_distinct(df: DataFrame, groups: Sequence[str], id_column: str, name: str = "distinct_count") -> DataFrame:
    return count_bitmaps(distinct_bitmaps(df, groups, id_column), groups, name)
