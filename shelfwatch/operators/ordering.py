"""A total order over many tasks: global positions and a sink whose files follow each other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwatch.session import materialise


def with_positions(df: DataFrame, order: Sequence[Column | str], name: str = "position") -> DataFrame:
    """``df`` with each row's place in ``order`` from 1; rows equal in ``order`` follow each other in any order.

    Ranges of the order are dealt to tasks and stored with the number of their range. Each
    range is ranked alone and shifted by the rows of the ranges before it; what meets in one
    task for that is one number per range. A row's place in the input splits ranges of equal keys.
    """
    for taken in (name, "_range", "_place", "_n", "_shift"):
        if taken in df.columns:
            raise ValueError(f"column {taken} is needed for the positions")
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.withColumn("_place", F.monotonically_increasing_id())
    dealt = materialise(placed.repartitionByRange(width, *keys, "_place").withColumn("_range", F.spark_partition_id()), "ordered")
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    shifts = dealt.groupBy("_range").agg(F.count("*").alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift")
    )
    within = W.partitionBy("_range").orderBy(*keys, "_place")
    ranked = dealt.withColumn("_n", F.row_number().over(within)).join(shifts, "_range")
    return ranked.select(*df.columns, (F.col("_n") + F.col("_shift")).cast("bigint").alias(name))


def write_ordered(df: DataFrame, order: Sequence[Column | str], path: str, name: str = "position") -> None:
    """Parquet files that hold the rows in order, file after file, each row with its position."""
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = with_positions(df, order, name)
    placed.repartitionByRange(width, name).sortWithinPartitions(name).write.mode("overwrite").parquet(path)
