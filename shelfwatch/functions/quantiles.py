"""Exact quantiles that never hold one group in one task's memory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BUCKETS_PER_LOG_UNIT = 512.0


def _bucket(value: Column) -> Column:
    """A non-decreasing coarse code of ``value``: about 0.2 % wide, few thousand in use.

    Never NULL, so that the join on it adds no filter and both readers of the
    counts keep the same plan, which Spark then runs once.
    """
    size = F.floor(F.log1p(F.abs(value)) * F.lit(BUCKETS_PER_LOG_UNIT))
    return F.coalesce((F.signum(value) * size).cast("int"), F.lit(0))


def quantiles_of_counts(counts: DataFrame, keys: list[str], qs: Sequence[float]) -> DataFrame:
    """``keys, value_count, quantiles`` (an array in the order of ``qs``) for rows ``keys, v, n``; exact, interpolated.

    ``v`` is a double that occurs ``n`` times. A histogram names the buckets that hold the
    two ranks around each quantile, and only the values of those buckets are ordered, so a
    group's values never meet in one task. A NULL key is a group like any other.
    """
    keyed = counts.select(F.struct(*keys).alias("_k"), "v", "n").withColumn("bucket", _bucket(F.col("v")))
    group = W.partitionBy("_k")
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(q)).alias("q")) for i, q in enumerate(qs)])
    position = (F.col("value_count") - 1) * F.col("q")
    histogram = (
        keyed.groupBy("_k", "bucket")
        .agg(F.sum("n").alias("in_bucket"))
        .withColumn("upto", F.sum("in_bucket").over(group.orderBy("bucket")))
        .withColumn("value_count", F.sum("in_bucket").over(group))
        .withColumn("before", F.col("upto") - F.col("in_bucket"))
        .select("*", F.inline(wanted))
        .withColumn("low", F.floor(position))
        .withColumn("high", F.ceil(position))
        .withColumn("weight", position - F.floor(position))
    )

    def holds(rank: str) -> Column:
        return (F.col("before") <= F.col(rank)) & (F.col(rank) < F.col("upto"))

    targets = histogram.where(holds("low") | holds("high")).select(
        "_k", "bucket", "i", "before", "value_count", "low", "high", "weight"
    )
    inside = W.partitionBy("_k", "bucket", "i").orderBy("v")
    ranked = (
        keyed.join(targets, ["_k", "bucket"])
        .withColumn("upto", F.col("before") + F.sum("n").over(inside))
        .withColumn("before", F.col("upto") - F.col("n"))
    )
    each = (
        ranked.where(holds("low") | holds("high"))
        .groupBy("_k", "i")
        .agg(
            F.max("value_count").alias("value_count"),
            F.max("weight").alias("weight"),
            F.max(F.when(holds("low"), F.col("v"))).alias("at_low"),
            F.max(F.when(holds("high"), F.col("v"))).alias("at_high"),
        )
        .withColumn("quantile", F.col("at_low") + (F.col("at_high") - F.col("at_low")) * F.col("weight"))
    )
    listed = F.sort_array(F.collect_list(F.struct("i", "quantile")))
    return (
        each.groupBy("_k")
        .agg(F.max("value_count").alias("value_count"), F.transform(listed, lambda x: x["quantile"]).alias("quantiles"))
        .select(*[F.col("_k")[k].alias(k) for k in keys], "value_count", "quantiles")
    )


def grouped_quantile(df: DataFrame, keys: list[str], value: str, q: float) -> DataFrame:
    """``keys, value_count, quantile`` of a column; rows with a NULL key or value are outside.

    Rows are counted per (group, value) first, so a hot group spreads over its values.
    """
    keep = F.col(value).isNotNull()
    for key in keys:
        keep &= F.col(key).isNotNull()
    counts = df.where(keep).groupBy(*keys, F.col(value).cast("double").alias("v")).agg(F.count("*").alias("n"))
    found = quantiles_of_counts(counts, keys, [q])
    return found.select(*keys, "value_count", F.get("quantiles", 0).alias("quantile"))
