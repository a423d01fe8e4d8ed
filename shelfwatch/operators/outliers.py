"""Advisory outlier flags per category."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.functions.quantiles import grouped_quantile
from shelfwatch.schema import OUTLIER_MIN_VALUES, OUTLIER_QUANTILE
from shelfwatch.session import materialise

METRICS = {
    "price_inc_vat_gbp": "is_price_outlier",
    "price_per_alcohol_unit_gbp": "is_value_outlier",
}


def outlier_limits(
    df: DataFrame,
    group: str = "category",
    q: float = OUTLIER_QUANTILE,
    min_values: int = OUTLIER_MIN_VALUES,
) -> DataFrame:
    """One row per group with the limit of each metric; too few values give no limit."""
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in METRICS])
    long = df.select(group, F.inline(cells))
    limits = grouped_quantile(long, [group, "metric"], "value", q).where(F.col("value_count") >= min_values)
    return limits.groupBy(group).agg(
        *[F.max(F.when(F.col("metric") == m, F.col("quantile"))).alias(f"_limit_{m}") for m in METRICS]
    )


def flag_outliers(
    df: DataFrame,
    group: str = "category",
    q: float = OUTLIER_QUANTILE,
    min_values: int = OUTLIER_MIN_VALUES,
    stage: Callable[[DataFrame, str], DataFrame] = materialise,
) -> DataFrame:
    """Flag values strictly above their group's limit; no row is dropped.

    The limits (one row per category) are written first. Spark then knows their
    size: small ones are broadcast, and the rows stay where they are instead of
    being shuffled on a key with a handful of values. Too many categories for a
    broadcast fall back to a shuffled join.
    """
    limits = stage(outlier_limits(df, group, q, min_values), "limits")
    joined = df.join(limits, group, "left")
    flags = {
        flag: F.coalesce(F.col(metric) > F.col(f"_limit_{metric}"), F.lit(False))
        for metric, flag in METRICS.items()
    }
    return (
        joined.withColumns(flags)
        .withColumn("is_outlier", F.col("is_price_outlier") | F.col("is_value_outlier"))
        .select(*df.columns, *flags, "is_outlier")
    )
