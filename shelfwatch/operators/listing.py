"""Listing rows: first occurrence, cap per category, enrichment by URL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwatch.operators.dedup import top_per_group
from shelfwatch.schema import DETAIL_COLUMNS


def listing_cap(
    df: DataFrame,
    group: str = "category",
    key: str = "product_id",
    order: Sequence[str | Column] = ("page", "position"),
    cap: int | None = None,
) -> DataFrame:
    """First occurrence per key inside a group, then, if asked for, the first ``cap`` rows per group.

    Both steps prune inside each task, so a hot group sends at most ``cap``
    rows per task to the final ranking.
    """
    present = df.where(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    firsts = top_per_group(present, [group, key], order, 1)
    return firsts if cap is None else top_per_group(firsts, [group], order, cap)


def detail_urls(df: DataFrame, url: str = "product_url") -> DataFrame:
    """Distinct non-empty product URLs."""
    return df.select(url).where(F.col(url) != "").distinct()


def enrich(
    rows: DataFrame,
    details: DataFrame,
    url: str = "product_url",
    fields: Sequence[str] = DETAIL_COLUMNS,
) -> DataFrame:
    """Add detail fields by URL; a row without details gets empty texts.

    ``details`` must hold one row per URL, as :func:`detail_urls` asks for.
    Rows without a URL match nothing; each gets a join key of its own, which no
    URL can equal, so that they spread over all tasks however many they are.
    """
    listing = rows.drop(*[c for c in fields if c in rows.columns])
    own_key = F.concat(F.lit("\0"), F.xxhash64(*listing.columns).cast("string"))
    keyed = listing.withColumn("_key", F.when(F.col(url) != "", F.col(url)).otherwise(own_key))
    side = details.where(F.col(url) != "").select(F.col(url).alias("_key"), *fields)
    joined = keyed.join(side, "_key", "left")
    return joined.select(
        *listing.columns, *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in fields]
    )


def rows_per_group(df: DataFrame, group: str = "category") -> DataFrame:
    return df.groupBy(group).agg(F.count("*").alias("row_count"))
