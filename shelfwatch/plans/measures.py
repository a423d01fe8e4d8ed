"""Dashboard measures over the latest snapshot of each product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwatch.functions.numeric import ratio, round_report
from shelfwatch.plans.analytics import value_score
from shelfwatch.schema import PRICE_TIER

PRICE = "price_inc_vat_gbp"


def slice_to(latest: DataFrame, category: str | None = None) -> DataFrame:
    """The rows of one category view, or all; every measure takes the result."""
    return latest if category is None else latest.where(F.col("category") == category)


def _price_bin(width: float) -> Column:
    return (F.floor(F.col(PRICE) / F.lit(width)) * F.lit(width)).cast("double")


def price_histogram(latest: DataFrame, width: int = 50) -> DataFrame:
    """Products per price bin."""
    return (
        latest.where(F.col(PRICE).isNotNull())
        .groupBy(_price_bin(width).alias("price_from"))
        .agg(F.count("*").alias("sku_count"))
        .orderBy("price_from")
    )


def price_skew(latest: DataFrame) -> DataFrame:
    """Population skewness of the price, with the moments around it."""
    price = F.col(PRICE).cast("double")
    return latest.agg(
        F.count(price).alias("sku_count"),
        round_report(F.avg(price), 4).alias("mean_price"),
        round_report(F.stddev_pop(price), 4).alias("sd_price"),
        round_report(F.skewness(price), 4).alias("price_skewness"),
    )


def tier_overview(latest: DataFrame) -> DataFrame:
    """Products, reviews and mean rating per price tier."""
    return latest.groupBy("price_tier").agg(
        F.count("*").alias("sku_count"),
        F.coalesce(F.sum("review_count"), F.lit(0)).cast("bigint").alias("total_reviews"),
        round_report(F.avg("rating_stars"), 2).alias("avg_rating"),
    )


def price_rating_correlation(latest: DataFrame, by: str = "category") -> DataFrame:
    """Linear correlation of price and rating per category."""
    return latest.groupBy(by).agg(
        F.count_if(F.col(PRICE).isNotNull() & F.col("rating_stars").isNotNull()).alias("sku_count"),
        round_report(F.corr(F.col(PRICE).cast("double"), F.col("rating_stars").cast("double")), 4).alias(
            "price_rating_corr"
        ),
    )


def revenue_index(latest: DataFrame) -> DataFrame:
    """Reviews times price, summed per brand."""
    per_brand = (
        latest.where(F.col("brand").isNotNull())
        .groupBy("brand")
        .agg(
            F.count("*").alias("sku_count"),
            round_report(F.sum(F.col("review_count") * F.col(PRICE)), 2).alias("revenue_index"),
        )
    )
    return per_brand.orderBy(F.desc_nulls_last("revenue_index"), "brand")


def brand_tier_mix(latest: DataFrame) -> DataFrame:
    """Products per brand and price tier, one column per tier."""
    tiers = PRICE_TIER[1]
    counts = latest.where(F.col("brand").isNotNull()).groupBy("brand").pivot("price_tier", tiers).count()
    return counts.select("brand", *[F.coalesce(t, F.lit(0)).alias(t.lower()) for t in tiers])


def value_by_tier_and_brand(latest: DataFrame) -> DataFrame:
    """Mean value score per price tier and brand, with a row per tier over all brands."""
    scored = latest.where(F.col("brand").isNotNull()).withColumn("score", value_score().cast("decimal(18,2)"))
    return (
        scored.rollup("price_tier", "brand")
        .agg(
            F.grouping_id().alias("level"),
            F.count("score").alias("scored_skus"),
            round_report(F.avg("score"), 2).alias("avg_value_score"),
        )
        .where("level < 3")
        .select(
            "price_tier",
            F.when(F.col("level") == 0, F.col("brand")).otherwise("All").alias("brand"),
            "scored_skus",
            "avg_value_score",
        )
    )


def discount_penetration(latest: DataFrame) -> DataFrame:
    """Share of products on discount and mean depth per price tier."""
    return latest.groupBy("price_tier").agg(
        F.count("*").alias("sku_count"),
        F.count_if("is_discounted").alias("discounted_skus"),
        round_report(
            ratio(F.count_if("is_discounted").cast("double"), F.count("*").cast("double")) * 100, 2
        ).alias("discount_penetration_pct"),
        round_report(F.avg(F.when(F.col("is_discounted"), F.col("discount_percent"))), 2).alias("avg_depth_pct"),
    )


def band_engagement(latest: DataFrame) -> DataFrame:
    """Reviews per discount band."""
    return latest.groupBy("discount_band").agg(
        F.count("*").alias("sku_count"),
        F.coalesce(F.sum("review_count"), F.lit(0)).cast("bigint").alias("total_reviews"),
        round_report(F.avg("review_count"), 2).alias("avg_reviews"),
    )


def price_band_engagement(latest: DataFrame, width: int = 50) -> DataFrame:
    """Products and reviews per price bin."""
    return (
        latest.where(F.col(PRICE).isNotNull())
        .groupBy(_price_bin(width).alias("price_from"))
        .agg(
            F.count("*").alias("sku_count"),
            F.coalesce(F.sum("review_count"), F.lit(0)).cast("bigint").alias("total_reviews"),
            round_report(F.avg("review_count"), 2).alias("avg_reviews"),
        )
        .orderBy("price_from")
    )


def review_elasticity(latest: DataFrame, by: str = "category") -> DataFrame:
    """Slope of reviews on price per category, linear and log-log (the elasticity)."""
    price, reviews = F.col(PRICE).cast("double"), F.col("review_count").cast("double")
    both = (price > 0) & (reviews > 0)
    return latest.groupBy(by).agg(
        F.regr_count(reviews, price).alias("sku_count"),
        round_report(F.regr_slope(reviews, price), 4).alias("review_slope"),
        round_report(F.regr_slope(F.when(both, F.ln(reviews)), F.when(both, F.ln(price))), 4).alias("review_elasticity"),
    )


def category_slicer(latest: DataFrame) -> DataFrame:
    """Headline figures per category and over all of them."""
    return (
        latest.rollup("category")
        .agg(
            F.grouping("category").alias("is_total"),
            F.count("*").alias("sku_count"),
            round_report(F.avg(PRICE), 2).alias("avg_price"),
            round_report(F.avg("rating_stars"), 2).alias("avg_rating"),
            F.coalesce(F.sum("review_count"), F.lit(0)).cast("bigint").alias("total_reviews"),
        )
        .select(
            F.when(F.col("is_total") == 1, "All").otherwise(F.col("category")).alias("category"),
            "sku_count",
            "avg_price",
            "avg_rating",
            "total_reviews",
        )
    )
