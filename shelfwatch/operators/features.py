"""Derived price, discount, age, size and strength columns; all row-level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwatch.functions.numeric import band, ratio, round_half_even
from shelfwatch.functions.text import extract
from shelfwatch.schema import (
    ABV_BAND,
    AGE_BAND,
    BOTTLE_BAND,
    CASK_STRENGTH_ABV,
    COMPARABLE_BOTTLE_L,
    DISCOUNT_BAND,
    PRICE_TIER,
    STANDARD_BOTTLE_L,
)

# Fixed value: the pattern of an age statement in a product name.
AGE_PATTERN = r"(?i)\b(\d{1,2})\s*(?:year(?:s)?(?:\s+old)?|yo)\b"


def _at_least(c: Column, limit: float) -> Column:
    """``c >= limit`` where a missing value is FALSE, not NULL."""
    return F.coalesce(c >= F.lit(limit), F.lit(False))


def price_features(df: DataFrame) -> DataFrame:
    """Reference price, alcohol units, price per unit and tier."""
    units = F.col("alcohol_units")
    return (
        df.withColumns(
            {
                "reference_price_gbp": F.coalesce("price_before_discount_gbp", "price_inc_vat_gbp"),
                "alcohol_units": round_half_even(F.col("bottle_size_l") * F.col("abv_percent"), 2),
            }
        )
        .withColumn("alcohol_units", F.when(units > 0, units))
        .withColumns(
            {
                "price_per_alcohol_unit_gbp": round_half_even(ratio(F.col("reference_price_gbp"), units), 2),
                "price_tier": band(F.col("reference_price_gbp"), *PRICE_TIER, right=False),
            }
        )
    )


def discount_features(df: DataFrame) -> DataFrame:
    """Discount amount (positive or NULL), flag, percent and band."""
    before = F.col("price_before_discount_gbp")
    amount = before - F.col("price_inc_vat_gbp")
    percent = round_half_even(ratio(F.col("discount_amount_gbp"), before) * F.lit(100.0), 2)
    return (
        df.withColumn("discount_amount_gbp", amount)
        .withColumn("discount_amount_gbp", F.when(F.col("discount_amount_gbp") > 0, F.col("discount_amount_gbp")))
        .withColumns(
            {
                "is_discounted": F.col("discount_amount_gbp").isNotNull(),
                "discount_percent": F.when(F.col("discount_amount_gbp").isNotNull(), percent).otherwise(
                    F.lit(0.0)
                ),
            }
        )
        .withColumn("discount_band", band(F.col("discount_percent"), *DISCOUNT_BAND))
    )


def stated_age(name: Column) -> Column:
    """Years in an age statement such as ``12 Year Old`` or ``10YO``."""
    return extract(name, AGE_PATTERN, 1).try_cast("bigint")


def age_feature(df: DataFrame) -> DataFrame:
    return df.withColumn("age_years", stated_age(F.col("name")))


def band_features(df: DataFrame) -> DataFrame:
    """Bands and flags of age, bottle size and strength."""
    size, abv, age = F.col("bottle_size_l"), F.col("abv_percent"), F.col("age_years")
    return df.withColumns(
        {
            "is_age_stated": age.isNotNull(),
            "age_band": band(age, *AGE_BAND),
            "bottle_size_band": band(size, *BOTTLE_BAND),
            "is_standard_bottle": _at_least(size, STANDARD_BOTTLE_L),
            "is_comparable_bottle": _at_least(size, COMPARABLE_BOTTLE_L),
            "abv_band": band(abv, *ABV_BAND),
            "is_cask_strength": _at_least(abv, CASK_STRENGTH_ABV),
        }
    )
