"""Prices, sizes and strengths out of free text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwatch.functions.numeric import ratio, round_half_even
from shelfwatch.functions.text import extract, strip
from shelfwatch.schema import VAT_FACTOR

# The patterns a product's texts are read with.
AMOUNT_PATTERN = r"(\d+(?:\.\d+)?)\s*(?:ml|cl|l|litre|liter)"
UNIT_PATTERN = r"(?i)(\d+(?:\.\d+)?)\s*(ml|cl|l|litre|liter)"
STRENGTH_PATTERN = r"(\d+(?:\.\d+)?)\s*%"
NUMBER_PATTERN = r"(\d+(?:\.\d+)?)"
BASIS_PATTERN = r"(?:per|/)\s*([0-9]+(?:\.[0-9]+)?\s*)?(ml|cl|l|litre|liter)"


def vat_price(ex_vat: Column, factor: float = VAT_FACTOR) -> Column:
    return round_half_even(ex_vat * F.lit(factor), 2)


def vat_fallback(df: DataFrame) -> DataFrame:
    """Fill a missing tax-inclusive price from the tax-exclusive one."""
    filled = F.coalesce(F.col("price_inc_vat_gbp"), vat_price(F.col("price_ex_vat_gbp")))
    return df.withColumn("price_inc_vat_gbp", filled)


def vat_filled() -> Column:
    """Aggregate: how many rows :func:`vat_fallback` fills, counted on its input."""
    return F.count_if(F.col("price_inc_vat_gbp").isNull() & F.col("price_ex_vat_gbp").isNotNull())


def parse_bottle_and_abv(df: DataFrame) -> DataFrame:
    """Volume in litres and centilitres and strength out of ``variant``.

    The amount is matched in lower case only and the unit in any case, so an
    upper-case unit has a unit but no amount and the volume stays NULL. Each
    pattern runs once, in a projection of its own. A group that did not match
    is ``''``, which casts to NULL.
    """
    variant, amount, unit = F.col("variant"), F.col("_amount"), F.col("_unit")
    litres = (
        F.when(unit == "ml", amount / F.lit(1000.0))
        .when(unit == "cl", amount / F.lit(100.0))
        .when(unit.isin("l", "litre", "liter"), amount)
    )
    return (
        df.withColumns(
            {
                "_amount": extract(variant, AMOUNT_PATTERN, 1).try_cast("double"),
                "_unit": F.lower(extract(variant, UNIT_PATTERN, 2)),
                "abv_percent": extract(variant, STRENGTH_PATTERN, 1).try_cast("double"),
            }
        )
        .withColumn("bottle_size_l", litres)
        .withColumn("bottle_size_cl", round_half_even(F.col("bottle_size_l") * F.lit(100.0), 2))
        .drop("_amount", "_unit")
    )


def parse_unit_price(df: DataFrame) -> DataFrame:
    """Price per litre out of a text such as ``£25.00 per 70cl``.

    The basis only scales a price when it is understood: a volume with a
    quantity, or a bare litre. A basis quantity of zero gives NULL.
    """
    raw = F.col("unit_price_raw")
    basis = F.translate(F.lower(raw), ",", "")
    quantity, unit = F.col("_quantity"), F.col("_unit")
    litre = unit.isin("l", "litre", "liter")
    scale = (
        F.when((unit == "ml") & quantity.isNotNull(), ratio(F.lit(1000.0), quantity))
        .when((unit == "cl") & quantity.isNotNull(), ratio(F.lit(100.0), quantity))
        .when(litre, ratio(F.lit(1.0), F.coalesce(quantity, F.lit(1.0))))
        .otherwise(F.lit(1.0))
    )
    return (
        df.withColumns(
            {
                "_price": extract(F.translate(raw, "£,", ""), NUMBER_PATTERN, 1).try_cast("double"),
                "_quantity": strip(extract(basis, BASIS_PATTERN, 1)).try_cast("double"),
                "_unit": extract(basis, BASIS_PATTERN, 2),
            }
        )
        .withColumn("unit_price_gbp_per_litre", round_half_even(F.col("_price") * scale, 2))
        .drop("_price", "_quantity", "_unit")
    )


def _computed_litre_price() -> Column:
    size = F.col("bottle_size_l")
    return F.when(size > 0, round_half_even(ratio(F.col("price_inc_vat_gbp"), size), 2))


def unit_price_filled() -> Column:
    """Aggregate: how many rows :func:`unit_price_fallback` fills, counted on its input."""
    return F.count_if(F.col("unit_price_gbp_per_litre").isNull() & _computed_litre_price().isNotNull())


def unit_price_fallback(df: DataFrame) -> DataFrame:
    """Fill a missing price per litre from price and volume."""
    computed = _computed_litre_price()
    return df.withColumn("unit_price_gbp_per_litre", F.coalesce(F.col("unit_price_gbp_per_litre"), computed))
