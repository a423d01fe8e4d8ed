"""Typing and text normalising of raw product rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch.functions import dates, numeric, text
from shelfwatch.schema import (
    BRAND_ALIASES,
    INTEGER_COLUMNS,
    MISSING_TOKENS,
    NUMERIC_COLUMNS,
    PLACEHOLDER_BRAND,
    REGION_ALIASES,
    REGIONAL_CATEGORY,
    REGIONLESS_CATEGORY,
    TIME_COLUMNS,
    URL_COLUMNS,
    VALID_REGIONS,
)


def enforce_schema(
    df: DataFrame,
    times: Iterable[str] = TIME_COLUMNS,
    integers: Iterable[str] = INTEGER_COLUMNS,
    numbers: Iterable[str] = NUMERIC_COLUMNS,
) -> DataFrame:
    """Cast every raw text column to its type; unreadable cells become NULL.

    Two projections: the first reads each text once, the second checks the
    number it gave. Nested in one, every check would parse the text again.
    """
    read = {c: dates.to_time for c in times}
    read |= {c: numeric.to_exact for c in integers}
    read |= {c: numeric.to_double for c in numbers}
    check = {c: numeric.whole for c in integers} | {c: numeric.finite for c in numbers}
    return df.select(
        *[read[c](F.col(c)).alias(c) if c in read else F.col(c).cast("string").alias(c) for c in df.columns]
    ).select(*[check[c](F.col(c)).alias(c) if c in check else F.col(c) for c in df.columns])


def rejected_cells(
    df: DataFrame,
    times: Iterable[str] = TIME_COLUMNS,
    integers: Iterable[str] = INTEGER_COLUMNS,
    numbers: Iterable[str] = NUMERIC_COLUMNS,
) -> DataFrame:
    """Per typed column, how many non-missing raw cells typing turns into NULL."""
    times, integers, numbers = list(times), list(integers), list(numbers)
    names = [*times, *integers, *numbers]
    texts = standardize_missing(df.select(*names), names)
    copies = texts.select(*names, *[F.col(c).alias(f"{c}_text") for c in names])
    typed = enforce_schema(copies, times, integers, numbers)
    checks = [F.count_if(F.col(f"{c}_text").isNotNull() & F.col(c).isNull()).alias(c) for c in names]
    return unpivot_counts(typed.agg(*checks), "rejected")


def unpivot_counts(one_row: DataFrame, value_name: str) -> DataFrame:
    """A one-row DataFrame of counts as (column, value) rows."""
    names = one_row.columns
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("bigint").alias(value_name)) for c in names]
    )
    return one_row.select(F.inline(pairs))


def standardize_missing(
    df: DataFrame, columns: Iterable[str] | None = None, tokens: Iterable[str] = MISSING_TOKENS
) -> DataFrame:
    """Trim text columns (URLs excepted) and turn missing-value tokens into NULL."""
    if columns is None:
        columns = [
            f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in URL_COLUMNS
        ]
    columns, tokens = set(columns), list(tokens)
    trimmed = df.select(*[text.strip(F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns])
    return trimmed.select(
        *[text.null_if_token(F.col(c), tokens).alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def normalise_notes(df: DataFrame, column: str = "character_notes") -> DataFrame:
    """Tidy a bar-separated list; may leave ``''``, which stays a value."""
    return df.withColumn(column, text.tidy_list(F.col(column)))


def normalise_regions(df: DataFrame) -> DataFrame:
    """Unify ``region`` and ``fact_region``; NULL an own region that cannot be.

    A category without regions loses its own region and a regional category
    loses a name outside the valid list. The fallback is not checked.
    """
    names = df.withColumns(
        {c: F.lower(text.strip(F.col(c))) for c in ("region", "fact_region")} | {"_category": F.lower("category")}
    )
    names = names.withColumns(
        {c: F.coalesce(text.lookup(F.col(c), REGION_ALIASES), F.col(c)) for c in ("region", "fact_region")}
    )
    own, category = F.col("region"), F.col("_category")
    invalid = (category == REGIONAL_CATEGORY) & ~own.isin(VALID_REGIONS)
    kept = F.when((category == REGIONLESS_CATEGORY) | invalid, F.lit(None)).otherwise(own)
    return names.withColumn("region", kept).drop("_category")


def region_filled() -> Column:
    """Aggregate: how many rows :func:`fill_regions` fills, counted on its input."""
    return F.count_if(F.col("region").isNull() & F.col("fact_region").isNotNull())


def fill_regions(df: DataFrame) -> DataFrame:
    """Fill gaps from ``fact_region``, for every category, and write names with a capital."""
    filled = df.withColumn("region", F.coalesce("region", "fact_region"))
    return filled.withColumn("region", text.capitalize(F.col("region"))).drop("fact_region")


def clean_regions(df: DataFrame) -> DataFrame:
    """One region column out of ``region`` and the fallback ``fact_region``."""
    return fill_regions(normalise_regions(df))


def null_infinities(df: DataFrame) -> DataFrame:
    """NaN and infinities of floating columns to NULL, for input that arrives typed."""
    floating = {f.name for f in df.schema if isinstance(f.dataType, T.DoubleType | T.FloatType)}
    return df.select(*[numeric.finite(F.col(c)).alias(c) if c in floating else F.col(c) for c in df.columns])


def standardize_brands(df: DataFrame, aliases: dict[str, str] = BRAND_ALIASES) -> DataFrame:
    """Collapse blanks, unify known spellings, flag the placeholder brand.

    The alias map is a short literal, so no join is needed.
    """
    return (
        df.withColumn("brand", text.collapse_spaces(text.strip(F.col("brand"))))
        .withColumn("brand", F.coalesce(text.lookup(F.lower("brand"), aliases), F.col("brand")))
        .withColumn("is_brand_placeholder", F.col("brand") == F.lit(PLACEHOLDER_BRAND))
    )
