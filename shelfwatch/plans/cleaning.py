"""The cleaning job: raw text records to typed, deduplicated, enriched products."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shelfwatch.operators import features, normalise, outliers, parsing, quality
from shelfwatch.operators.dedup import latest_per_key, near_newest, newest_distinct
from shelfwatch.schema import CLEAN_COLUMNS, HELPER_COLUMNS
from shelfwatch.session import materialise, passing_shuffles


def _unwatched(df: DataFrame, *counters: Column) -> DataFrame:
    return df


def type_and_dedup(
    raw: DataFrame, exact: bool = True, nulls: str = "last", watch: Callable[..., DataFrame] = _unwatched
) -> DataFrame:
    """Typed rows, the newest per product; ``watch`` as in :func:`enrich_rows`, for rows read and rows without copies."""
    typed = normalise.enforce_schema(raw)
    read = watch(typed, F.count("*").alias("rows_read"))
    copies, key, time = F.count("*").alias("rows_without_copies"), ["product_id"], "scraped_at"
    if exact:
        return newest_distinct(typed, key, time, nulls, read=read, watch=lambda found: watch(found, copies))
    return latest_per_key(near_newest(typed, key, time, nulls, read=watch(read, copies)), key, time, nulls=nulls)


def enrich_rows(df: DataFrame, watch: Callable[..., DataFrame] = _unwatched) -> DataFrame:
    """Every row-level step; one narrow stage after the dedup.

    ``watch`` sees the rows just before each step that fills gaps, with the
    aggregate that counts what will be filled.
    """
    return (
        df.transform(normalise.standardize_missing)
        .transform(normalise.normalise_notes)
        .transform(normalise.normalise_regions)
        .transform(watch, normalise.region_filled().alias("region_filled"))
        .transform(normalise.fill_regions)
        .transform(normalise.standardize_brands)
        .transform(watch, parsing.vat_filled().alias("vat_filled"))
        .transform(parsing.vat_fallback)
        .transform(parsing.parse_bottle_and_abv)
        .transform(parsing.parse_unit_price)
        .transform(watch, parsing.unit_price_filled().alias("unit_price_filled"))
        .transform(parsing.unit_price_fallback)
        .transform(features.price_features)
        .transform(features.discount_features)
        .transform(features.age_feature)
        .transform(features.band_features)
        .transform(quality.prune_columns, HELPER_COLUMNS)
    )


def _ordered(df: DataFrame) -> DataFrame:
    return df.select(*CLEAN_COLUMNS, *[c for c in df.columns if c not in CLEAN_COLUMNS])


def clean_products(raw: DataFrame, exact: bool = True, nulls: str = "last") -> DataFrame:
    """Cleaned products in landing-column order; any other column (``status``) follows.

    The row-level result is written once, as the outlier limits and the result
    both read it; without that the dedup would run twice.
    """
    rows = materialise(enrich_rows(type_and_dedup(raw, exact, nulls)), "clean-rows")
    return _ordered(outliers.flag_outliers(rows))


def run_cleaning(raw: DataFrame, exact: bool = True, nulls: str = "last") -> tuple[DataFrame, dict]:
    """The same rows written to shared storage, without a constant ``status``, and the run summary.

    The counters ride on the writes; no extra pass over the data.
    """
    seen: list[Observation] = []

    def watch(df: DataFrame, *counters: Column) -> DataFrame:
        seen.append(Observation())
        return df.observe(seen[-1], *counters)

    with passing_shuffles(raw.sparkSession):
        latest = type_and_dedup(raw, exact, nulls, watch)
        rows = quality.drop_constant_columns(materialise(enrich_rows(latest, watch), "clean-rows"), ["status"])
    flagged = watch(
        _ordered(outliers.flag_outliers(rows)),
        F.count("*").alias("rows"),
        F.count_if("is_discounted").alias("discounted"),
        F.count_if(F.col("price_inc_vat_gbp").isNull()).alias("without_price"),
        F.count_if("is_outlier").alias("outliers"),
    )
    result = materialise(flagged, "clean")
    return result, {name: count for one in seen for name, count in one.get.items()}
