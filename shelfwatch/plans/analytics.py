"""The seven analytics queries over the latest snapshot of each product.

``latest`` holds one row per product, so rows stand for SKUs and a row count
replaces a distinct count of ids. Quantile queries count rows per price before
they group: a brand or region that holds a third of all products is spread over
its prices first, and the task that ends with the group sees each price once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwatch.functions.numeric import ratio, round_report
from shelfwatch.functions.quantiles import quantiles_of_counts
from shelfwatch.operators.dedup import top_per_group
from shelfwatch.session import materialise

PRICE = "price_inc_vat_gbp"


def _present(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.where(F.col(c).isNotNull())
    return df


def _mean(total: str, n: str = "n") -> Column:
    return ratio(F.sum(total), F.sum(n))


def _with_quantiles(groups: DataFrame, counts: DataFrame, keys: list[str], qs: list[float]) -> DataFrame:
    """The groups with an array ``q`` of price quantiles, NULL where a group has no price."""
    priced = counts.where(F.col(PRICE).isNotNull()).select(*keys, F.col(PRICE).cast("double").alias("v"), "n")
    found = quantiles_of_counts(priced, keys, qs).select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("quantiles").alias("q"))
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    return groups.join(found, same, "left").drop(*[f"_{k}" for k in keys])


def _positioning(rows: DataFrame, key: str, min_skus: int) -> DataFrame:
    """Unrounded price, rating and promotion figures per ``key``."""
    rating, reviews = F.col("rating_stars"), F.col("review_count")
    per_price = rows.groupBy(key, PRICE).agg(
        F.count("*").alias("n"),
        F.sum(rating).alias("ratings"),
        F.sum(rating * reviews).alias("weighted"),
        F.sum(reviews).alias("reviews"),
        F.count_if("is_discounted").alias("on_sale"),
    )
    per_price = materialise(per_price, "per-price")
    groups = (
        per_price.withColumn("paid", F.col(PRICE) * F.col("n"))
        .groupBy(key)
        .agg(
            F.sum("n").alias("sku_count"),
            _mean("paid").alias("avg_price"),
            F.min(PRICE).alias("min_price"),
            F.max(PRICE).alias("max_price"),
            _mean("ratings").alias("avg_rating"),
            _mean("weighted", "reviews").alias("weighted_rating"),
            F.sum("reviews").cast("bigint").alias("total_reviews"),
            (_mean("on_sale") * 100).alias("pct_on_sale"),
        )
        .where(F.col("sku_count") >= min_skus)
    )
    return _with_quantiles(groups, per_price, [key], [0.1, 0.5, 0.9])


def _positioning_columns(key: str) -> list[Column]:
    q = F.col("q")
    return [
        F.col(key),
        F.col("sku_count"),
        round_report(q[1], 2).alias("median_price_gbp"),
        round_report(F.col("avg_price"), 2).alias("avg_price_gbp"),
        round_report(F.col("min_price"), 2).alias("min_price_gbp"),
        round_report(F.col("max_price"), 2).alias("max_price_gbp"),
        round_report(q[2] - q[0], 2).alias("p10_p90_spread_gbp"),
        round_report(F.col("avg_rating"), 2).alias("avg_catalog_rating"),
        round_report(F.col("weighted_rating"), 2).alias("weighted_consumer_rating"),
    ]


def brand_positioning(latest: DataFrame, min_skus: int = 5, key: str = "brand") -> DataFrame:
    """Price level, spread, ratings and share on sale per brand, dearest median first."""
    rows = _present(latest, PRICE, "rating_stars", "review_count", key)
    return (
        _positioning(rows, key, min_skus)
        .select(*_positioning_columns(key), round_report(F.col("pct_on_sale"), 1).alias("pct_skus_on_sale_now"))
        .orderBy(F.desc("median_price_gbp"), key)
    )


def region_positioning(
    latest: DataFrame, category: str = "Single Malt", min_skus: int = 5, key: str = "region"
) -> DataFrame:
    """The same figures per region for comparable bottles of one category."""
    rows = _present(latest, key, PRICE, "rating_stars", "review_count").where(
        (F.col("category") == category) & F.col("is_comparable_bottle")
    )
    return (
        _positioning(rows, key, min_skus)
        .select(
            *_positioning_columns(key),
            "total_reviews",
            round_report(F.col("pct_on_sale"), 2).alias("pct_skus_discounted_now"),
        )
        .orderBy(F.desc("avg_price_gbp"), key)
    )


def value_score() -> Column:
    """Rating per price of an alcohol unit; NULL for a zero price."""
    return round_report(ratio(F.col("rating_stars"), F.col("price_per_alcohol_unit_gbp")), 2)


def best_value(
    latest: DataFrame, min_rating: float = 4.0, min_reviews: int = 50, top: int = 20
) -> DataFrame:
    """Top products by value score; a NULL score ranks last."""
    rows = _present(latest, "price_per_alcohol_unit_gbp", "rating_stars", "review_count").where(
        F.col("is_standard_bottle")
        & (F.col("rating_stars") >= min_rating)
        & (F.col("review_count") >= min_reviews)
    )
    return (
        rows.select(
            "product_id", "name", "brand", "region", "bottle_size_l", "rating_stars", "review_count", PRICE,
            "alcohol_units", "price_per_alcohol_unit_gbp", value_score().alias("value_score"),
        )
        .orderBy(F.desc_nulls_last("value_score"), "product_id")
        .limit(top)
    )


def discount_strategy(latest: DataFrame) -> DataFrame:
    """Count and depth of current discounts per band, deepest first."""
    return (
        _present(latest, "discount_percent")
        .where("is_discounted")
        .groupBy("discount_band")
        .agg(
            F.count("*").alias("discounted_skus_now"),
            round_report(F.avg("discount_percent"), 2).alias("avg_discount_pct"),
            round_report(F.avg("discount_amount_gbp"), 2).alias("avg_discount_amount_gbp"),
            round_report(F.min("discount_percent"), 2).alias("min_discount_pct"),
            round_report(F.max("discount_percent"), 2).alias("max_discount_pct"),
        )
        .orderBy(F.desc("avg_discount_pct"), "discount_band")
    )


def top_ratings(
    latest: DataFrame,
    top: int = 3,
    min_group_reviews: int = 200,
    min_product_reviews: int = 50,
    product_label: str = "Product",
) -> DataFrame:
    """Best brands, regions and products by review-weighted rating.

    One pass: every product row counts for its brand, its region and itself.
    A product's weighted rating is its own rating, so the three rankings share
    one aggregate and differ only in the least number of reviews.
    """
    rows = _present(latest, "rating_stars", "review_count")
    entities = F.array(
        F.struct(F.lit("Brand").alias("entity_type"), F.col("brand").alias("entity_name")),
        F.struct(F.lit("Region").alias("entity_type"), F.col("region").alias("entity_name")),
        F.struct(
            F.lit(product_label).alias("entity_type"),
            F.when(F.col("review_count") >= min_product_reviews, F.col("product_id").cast("string")).alias(
                "entity_name"
            ),
        ),
    )
    is_product = F.col("entity_type") == product_label
    rated = (
        rows.select(
            F.col("review_count"),
            (F.col("rating_stars") * F.col("review_count")).alias("weighted"),
            F.inline(entities),
        )
        .where("entity_name IS NOT NULL")
        .groupBy("entity_type", "entity_name")
        .agg(
            F.count("*").alias("sku_count"),
            F.sum("review_count").cast("bigint").alias("total_reviews"),
            round_report(ratio(F.sum("weighted"), F.sum("review_count")), 2).alias("weighted_rating"),
        )
        .where(is_product | (F.col("total_reviews") >= min_group_reviews))
    )
    order = [F.desc_nulls_last("weighted_rating"), F.desc("total_reviews"), F.asc("entity_name")]
    return top_per_group(rated, ["entity_type"], order, top).orderBy("entity_type", *order)


BASELINE = "Overall Baseline"


def _age_tier() -> Column:
    # First and last age of each tier.
    tiers = [(1, 9), (10, 12), (13, 15), (16, 18), (19, 21), (22, 25), (26, 30)]
    out = F
    for low, high in tiers:
        out = out.when(F.col("age_years").between(low, high), f"{low:02d}-{high:02d}")
    return out.otherwise("31+")


def _quality_tier() -> Column:
    rating = F.col("rating_stars")
    return (
        F.when(rating >= 4.5, "Exceptional (4.5+)")
        .when(rating >= 4.0, "Excellent (4.0-4.5)")
        .when(rating >= 3.5, "Good (3.5-4.0)")
        .otherwise("Average (<3.5)")
    )


def price_premium(latest: DataFrame, min_age_skus: int = 5, min_region_skus: int = 10) -> DataFrame:
    """Mean price of each factor level against the median price of all comparable bottles.

    One pass: each product is counted under the baseline and under every factor
    it belongs to, per price. The baseline then meets the other levels as a
    window over the finished table of some twenty rows.
    """
    rows = _present(latest, PRICE).where("is_comparable_bottle")
    blocks = [
        (BASELINE, F.lit("All comparable bottles (median baseline)"), F.lit(True)),
        ("Age Tier Premium", _age_tier(), F.col("is_age_stated") & (F.col("age_years") > 0)),
        (
            "Cask Strength",
            F.when(F.col("is_cask_strength"), "Cask Strength").otherwise("Standard ABV"),
            F.col("is_cask_strength").isNotNull(),
        ),
        ("Region Premium", F.col("region"), F.col("region").isNotNull()),
        ("Quality Tier", _quality_tier(), F.col("rating_stars").isNotNull()),
    ]
    levels = F.array_compact(
        F.array(
            *[
                F.when(condition, F.struct(F.lit(factor).alias("factor"), label.alias("category")))
                for factor, label, condition in blocks
            ]
        )
    )
    counted = (
        rows.select(F.col(PRICE), F.inline(levels))
        .groupBy("factor", "category", PRICE)
        .agg(F.count("*").alias("n"))
    )
    # The baseline row exists even without a comparable bottle.
    empty = latest.sparkSession.range(1).select(
        F.lit(BASELINE).alias("factor"),
        blocks[0][1].alias("category"),
        F.lit(None).cast(counted.schema[PRICE].dataType).alias(PRICE),
        F.lit(0).cast("bigint").alias("n"),
    )
    is_base = F.col("factor") == BASELINE
    counted = materialise(counted.unionByName(empty), "per-level")
    per_level = (
        counted.groupBy("factor", "category")
        .agg(
            F.sum("n").alias("sku_count"),
            ratio(F.sum(F.col(PRICE) * F.col("n")), F.sum("n")).alias("mean"),
        )
    )
    per_level = _with_quantiles(per_level, counted.where(is_base), ["factor", "category"], [0.5]).withColumn(
        "median", F.get("q", 0).cast("decimal(28,6)")
    )
    least = F.when(F.col("factor") == "Age Tier Premium", min_age_skus).when(
        F.col("factor") == "Region Premium", min_region_skus
    )
    base = F.max("median").over(W.partitionBy(F.lit(1)))
    gap = F.when(~is_base, F.col("mean").cast("decimal(28,6)") - F.col("base"))
    return (
        per_level.withColumn("base", base)
        .where(F.col("sku_count") >= F.coalesce(least, F.lit(0)))
        .select(
            "factor",
            "category",
            "sku_count",
            round_report(F.when(is_base, F.col("base")).otherwise(F.col("mean")), 2).alias("avg_price"),
            round_report(gap, 2).alias("vs_baseline_gbp"),
            round_report(ratio(gap.cast("double"), F.col("base").cast("double")) * 100, 1).alias("vs_baseline_pct"),
        )
        .orderBy("factor", F.desc_nulls_last("vs_baseline_gbp"), "category")
    )


def age_roi(latest: DataFrame) -> DataFrame:
    """Price, rating and marginal price per age band of comparable, age-stated bottles."""
    rows = _present(latest, "age_years", PRICE).where("is_age_stated AND is_comparable_bottle")
    per_year = ratio(F.col(PRICE), F.col("age_years"))
    per_price = rows.groupBy("age_band", PRICE).agg(
        F.count("*").alias("n"),
        F.sum("age_years").alias("ages"),
        F.sum(per_year).alias("per_year"),
        F.count(per_year).alias("n_per_year"),
        F.sum("rating_stars").alias("ratings"),
        F.count("rating_stars").alias("n_ratings"),
        F.sum("price_per_alcohol_unit_gbp").alias("unit_prices"),
        F.count("price_per_alcohol_unit_gbp").alias("n_unit_prices"),
    )
    per_price = materialise(per_price, "per-price")
    bands = (
        per_price.withColumn("paid", F.col(PRICE) * F.col("n"))
        .groupBy("age_band")
        .agg(
            round_report(_mean("ages"), 1).alias("avg_age_years"),
            F.sum("n").alias("sku_count"),
            round_report(_mean("paid"), 2).alias("avg_price"),
            round_report(_mean("per_year", "n_per_year"), 2).alias("price_per_year_aged"),
            round_report(_mean("ratings", "n_ratings"), 2).alias("avg_rating"),
            round_report(_mean("unit_prices", "n_unit_prices"), 2).alias("avg_price_per_unit"),
        )
    )
    bands = _with_quantiles(bands, per_price, ["age_band"], [0.5])
    order = [c for b in bands.columns if b != "q" for c in ([b, "median_price"] if b == "avg_price" else [b])]
    bands = bands.withColumn("median_price", round_report(F.get("q", 0), 2)).select(*order)
    # One task, over at most one row per age band.
    by_age = W.orderBy("avg_age_years", "age_band")
    price_step = F.col("avg_price") - F.lag("avg_price").over(by_age)
    age_step = F.col("avg_age_years") - F.lag("avg_age_years").over(by_age)
    cost = F.col("price_per_year_aged")
    return (
        bands.withColumns({"price_step": price_step, "age_step": age_step})
        .select(
            *bands.columns,
            round_report(F.col("price_step"), 2).alias("marginal_price_increase_gbp"),
            round_report(ratio(F.col("price_step"), F.col("age_step")), 2).alias("marginal_cost_per_additional_year"),
            F.when(cost <= 5, "Excellent Value")
            .when(cost <= 10, "Good Value")
            .when(cost <= 15, "Fair Value")
            .otherwise("Premium/Diminishing Returns")
            .alias("value_assessment"),
        )
        .orderBy("avg_age_years", "age_band")
    )
