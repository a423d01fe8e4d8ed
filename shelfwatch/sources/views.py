"""Views kept in the catalog as SQL text: tables of the current star, snapshots, latest snapshots and three reports.

They resolve in every session of the catalog, also one that never saw the load. A reload
makes them anew; until then they show the star they were made for, whose tables stay.
Their text is plain SQL: a median in a view keeps one counter per price of a group. The
jobs in :mod:`shelfwatch.plans.analytics` spread that over tasks.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from shelfwatch.schema import FACT_MEASURES, SNAPSHOT_COLUMNS, STAR_TYPES
from shelfwatch.sources import star_store, versions

_PRODUCT = SNAPSHOT_COLUMNS[2:26]


def _rounded(expression: str, digits: int) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(28,6)), {digits}) AS DOUBLE)"


def _star_join(fact: str) -> str:
    """Fact and products lie in the same buckets and are merged there; Spark would broadcast millions of products, by the size of their packed files."""
    shown = ["f.snapshot_key", "d.full_date", *[f"p.{c}" for c in _PRODUCT], "t.price_tier", "b.discount_band"]
    shown += [f"f.{c}" for c in [*FACT_MEASURES, "snapshot_ts"]]
    return (
        f"SELECT /*+ MERGE(p) */ {', '.join(shown)} FROM {fact} f JOIN {{db}}.dim_date d ON f.date_key = d.date_key"
        " JOIN {db}.dim_product p ON f.product_key = p.product_key"
        " LEFT JOIN {db}.dim_price_tier t ON f.price_tier_key = t.price_tier_key"
        " LEFT JOIN {db}.dim_discount_band b ON f.discount_band_key = b.discount_band_key"
    )


_NEWEST = ["date_key", "snapshot_ts", *FACT_MEASURES, "snapshot_key", "price_tier_key", "discount_band_key"]
_LATEST_FACT = (
    "(SELECT product_key, newest.* FROM (SELECT product_key, max(struct("
    + ", ".join(_NEWEST) + ")) AS newest FROM {db}.fact_product_snapshot GROUP BY product_key))"
)


def _entity(kind: str, column: str) -> str:
    return (
        f"SELECT '{kind}' AS entity_type, {column} AS entity_name, count(*) AS sku_count, CAST(sum(review_count) AS BIGINT) AS total_reviews, "
        + _rounded("sum(rating_stars * review_count) / nullif(sum(review_count), 0)", 2) + " AS weighted_rating FROM {db}.product_latest"
        f" WHERE {column} IS NOT NULL AND rating_stars IS NOT NULL AND review_count IS NOT NULL GROUP BY {column} HAVING sum(review_count) >= 200"
    )


_TOP_RATINGS = (
    "SELECT entity_type, entity_name, sku_count, total_reviews, weighted_rating FROM (SELECT *, row_number() OVER ("
    "PARTITION BY entity_type ORDER BY weighted_rating DESC NULLS LAST, total_reviews DESC, entity_name) AS place FROM ("
    + _entity("Brand", "brand") + " UNION ALL " + _entity("Region", "region")
    + " UNION ALL SELECT 'Product', CAST(product_id AS STRING), 1, CAST(review_count AS BIGINT), " + _rounded("rating_stars", 2)
    + " FROM {db}.product_latest WHERE rating_stars IS NOT NULL AND review_count >= 50)) WHERE place <= 3"
)

# The tiers of ages and ratings.
_AGE_TIER = (
    "CASE WHEN age_years BETWEEN 1 AND 9 THEN '01-09' WHEN age_years BETWEEN 10 AND 12 THEN '10-12'"
    " WHEN age_years BETWEEN 13 AND 15 THEN '13-15' WHEN age_years BETWEEN 16 AND 18 THEN '16-18'"
    " WHEN age_years BETWEEN 19 AND 21 THEN '19-21' WHEN age_years BETWEEN 22 AND 25 THEN '22-25'"
    " WHEN age_years BETWEEN 26 AND 30 THEN '26-30' ELSE '31+' END"
)
_QUALITY_TIER = (
    "CASE WHEN rating_stars >= 4.5 THEN 'Exceptional (4.5+)' WHEN rating_stars >= 4.0 THEN 'Excellent (4.0-4.5)'"
    " WHEN rating_stars >= 3.5 THEN 'Good (3.5-4.0)' ELSE 'Average (<3.5)' END"
)


def _factor(name: str, level: str, condition: str, least: int = 0) -> str:
    mean = "CAST(avg(price_inc_vat_gbp) AS DECIMAL(28,6))"
    return (
        f"SELECT '{name}' AS factor, {level} AS category, count(DISTINCT product_id) AS sku_count, {_rounded('avg(price_inc_vat_gbp)', 2)} AS avg_price, "
        f"{_rounded(f'{mean} - first(b)', 2)} AS vs_baseline_gbp, "
        + _rounded(f"CAST({mean} - first(b) AS DOUBLE) / nullif(CAST(first(b) AS DOUBLE), 0) * 100", 1)
        + f" AS vs_baseline_pct FROM based WHERE {condition} GROUP BY {level} HAVING count(DISTINCT product_id) >= {least}"
    )


_PRICE_PREMIUM = (
    "WITH comparable AS (SELECT * FROM {db}.product_latest WHERE is_comparable_bottle AND price_inc_vat_gbp IS NOT NULL),"
    " base AS (SELECT CAST(percentile(CAST(price_inc_vat_gbp AS DOUBLE), 0.5) AS DECIMAL(28,6)) AS b, count(DISTINCT product_id) AS n FROM comparable),"
    " based AS (SELECT c.*, (SELECT b FROM base) AS b FROM comparable c)"
    f" SELECT 'Overall Baseline' AS factor, 'All comparable bottles (median baseline)' AS category, n AS sku_count, {_rounded('b', 2)} AS avg_price,"
    " CAST(NULL AS DOUBLE) AS vs_baseline_gbp, CAST(NULL AS DOUBLE) AS vs_baseline_pct FROM base"
    " UNION ALL " + _factor("Age Tier Premium", _AGE_TIER, "is_age_stated AND age_years > 0", 5)
    + " UNION ALL " + _factor("Cask Strength", "CASE WHEN is_cask_strength THEN 'Cask Strength' ELSE 'Standard ABV' END", "is_cask_strength IS NOT NULL")
    + " UNION ALL " + _factor("Region Premium", "region", "region IS NOT NULL", 10)
    + " UNION ALL " + _factor("Quality Tier", _QUALITY_TIER, "rating_stars IS NOT NULL")
)

_BANDS = (
    "SELECT age_band, " + _rounded("avg(age_years)", 1) + " AS avg_age_years, count(DISTINCT product_id) AS sku_count, "
    + _rounded("avg(price_inc_vat_gbp)", 2) + " AS avg_price, "
    + _rounded("percentile(CAST(price_inc_vat_gbp AS DOUBLE), 0.5)", 2) + " AS median_price, "
    + _rounded("avg(CAST(price_inc_vat_gbp AS DOUBLE) / nullif(CAST(age_years AS DOUBLE), 0))", 2) + " AS price_per_year_aged, "
    + _rounded("avg(rating_stars)", 2) + " AS avg_rating, " + _rounded("avg(price_per_alcohol_unit_gbp)", 2) + " AS avg_price_per_unit"
    " FROM {db}.product_latest WHERE is_age_stated AND is_comparable_bottle AND age_years IS NOT NULL AND price_inc_vat_gbp IS NOT NULL GROUP BY age_band"
)
_PRICE_STEP = "avg_price - lag(avg_price) OVER (ORDER BY avg_age_years, age_band)"
_AGE_STEP = "avg_age_years - lag(avg_age_years) OVER (ORDER BY avg_age_years, age_band)"
_AGE_ROI = (
    f"SELECT *, {_rounded(_PRICE_STEP, 2)} AS marginal_price_increase_gbp, "
    + _rounded(f"({_PRICE_STEP}) / nullif({_AGE_STEP}, 0)", 2) + " AS marginal_cost_per_additional_year,"
    " CASE WHEN price_per_year_aged <= 5 THEN 'Excellent Value' WHEN price_per_year_aged <= 10 THEN 'Good Value'"
    " WHEN price_per_year_aged <= 15 THEN 'Fair Value' ELSE 'Premium/Diminishing Returns' END AS value_assessment"
    f" FROM ({_BANDS})"
)

#: The views behind those of the star's tables, each reading only views before it.
VIEWS = {
    "product_snapshot": _star_join("{db}.fact_product_snapshot"),
    "product_latest": _star_join(_LATEST_FACT),
    "top_ratings": _TOP_RATINGS,
    "price_premium": _PRICE_PREMIUM,
    "age_roi": _AGE_ROI,
}


def publish_views(spark: SparkSession, root: str, database: str) -> list[str]:
    """Make the views of the current star below ``root`` in ``database``; returns their names."""
    state = versions.state(spark, root)
    star_store.read_star(spark, root)  # declares the tables where the catalog lacks them
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    texts = {name: f"SELECT * FROM {star_store.table_name(state, name)}" for name in STAR_TYPES} | VIEWS
    for name, text in texts.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {text.replace('{db}', database)}")
    return list(texts)
