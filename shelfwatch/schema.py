"""Column lists, types and the fixed vocabularies of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns of a raw product record, all text.
RAW_COLUMNS = [
    "scraped_at", "category", "product_id", "name", "brand", "variant",
    "price_ex_vat_gbp", "unit_price_raw", "region", "promo_label", "status",
    "product_url", "image_url",
    "rating_stars", "review_count",
    "price_inc_vat_gbp", "price_before_discount_gbp",
    "style_body", "style_richness", "style_smoke", "style_sweetness",
    "character_notes",
    "fact_bottler", "fact_country", "fact_region", "fact_cask_type", "fact_colouring",
]

# The columns of a cleaned product record, in landing-table order.
CLEAN_COLUMNS = [
    "scraped_at",
    "category", "product_id", "name", "brand", "region", "is_brand_placeholder",
    "product_url", "image_url",
    "price_ex_vat_gbp", "price_inc_vat_gbp", "price_before_discount_gbp",
    "unit_price_gbp_per_litre", "reference_price_gbp",
    "bottle_size_l", "bottle_size_cl", "abv_percent", "alcohol_units",
    "price_per_alcohol_unit_gbp",
    "discount_amount_gbp", "discount_percent", "discount_band", "is_discounted", "price_tier",
    "age_years", "is_age_stated", "age_band", "is_cask_strength",
    "bottle_size_band", "abv_band", "is_standard_bottle", "is_comparable_bottle",
    "is_price_outlier", "is_value_outlier", "is_outlier",
    "rating_stars", "review_count",
    "style_body", "style_richness", "style_smoke", "style_sweetness", "character_notes",
    "fact_bottler", "fact_country", "fact_cask_type", "fact_colouring",
]

# How raw text columns are typed during cleaning.
TIME_COLUMNS = ["scraped_at"]
INTEGER_COLUMNS = [
    "product_id", "review_count", "style_body", "style_richness", "style_smoke", "style_sweetness",
]
NUMERIC_COLUMNS = [
    "price_ex_vat_gbp", "price_inc_vat_gbp", "price_before_discount_gbp", "rating_stars",
]
URL_COLUMNS = ["product_url", "image_url"]

# Columns that only feed other columns and leave the cleaned record.
HELPER_COLUMNS = ["variant", "promo_label", "unit_price_raw"]

# The fields a product detail page adds to a listing row.
DETAIL_COLUMNS = [
    "rating_stars", "review_count", "price_inc_vat_gbp", "price_before_discount_gbp",
    "style_body", "style_richness", "style_smoke", "style_sweetness", "character_notes",
    "fact_bottler", "fact_country", "fact_region", "fact_cask_type", "fact_colouring",
]

# Vocabularies of the cleaning rules.
MISSING_TOKENS = ["", "none", "n/a", "na", "nan", "null", "undefined"]
CSV_NULL_TOKENS = ["", "NULL", "null"]
TRUE_WORDS = ["true", "t", "1", "yes", "y"]
FALSE_WORDS = ["false", "f", "0", "no", "n"]
VALID_REGIONS = ["highland", "islay", "speyside", "lowland", "campbeltown", "island"]
REGION_ALIASES = {"islands": "island", "the islands": "island"}
REGIONLESS_CATEGORY = "blended"
REGIONAL_CATEGORY = "single malt"
PLACEHOLDER_BRAND = "Independent/Unknown"
BRAND_ALIASES = {
    "chivas": "Chivas Regal",
    "chivas regal": "Chivas Regal",
    "various distilleries": "Independent/Unknown",
    "undisclosed distillery": "Independent/Unknown",
    "unknown distillery": "Independent/Unknown",
    "secret distillery": "Independent/Unknown",
}

# Edges and labels of the bands; ``None`` is an open upper end.
PRICE_TIER = ([0, 40, 120, None], ["Budget", "Premium", "Luxury"])
DISCOUNT_BAND = (
    [-0.01, 0, 10, 20, 40, None],
    ["No Discount", "Low (≤10%)", "Medium (10–20%)", "High (20–40%)", "Very High (>40%)"],
)
AGE_BAND = ([0, 10, 15, 18, 25, None], ["≤10", "11–15", "16–18", "19–25", "25+"])
BOTTLE_BAND = (
    [0, 0.35, 0.7, 1.0, None],
    ["Mini/Small (≤35cl)", "Half–Standard (35–70cl)", "Standard–Large (70cl–1L)", "Extra Large (>1L)"],
)
ABV_BAND = ([0, 40, 43, 46, 50, None], ["≤40%", "40–43%", "43–46%", "46–50%", "50%+"])

# Thresholds of the flags.
CASK_STRENGTH_ABV = 50
STANDARD_BOTTLE_L = 0.70
COMPARABLE_BOTTLE_L = 0.35
VAT_FACTOR = 1.2
OUTLIER_QUANTILE = 0.99
OUTLIER_MIN_VALUES = 30
LISTING_CAP = 600

# Warehouse types of the product dimension's typed attributes.
PRODUCT_DECIMALS = {
    "style_body": (2, 0), "style_richness": (2, 0), "style_smoke": (2, 0), "style_sweetness": (2, 0),
    "bottle_size_l": (10, 3), "bottle_size_cl": (10, 1), "abv_percent": (5, 2), "age_years": (5, 0),
}
PRODUCT_FLAGS = [
    "is_standard_bottle", "is_comparable_bottle", "is_cask_strength", "is_age_stated",
    "is_brand_placeholder", "is_price_outlier", "is_value_outlier", "is_outlier",
]
# Attribute order of the product dimension after its keys.
PRODUCT_ATTRIBUTES = [
    "name", "brand", "category", "region", "product_url", "image_url",
    "style_body", "style_richness", "style_smoke", "style_sweetness", "character_notes",
    "fact_bottler", "fact_country", "fact_cask_type", "fact_colouring",
    "bottle_size_l", "bottle_size_cl", "bottle_size_band", "is_standard_bottle", "is_comparable_bottle",
    "abv_percent", "abv_band", "is_cask_strength",
    "age_years", "is_age_stated", "age_band",
    "is_brand_placeholder",
    "is_price_outlier", "is_value_outlier", "is_outlier",
]
# Warehouse types of the fact's measures.
FACT_DECIMALS = {
    "price_ex_vat_gbp": (10, 2), "price_inc_vat_gbp": (10, 2), "price_before_discount_gbp": (10, 2),
    "unit_price_gbp_per_litre": (10, 2), "reference_price_gbp": (10, 2),
    "alcohol_units": (10, 2), "price_per_alcohol_unit_gbp": (10, 4),
    "discount_amount_gbp": (10, 2), "discount_percent": (6, 2),
    "rating_stars": (4, 2), "review_count": (10, 0),
}
FACT_FLAGS = ["is_discounted"]
# Measure order of the fact after its keys.
FACT_MEASURES = [
    "price_ex_vat_gbp", "price_inc_vat_gbp", "price_before_discount_gbp",
    "unit_price_gbp_per_litre", "reference_price_gbp",
    "alcohol_units", "price_per_alcohol_unit_gbp",
    "discount_amount_gbp", "is_discounted", "discount_percent",
    "rating_stars", "review_count",
]
# Columns of the denormalised snapshot view.
SNAPSHOT_COLUMNS = [
    "snapshot_key", "full_date",
    "product_id", "name", "brand", "category", "region",
    "style_body", "style_richness", "style_smoke", "style_sweetness", "character_notes",
    "bottle_size_l", "bottle_size_cl", "bottle_size_band", "is_standard_bottle", "is_comparable_bottle",
    "abv_percent", "abv_band", "is_cask_strength",
    "age_years", "is_age_stated", "age_band",
    "is_price_outlier", "is_value_outlier", "is_outlier",
    "price_tier", "discount_band",
    *FACT_MEASURES,
]

def _declared(columns: list[str], decimals: dict, flags: list[str]) -> dict[str, str]:
    return {c: "decimal({},{})".format(*decimals[c]) if c in decimals else "boolean" if c in flags else "string" for c in columns}


# The types each star table is declared with, in column order.
STAR_TYPES = {
    "dim_date": {
        "date_key": "int", "full_date": "date", "year": "int", "month": "int", "day": "int", "week": "int", "day_name": "string",
    },
    "dim_price_tier": {"price_tier_key": "bigint", "price_tier": "string"},
    "dim_discount_band": {"discount_band_key": "bigint", "discount_band": "string"},
    "dim_product": {"product_key": "bigint", "product_id": "bigint"}
    | _declared(PRODUCT_ATTRIBUTES, PRODUCT_DECIMALS, PRODUCT_FLAGS),
    "fact_product_snapshot": {
        "snapshot_key": "string", "date_key": "int", "product_key": "bigint", "price_tier_key": "bigint",
        "discount_band_key": "bigint", "snapshot_ts": "timestamp_ntz",
    }
    | _declared(FACT_MEASURES, FACT_DECIMALS, FACT_FLAGS),
}
# The tables that are bucketed, and by what.
BUCKET_KEYS = {"dim_product": "product_key", "fact_product_snapshot": "product_key"}

# Columns the warehouse declares NOT NULL, per table.
NOT_NULL_COLUMNS = {
    "dim_date": ["date_key", "full_date"],
    "dim_price_tier": ["price_tier"],
    "dim_discount_band": ["discount_band"],
    "dim_product": ["product_id", "name"],
    "fact_product_snapshot": ["date_key", "product_key"],
}


def text_schema(columns: list[str]) -> T.StructType:
    """A schema of nullable text columns."""
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])
