"""Product snapshots out of retail order tables.

A part is a product, an order line is one snapshot of it and the supplier's
region is its region. The mapping gives the queries real tables to run on.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.operators import features
from shelfwatch.operators.dedup import latest_per_key
from shelfwatch.plans.warehouse import to_landing
from shelfwatch.schema import FACT_DECIMALS, PRODUCT_DECIMALS, RAW_COLUMNS

# Newest first; with the product id this order has no ties.
LINE_ORDER = ["l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def latest_lines(lines: DataFrame) -> DataFrame:
    """The newest order line per part, with the columns a snapshot is made of."""
    lines = lines.select("l_partkey", "l_shipdate", *LINE_ORDER, "l_suppkey", "l_discount", "l_tax")
    return latest_per_key(lines, ["l_partkey"], "l_shipdate", LINE_ORDER)


def _with_parents(spark: SparkSession, folder: str, lines: DataFrame, by_part: bool = False) -> DataFrame:
    """Lines with part and region.

    One table at a time, so that Spark sees the size of each and broadcasts
    those that are small without moving the lines. The part comes last, as its texts
    would make a move by supplier a wide one; it comes first where the lines
    lie ``by_part`` already and need no move to it.
    """
    part = [("part", "l_partkey", "p_partkey")]
    region = [
        ("supplier", "l_suppkey", "s_suppkey"),
        ("nation", "s_nationkey", "n_nationkey"),
        ("region", "n_regionkey", "r_regionkey"),
    ]
    for name, child, parent in part + region if by_part else region + part:
        lines = lines.join(table(spark, folder, name), F.col(child) == F.col(parent))
    return lines


def list_price() -> Column:
    """A money amount: a fixed share of the line's price in exact decimals."""
    factor = F.lit(Decimal("0.002")).cast("decimal(4,3)")
    return F.round(F.col("l_extendedprice").cast("decimal(12,2)") * factor, 2).cast("decimal(10,2)")


def sale_price() -> Column:
    share = F.lit(1) - F.lit(5) * F.col("l_discount").cast("decimal(4,2)")
    return F.round(list_price() * share, 2).cast("decimal(10,2)")


def _mapped(lines: DataFrame) -> DataFrame:
    size = (F.col("p_size").cast("double") / F.lit(50.0)).cast("decimal(10,3)").cast("double")
    mapped = lines.select(
        F.col("l_shipdate").alias("scraped_at"),
        F.col("l_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"),
        F.col("r_name").alias("region"),
        list_price().cast("double").alias("price_before_discount_gbp"),
        sale_price().cast("double").alias("price_inc_vat_gbp"),
        size.alias("bottle_size_l"),
        (F.lit(38) + F.col("p_partkey") % 20).cast("double").alias("abv_percent"),
        F.nullif(F.col("p_partkey") % 36, F.lit(0)).alias("age_years"),
        (F.lit(3) + F.col("l_tax") * 25).cast("decimal(4,2)").alias("rating_stars"),
        (F.col("l_quantity") * 10).cast("bigint").alias("review_count"),
        *LINE_ORDER,
    )
    return (
        mapped.transform(features.price_features)
        .transform(features.discount_features)
        .transform(features.band_features)
    )


def _warehouse_types(df: DataFrame) -> DataFrame:
    decimals = PRODUCT_DECIMALS | FACT_DECIMALS
    return df.select(
        *[F.col(c).try_cast("decimal({},{})".format(*decimals[c])).alias(c) if c in decimals else F.col(c) for c in df.columns]
    )


def snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Every snapshot with its derived columns, as doubles."""
    return _mapped(_with_parents(spark, folder, table(spark, folder, "lineitem")))


def latest_products(spark: SparkSession, folder: str) -> DataFrame:
    """The latest snapshot per product in warehouse types.

    The newest line is chosen first, so that the joins and the derived columns
    see one row per product.
    """
    lines = latest_lines(table(spark, folder, "lineitem"))
    return _warehouse_types(_mapped(_with_parents(spark, folder, lines, by_part=True))).drop(*LINE_ORDER)


def landing_rows(spark: SparkSession, folder: str) -> DataFrame:
    """All snapshots as all-text landing rows, ready for the star load."""
    return to_landing(snapshots(spark, folder))


# -- text columns for the parsing operators --------------------------------------------------


def part_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Free texts of a product, with gaps, odd units and zero quantities."""
    return table(spark, folder, "part").select(
        "p_partkey", "p_size", "p_brand", "p_type", "p_retailprice",
        F.expr(NAME_TEXT).alias("name"),
        F.expr(VARIANT_TEXT).alias("variant"),
        F.expr(UNIT_PRICE_TEXT).alias("unit_price_raw"),
    )


NAME_TEXT = "p_name || CASE WHEN p_partkey % 3 = 0 THEN '' ELSE ' ' || CAST(p_size AS STRING) || ' Year Old' END"
VARIANT_TEXT = (
    "CASE p_partkey % 4 WHEN 0 THEN CAST(p_size*2 AS STRING)||'cl / ' WHEN 1 THEN CAST(p_size*20 AS STRING)||'ml / '"
    " WHEN 2 THEN CAST(p_size*2 AS STRING)||'CL / ' ELSE '' END || CAST(38+p_partkey%20 AS STRING) || '%'"
)
UNIT_PRICE_TEXT = (
    "CASE p_partkey % 4 WHEN 0 THEN '£'||CAST(p_size AS STRING)||'.50 per 70cl'"
    " WHEN 1 THEN '(£1,0'||CAST(p_size+10 AS STRING)||'.00 per litre)' WHEN 2 THEN '£9 per 0cl' ELSE 'n/a' END"
)
BRAND_TEXT = (
    "CASE p_partkey % 6 WHEN 0 THEN 'chivas' WHEN 1 THEN '  Chivas   Regal ' WHEN 2 THEN 'Secret  Distillery'"
    " WHEN 3 THEN 'None' ELSE ' '||p_brand||'  Co ' END"
)
CATEGORY_TEXT = (
    "CASE p_type WHEN 'STANDARD' THEN ' Single Malt ' WHEN 'ECONOMY' THEN 'Blended' WHEN 'PROMO' THEN 'N/A' ELSE p_type END"
)
REGION_TEXT = (
    "CASE l_suppkey % 6 WHEN 0 THEN 'Islay' WHEN 1 THEN 'The Islands' WHEN 2 THEN ' HIGHLAND ' WHEN 3 THEN 'N/A'"
    " WHEN 4 THEN 'Somewhere Else' ELSE 'null' END"
)
FACT_REGION_TEXT = "CASE l_linenumber % 4 WHEN 0 THEN 'Speyside' WHEN 1 THEN 'islands' WHEN 2 THEN 'the highlands' ELSE '' END"
NOTES_TEXT = "CASE p_partkey % 3 WHEN 0 THEN 'Malt |  Peat|Smoke' WHEN 1 THEN '| Oak | ' ELSE ' NA ' END"

# One text expression per raw column; both engines of the tests read them.
RAW_TEXTS = {
    "scraped_at": "CASE WHEN l_linenumber = 7 AND l_quantity < 3 THEN 'unknown' ELSE CAST(l_shipdate AS STRING) END",
    "category": CATEGORY_TEXT,
    "product_id": "CAST(l_partkey AS STRING) || CASE WHEN l_linenumber = 5 THEN '.0' ELSE '' END",
    "name": NAME_TEXT,
    "brand": BRAND_TEXT,
    "variant": VARIANT_TEXT,
    "price_ex_vat_gbp": "CAST(CAST(ROUND(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(0.002 AS DECIMAL(4,3)), 2) AS DECIMAL(10,2)) AS STRING)",
    "unit_price_raw": UNIT_PRICE_TEXT,
    "region": REGION_TEXT,
    "promo_label": "''",
    "status": "'In Stock'",
    "product_url": "'https://shop.example/p/' || CAST(l_partkey AS STRING) || '/'",
    "image_url": "'nan'",
    "rating_stars": "CASE WHEN l_linenumber = 3 THEN 'n/a' ELSE CAST(CAST(3 + l_tax * 25 AS DECIMAL(4,2)) AS STRING) END",
    "review_count": "CASE l_linenumber WHEN 2 THEN '' WHEN 4 THEN '12.5' ELSE CAST(CAST(l_quantity * 10 AS BIGINT) AS STRING) END",
    "price_inc_vat_gbp": (
        "CASE WHEN l_linenumber % 3 = 0 THEN 'tbc' ELSE CAST(CAST(ROUND(CAST(l_extendedprice AS DECIMAL(12,2))"
        " * CAST(0.0025 AS DECIMAL(5,4)), 2) AS DECIMAL(10,2)) AS STRING) END"
    ),
    "price_before_discount_gbp": (
        "CASE WHEN l_discount < 0.03 THEN '' ELSE CAST(CAST(ROUND(CAST(l_extendedprice AS DECIMAL(12,2))"
        " * CAST(0.0031 AS DECIMAL(5,4)), 2) AS DECIMAL(10,2)) AS STRING) END"
    ),
    "style_body": "CAST(p_size % 11 AS STRING)",
    "style_richness": "CAST(p_size % 11 AS STRING) || '.0'",
    "style_smoke": "'none'",
    "style_sweetness": "''",
    "character_notes": NOTES_TEXT,
    "fact_bottler": "'Distillery Bottling'",
    "fact_country": "' Scotland '",
    "fact_region": FACT_REGION_TEXT,
    "fact_cask_type": "'undefined'",
    "fact_colouring": "'No'",
}


# Raw columns whose text is made of the part alone.
PART_COLUMNS = [
    "category", "name", "brand", "variant", "unit_price_raw", "style_body", "style_richness", "character_notes",
]


def raw_records(spark: SparkSession, folder: str) -> DataFrame:
    """Raw all-text product records, one per order line.

    Texts of the part are made once per part, ahead of the join; that also
    keeps the method generated for the lines small enough to be compiled.
    """
    lines, part = table(spark, folder, "lineitem"), table(spark, folder, "part")
    parts = part.select("p_partkey", *[F.expr(RAW_TEXTS[c]).alias(c) for c in PART_COLUMNS])
    joined = lines.join(parts, lines.l_partkey == parts.p_partkey)
    return joined.select(*[F.col(c) if c in PART_COLUMNS else F.expr(RAW_TEXTS[c]).alias(c) for c in RAW_COLUMNS])
