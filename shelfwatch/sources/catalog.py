"""Catalog layers: databases, landing table, star tables, views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwatch.plans import analytics, warehouse
from shelfwatch.schema import CLEAN_COLUMNS, text_schema
from shelfwatch.session import pack, passing_shuffles, passing_stages, sliced
from shelfwatch.sources.star_store import ROWS_AT_ONCE

LAYERS = ["raw", "stage", "curated"]
LANDING_TABLE = "raw.products"


def create_layers(spark: SparkSession, layers: list[str] | None = None) -> None:
    for name in layers or LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def recreate_landing(spark: SparkSession, table: str = LANDING_TABLE) -> None:
    """An empty all-text landing table, replacing any earlier one."""
    empty = spark.createDataFrame([], text_schema(CLEAN_COLUMNS))
    empty.write.mode("overwrite").saveAsTable(table)


def write_star(
    spark: SparkSession, raw: DataFrame, database: str = "curated", by_date: bool = True, landed: bool = False
) -> dict[str, DataFrame]:
    """Full reload of the star: every table is replaced, then read back.

    The landing rows are written once (not again if they are read from files: ``landed``), and
    dimensions go first, so that the fact meets keys that are written once. The
    fact is laid out by date unless ``by_date`` is off; ``rebalance`` splits a date
    that holds too many rows for one task. Beyond ``ROWS_AT_ONCE`` rows it is dealt and
    written some products after the others. What was staged on the way is deleted.
    """
    tables = {}
    with passing_shuffles(spark), passing_stages(spark):
        landing = raw.select(*warehouse.STAR_COLUMNS)
        landing = landing if landed else pack(landing, "landing")
        star = warehouse.small_dimensions(landing, pack) | {"dim_product": warehouse.load_dim_product(landing, pack)}
        for name in ["dim_date", "dim_price_tier", "dim_discount_band", "dim_product"]:
            star[name].write.mode("overwrite").saveAsTable(f"{database}.{name}")
            tables[name] = spark.table(f"{database}.{name}")
        name = "fact_product_snapshot"
        fact = warehouse.load_fact(landing, tables["dim_price_tier"], tables["dim_discount_band"])
        slices = -(-landing.count() // ROWS_AT_ONCE)
        for i, part in enumerate(sliced(fact, slices, "product_key")):
            if by_date:
                writer = part.hint("rebalance", "date_key").write.partitionBy("date_key")
            else:
                writer = part.write  # it comes dealt over all tasks
            writer.mode("append" if i else "overwrite").option("compression", "zstd").saveAsTable(f"{database}.{name}")
    tables[name] = spark.table(f"{database}.{name}")
    return tables


def create_views(star: dict[str, DataFrame], latest: DataFrame | None = None, prefix: str = "") -> None:
    """Temporary views for SQL users: the star tables, all snapshots, the latest ones, the derived reports.

    Pass the published ``latest`` table, so that the reports read one row per
    product instead of finding it again in the fact.
    """
    latest = warehouse.product_latest(star) if latest is None else latest
    views = star | {
        "product_snapshot": warehouse.product_snapshot(star),
        "product_latest": latest,
        "top_ratings": analytics.top_ratings(latest),
        "price_premium": analytics.price_premium(latest),
        "age_roi": analytics.age_roi(latest),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(f"{prefix}{name}")


def publish_latest(spark: SparkSession, star: dict[str, DataFrame], table: str = "curated.product_latest") -> DataFrame:
    """The latest snapshots as a table, for the queries and dashboards that share them."""
    with passing_shuffles(spark), passing_stages(spark):
        warehouse.product_latest(star, near=True).write.mode("overwrite").saveAsTable(table)
    return spark.table(table)
