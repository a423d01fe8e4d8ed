"""Star schema: landing rows to dimensions and snapshot fact, and the views over them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwatch.functions.dates import calendar_parts, date_key, to_time
from shelfwatch.functions.numeric import to_decimal, to_key
from shelfwatch.functions.text import text_flag
from shelfwatch.operators.dedup import latest_per_key, near_newest
from shelfwatch.operators.quality import long_key_uniqueness, not_null_violations, orphan_keys, uniqueness
from shelfwatch.schema import (
    CLEAN_COLUMNS,
    FACT_DECIMALS,
    FACT_FLAGS,
    FACT_MEASURES,
    NOT_NULL_COLUMNS,
    PRODUCT_ATTRIBUTES,
    PRODUCT_DECIMALS,
    PRODUCT_FLAGS,
    SNAPSHOT_COLUMNS,
)
from shelfwatch.session import materialise


def to_landing(df: DataFrame) -> DataFrame:
    """All-text landing rows, matched by column name in any case; absent columns are NULL."""
    by_name = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (F.col(by_name[c]) if c in by_name else F.lit(None)).cast("string").alias(c)
            for c in CLEAN_COLUMNS
        ]
    )


def _typed(column: str, decimals: dict, flags: list[str]) -> Column:
    if column in decimals:
        return to_decimal(F.col(column), *decimals[column]).alias(column)
    if column in flags:
        return text_flag(F.col(column)).alias(column)
    return F.col(column)


def _scrape_date() -> Column:
    return F.to_date(to_time(F.col("scraped_at")))


def load_dim_date(raw: DataFrame) -> DataFrame:
    """One row per scrape date."""
    return _dim_date(raw.select(_scrape_date().alias("full_date")))


def _dim_date(days: DataFrame) -> DataFrame:
    distinct = days.select("full_date").where("full_date IS NOT NULL").distinct()
    return distinct.select(*calendar_parts(F.col("full_date")))


def load_dim_label(raw: DataFrame, label: str) -> DataFrame:
    """Numbered distinct labels; the numbering runs after the distinct, over a handful of rows.

    NULL is numbered last and dropped after the numbering. A filter ahead of it
    would be pushed below the distinct and compute the label a second time for
    every landing row.
    """
    distinct = raw.select(label).distinct()
    number = F.row_number().over(W.orderBy(F.col(label).asc_nulls_last())).cast("bigint")
    return distinct.select(number.alias(f"{label}_key"), label).where(F.col(label).isNotNull())


def load_dim_product(raw: DataFrame, stage: Callable[[DataFrame, str], DataFrame] = materialise) -> DataFrame:
    """Newest record per numeric product id, typed (type-1 history).

    The key is the parsed id itself: unique by construction and stable over
    reloads, where a 64-bit hash would start to collide near a billion products
    and a global numbering would need one task.
    """
    rows = near_newest(identified(raw), ["product_key"], "scraped_at", stage=stage)
    newest = latest_per_key(rows, ["product_key"], "scraped_at", PRODUCT_ATTRIBUTES)
    return typed_products(newest)


def identified(raw: DataFrame) -> DataFrame:
    """Time, parsed id and attributes of the landing rows with a readable id."""
    return raw.select(
        to_time(F.col("scraped_at")).alias("scraped_at"),
        to_key(F.col("product_id")).alias("product_key"),
        *PRODUCT_ATTRIBUTES,
    ).where("product_key IS NOT NULL")


def typed_products(newest: DataFrame) -> DataFrame:
    """The product dimension of the newest identified rows."""
    return newest.select(
        "product_key",
        F.col("product_key").alias("product_id"),
        *[_typed(c, PRODUCT_DECIMALS, PRODUCT_FLAGS) for c in PRODUCT_ATTRIBUTES],
    )


def _measured(
    raw: DataFrame, dim_price_tier: DataFrame, dim_discount_band: DataFrame, dim_product: DataFrame | None
) -> DataFrame:
    """The fact's columns but its key, and the two labels."""
    rows = (
        raw.withColumn("snapshot_ts", to_time(F.col("scraped_at")))
        .withColumn("product_key", to_key(F.col("product_id")))
        .where("snapshot_ts IS NOT NULL AND product_key IS NOT NULL")
    )
    if dim_product is not None:
        rows = rows.join(dim_product.select("product_key"), "product_key", "left_semi")
    looked_up = rows.join(dim_price_tier, "price_tier", "left").join(dim_discount_band, "discount_band", "left")
    return looked_up.select(
        date_key(F.to_date("snapshot_ts")).alias("date_key"),
        "product_key",
        "price_tier_key",
        "discount_band_key",
        "snapshot_ts",
        *[_typed(c, FACT_DECIMALS, FACT_FLAGS) for c in FACT_MEASURES],
        "price_tier",
        "discount_band",
    )


def fact_rows(
    raw: DataFrame,
    dim_price_tier: DataFrame,
    dim_discount_band: DataFrame,
    dim_product: DataFrame | None = None,
) -> DataFrame:
    """The fact without its key, for readers that do not need one."""
    return _measured(raw, dim_price_tier, dim_discount_band, dim_product).drop("price_tier", "discount_band")


#: Rows that one step of :func:`_repeated` makes at once.
REPEATS_AT_ONCE = 1 << 16


def _repeated(counted: DataFrame) -> DataFrame:
    """Every row ``_n`` times, with its place ``_nth``; in two steps, so that no array grows with ``_n``."""
    parts = counted.withColumn("_part", F.explode(F.expr(f"sequence(0L, (_n - 1) div {REPEATS_AT_ONCE})")))
    first, last = f"_part * {REPEATS_AT_ONCE}L + 1", f"least((_part + 1) * {REPEATS_AT_ONCE}L, _n)"
    return parts.withColumn("_nth", F.explode(F.expr(f"sequence({first}, {last})")))


def load_fact(
    raw: DataFrame,
    dim_price_tier: DataFrame,
    dim_discount_band: DataFrame,
    dim_product: DataFrame | None = None,
    arrival: int = 0,
    buckets: int | None = None,
) -> DataFrame:
    """One row per landing row with a readable time and id.

    The product key follows from the id, so the lookup join is only needed when
    ``dim_product`` comes from other landing rows. The label dimensions are a
    few rows that Spark broadcasts by their size.

    ``snapshot_key`` is a digest (128 bits, as hex) of what the row says, its place among
    rows that say the same, and the number of the ``arrival`` it came with. So it is the same
    after every reload, in whatever order the rows come; :func:`audit_unique` would show a
    collision. Equal rows are counted and not ranked.

    Nearly all rows differ. They are dealt out first and counted where they arrive, because
    counting them in each input split as well would hold the whole split and shrink nothing.
    With ``buckets`` they are dealt by product key into that many parts and stay there, ready
    to be written as buckets.
    """
    rows = _measured(raw, dim_price_tier, dim_discount_band, dim_product)
    rows = rows.repartition(*rows.columns) if buckets is None else rows.repartition(buckets, "product_key")
    each = _repeated(rows.groupBy(*rows.columns).agg(F.count("*").alias("_n")))
    said = ["product_key", "snapshot_ts", "price_tier", "discount_band", *FACT_MEASURES, "_nth"]
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in said]
    key = F.md5(F.concat_ws("|", *texts, F.lit(str(arrival))))
    return each.select(key.alias("snapshot_key"), *rows.drop("price_tier", "discount_band").columns)


def small_dimensions(
    raw: DataFrame, stage: Callable[[DataFrame, str], DataFrame] = materialise
) -> dict[str, DataFrame]:
    """The date and label dimensions.

    One pass finds the combinations of date and labels, a few per date, and
    writes them. The dimensions follow from that small file, so Spark knows
    they are small and broadcasts them; a side computed from the landing rows
    would make it shuffle the fact on a key with a handful of values.
    """
    labels = ["price_tier", "discount_band"]
    found = stage(raw.select(_scrape_date().alias("full_date"), *labels).distinct(), "labels")
    return {
        "dim_date": _dim_date(found),
        "dim_price_tier": load_dim_label(found, "price_tier"),
        "dim_discount_band": load_dim_label(found, "discount_band"),
    }


STAR_COLUMNS = list(
    dict.fromkeys(["scraped_at", "product_id", "price_tier", "discount_band", *PRODUCT_ATTRIBUTES, *FACT_MEASURES])
)


def build_star(
    raw: DataFrame,
    stage: Callable[[DataFrame, str], DataFrame] = materialise,
    buckets_for: Callable[[DataFrame], int] | None = None,
    landed: bool = False,
) -> dict[str, DataFrame]:
    """Dimensions and fact over the same landing rows.

    The landing rows are written once (not again if they are read from files: ``landed``), as the columns that the star reads, and read three
    times with pruned columns. The product dimension is written before the fact meets it:
    joined as a table it is broadcast when small, and when large Spark may split the
    partition of a hot product. The fact is written too, which fixes its keys;
    ``buckets_for`` tells from the written landing rows into how many buckets.
    """
    landing = raw.select(*STAR_COLUMNS)
    landing = landing if landed else stage(landing, "landing")
    buckets = buckets_for(landing) if buckets_for else None
    star = small_dimensions(landing, stage)
    star["dim_product"] = stage(load_dim_product(landing, stage), "dim-product")
    star["fact_product_snapshot"] = stage(
        load_fact(landing, star["dim_price_tier"], star["dim_discount_band"], buckets=buckets), "fact"
    )
    return star


def product_snapshot(star: dict[str, DataFrame]) -> DataFrame:
    """Denormalised snapshots; product attributes are today's, whatever the snapshot's age."""
    return star_join(star["fact_product_snapshot"], star)


def star_join(fact: DataFrame, star: dict[str, DataFrame], newest: bool = False) -> DataFrame:
    """Some rows of the fact with the columns of their dimensions.

    With ``newest`` the fact has one row per product, so the product dimension is no smaller
    and is merged with it in sorted order. Left to choose, Spark would broadcast millions of
    products: it takes their size from the packed files and the share of the columns read.
    """
    products = star["dim_product"].hint("merge") if newest else star["dim_product"]
    joined = (
        fact.join(star["dim_date"].select("date_key", "full_date"), "date_key")
        .join(products, "product_key")
        .join(star["dim_price_tier"], "price_tier_key", "left")
        .join(star["dim_discount_band"], "discount_band_key", "left")
    )
    return joined.select(*SNAPSHOT_COLUMNS, "snapshot_ts")


def latest_of(snapshot: DataFrame) -> DataFrame:
    """Newest snapshot per product of the denormalised view; equal times are settled by the measures."""
    return latest_per_key(snapshot, ["product_id"], "full_date", ["snapshot_ts", *FACT_MEASURES])


def product_latest(star: dict[str, DataFrame], near: bool = False) -> DataFrame:
    """The same rows with the newest fact chosen before the star join.

    ``near`` looks for the newest dates first, by narrow columns: for a fact that does not lie
    in buckets of products, where all its rows would be moved.

    Equal to :func:`latest_of` as long as every fact has its date and product,
    which :func:`audit` checks. The wide join then sees one row per product.
    """
    fact = star["fact_product_snapshot"]
    fact = near_newest(fact, ["product_key"], "date_key") if near else fact
    newest = latest_per_key(fact, ["product_key"], "date_key", ["snapshot_ts", *FACT_MEASURES])
    return star_join(newest, star, newest=True)


# Primary, unique and foreign keys of the star.
UNIQUE_KEYS = [
    ("dim_date", ["date_key"]),
    ("dim_price_tier", ["price_tier_key"]),
    ("dim_price_tier", ["price_tier"]),
    ("dim_discount_band", ["discount_band_key"]),
    ("dim_discount_band", ["discount_band"]),
    ("dim_product", ["product_key"]),
    ("dim_product", ["product_id"]),
    ("fact_product_snapshot", ["snapshot_key"]),
]
FOREIGN_KEYS = [
    ("date_key", "dim_date"),
    ("product_key", "dim_product"),
    ("price_tier_key", "dim_price_tier"),
    ("discount_band_key", "dim_discount_band"),
]


def audit_unique(star: dict[str, DataFrame]) -> DataFrame:
    """Surplus rows per declared key."""
    checks = [
        (long_key_uniqueness(star[table], *keys) if keys == ["snapshot_key"] else uniqueness(star[table], keys)).select(
            F.lit(table).alias("table_name"), F.lit(",".join(keys)).alias("key_name"), "is_unique", "surplus_rows"
        )
        for table, keys in UNIQUE_KEYS
    ]
    return _union(checks)


def audit_foreign_keys(star: dict[str, DataFrame]) -> DataFrame:
    """Fact rows per foreign key that point to no dimension row; a NULL key points to none and is no orphan.

    Every key is counted alone, in each task before the shuffle, so that what moves is a row
    per value and task. Counted by all keys at once nearly every fact row would be a group.
    """
    fact = star["fact_product_snapshot"]
    checks = [
        orphan_keys(fact, key, star[table]).agg(
            F.lit(table).alias("dimension"), F.coalesce(F.sum("row_count"), F.lit(0)).cast("bigint").alias("orphan_rows")
        )
        for key, table in FOREIGN_KEYS
    ]
    return _union(checks)


def audit_not_null(star: dict[str, DataFrame]) -> DataFrame:
    """NULLs per column that is declared NOT NULL."""
    checks = [
        not_null_violations(star[table], columns).select(F.lit(table).alias("table_name"), "column_name", "null_count")
        for table, columns in NOT_NULL_COLUMNS.items()
    ]
    return _union(checks)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
