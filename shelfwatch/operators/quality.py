"""Integrity audits, profiles and run counters."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.operators.normalise import unpivot_counts
from shelfwatch.session import materialise


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).where("row_count > 1")


def uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: is the key unique, how many distinct keys, how many surplus rows."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.max("n") <= 1, F.lit(True)).alias("is_unique"),
        F.count("*").alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("surplus_rows"),
    )


def long_key_uniqueness(
    df: DataFrame, key: str, stage: Callable[[DataFrame, str], DataFrame] = materialise
) -> DataFrame:
    """:func:`uniqueness` of a long key that hardly ever repeats; only hashes of it are moved.

    A hash that comes once is a key that comes once. Hashes that come again are written, and
    the keys of their rows are counted themselves, so two keys with one hash are two keys.
    """
    hashed = df.select(F.xxhash64(key).alias("_hash"), key)
    repeated = stage(hashed.groupBy("_hash").agg(F.count("*").alias("n")).where("n > 1"), "repeated")
    again = hashed.join(repeated.select("_hash"), "_hash", "left_semi").groupBy(key).agg(F.count("*").alias("n"))
    none = F.lit(0).cast("bigint").alias("surplus")
    counts = (
        df.agg(F.count("*").alias("keys"), none)
        .unionByName(repeated.agg((-F.sum("n")).alias("keys"), none))
        .unionByName(again.agg(F.count("*").alias("keys"), F.sum(F.col("n") - 1).alias("surplus")))
    )
    return counts.agg(
        (F.coalesce(F.sum("surplus"), F.lit(0)) == 0).alias("is_unique"),
        F.sum("keys").cast("bigint").alias("distinct_keys"),
        F.coalesce(F.sum("surplus"), F.lit(0)).cast("bigint").alias("surplus_rows"),
    )


def orphan_keys(child: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None) -> DataFrame:
    """Non-NULL child keys without a parent row, with their row count.

    The child is counted per key first, so a hot key reaches the join as one
    row. ``count`` of the key is 0 for the NULL group and drops it; a NULL
    filter would be pushed down and recompute a derived key per row.

    The parents are merged in sorted order and never broadcast. Spark would take their size
    from the packed files and the share of one column, a hundredth of what millions of keys
    need in the driver's memory.
    """
    parents = parent.select(F.col(parent_key or key).alias(key)).hint("merge")
    counted = child.groupBy(key).agg(F.count(key).alias("row_count")).where("row_count > 0")
    return counted.join(parents, key, "left_anti")


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, null_count) for each column, in one pass."""
    columns = list(columns or df.columns)
    return unpivot_counts(df.agg(*[(F.count("*") - F.count(c)).alias(c) for c in columns]), "null_count")


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL count of columns that must hold none."""
    return null_counts(df, columns)


def null_profile(df: DataFrame) -> DataFrame:
    """Columns that hold NULLs, most NULLs first."""
    return null_counts(df).where("null_count > 0").orderBy(F.desc("null_count"), "column_name")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, NULL included, most frequent first."""
    return (
        df.groupBy(column).agg(F.count("*").alias("row_count")).orderBy(F.desc("row_count"), F.col(column).asc_nulls_first())
    )


def constant_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Which of ``columns`` hold at most one value, NULL counted as a value.

    Runs one aggregate. Equal minimum and maximum show a single value without
    a distinct count.
    """
    row = df.agg(
        F.count("*").alias("_rows"),
        *[F.min(c).alias(f"min_{c}") for c in columns],
        *[F.max(c).alias(f"max_{c}") for c in columns],
        *[F.count(c).alias(f"n_{c}") for c in columns],
    ).first()
    return [
        c
        for c in columns
        if row[f"n_{c}"] == 0 or (row[f"n_{c}"] == row["_rows"] and row[f"min_{c}"] == row[f"max_{c}"])
    ]


def drop_constant_columns(df: DataFrame, columns: Sequence[str] = ("status",)) -> DataFrame:
    """Drop the given columns where they carry no information; runs one aggregate."""
    present = [c for c in columns if c in df.columns]
    return df.drop(*constant_columns(df, present)) if present else df


def prune_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*[c for c in columns if c in df.columns])


def leftover_helpers(df: DataFrame) -> list[str]:
    """Names that look like helper columns and should not reach a sink."""
    return [c for c in df.columns if "_calc_" in c or c.endswith("_raw")]


def load_check(df: DataFrame, rows: int = 10) -> tuple[int, DataFrame]:
    """Row count (one action) and a small preview."""
    return df.count(), df.limit(rows)


def run_summary(df: DataFrame) -> DataFrame:
    """Headline counters as one row."""
    return df.agg(
        F.count("*").alias("row_count"),
        F.count_if("is_discounted").alias("discounted"),
        F.count_if(F.col("price_inc_vat_gbp").isNull()).alias("without_price"),
    )
