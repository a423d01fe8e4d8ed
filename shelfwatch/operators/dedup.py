"""Duplicate removal and newest-row selection over snapshots."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwatch.operators.keyfilter import MOST_SLOTS, SLOTS, bit_filter, passes
from shelfwatch.session import materialise


def exact_dedup(df: DataFrame, time_column: str = "scraped_at") -> DataFrame:
    """One row per set of rows that agree on every column but the time.

    NULLs count as equal. The earliest time stays, standing in for "first in
    the file", an order Spark does not keep. Copies of one row are merged
    before the shuffle, so a hot set of copies costs one row per task.
    """
    others = [c for c in df.columns if c != time_column]
    return df.groupBy(*others).agg(F.min(time_column).alias(time_column)).select(*df.columns)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    tie_break: Sequence[str] = (),
    nulls: str = "last",
) -> DataFrame:
    """The newest row per key; rows with a NULL key form one group.

    Among equal times the largest ``tie_break`` columns win, then the largest
    remaining columns, so the answer never depends on the order of the input.
    ``nulls="first"`` lets an unreadable time win, the rule of the in-memory
    cleaning step; the default is the warehouse rule.

    The row is the maximum of a struct that starts with the time. As an
    aggregate it shrinks every key to one row inside each task before the
    shuffle, hot keys included, and sorts on the key alone. All columns of
    ``df`` take part, so select the needed ones first.
    """
    if nulls not in ("first", "last"):
        raise ValueError("nulls must be 'first' or 'last'")
    order = [time, *[c for c in tie_break if c != time]]
    rest = [c for c in df.columns if c not in order and c not in keys]
    unread = [F.col(time).isNull().alias("_unread")] if nulls == "first" else []
    newest = F.max(F.struct(*unread, *[F.col(c) for c in order], *[F.col(c) for c in rest])).alias("_row")
    picked = df.groupBy(*keys).agg(newest)
    return picked.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def _at_any(df: DataFrame, found: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """Rows whose key and time are among the written ``found``, and few others; nothing is shuffled."""
    slots = SLOTS
    while slots < min(16 * found.count(), MOST_SLOTS):
        slots *= 2
    pairs = found.select(F.xxhash64(*keys, time).alias("_at"))
    return df.where(passes(bit_filter(pairs, "_at", slots), F.xxhash64(*keys, time), slots))


def near_newest(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    nulls: str = "last",
    stage: Callable[[DataFrame, str], DataFrame] = materialise,
    read: DataFrame | None = None,
) -> DataFrame:
    """All rows that have the newest time of their key, and few others; for wide rows ahead of :func:`latest_per_key`.

    The newest time per key is found from the narrow columns alone, by hash. Only rows that
    pass a bitmap of the pairs of key and time go on, so that :func:`latest_per_key` does not
    sort every wide row of an input split. Reads ``df`` twice; its first read, for which
    ``read`` may stand in, needs the keys and the time only.
    """
    newest = F.max(time)
    if nulls == "first":
        newest = F.when(F.count_if(F.col(time).isNull()) == 0, newest)
    found = stage((df if read is None else read).groupBy(*keys).agg(newest.alias(time)), "newest")
    return _at_any(df, found, keys, time)


def newest_distinct(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    nulls: str = "last",
    stage: Callable[[DataFrame, str], DataFrame] = materialise,
    read: DataFrame | None = None,
    watch: Callable[[DataFrame], DataFrame] = lambda found: found,
) -> DataFrame:
    """:func:`exact_dedup`, then :func:`latest_per_key`, for wide rows: only those that can win are moved.

    Copies are found by key and a 128-bit hash of all columns but the time. The earliest time
    of each set of copies and the newest of those per key follow from these narrow rows;
    ``watch`` sees one for each set. The rows themselves are read again for the winners.
    """
    others = [c for c in df.columns if c != time]
    # Hashes skip NULLs, so which columns are NULL is hashed as well.
    gaps = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in others])
    halves = {f"_half_{i}": F.xxhash64(F.lit(i), gaps, *others) for i in (1, 2)}
    same = [*keys, *halves]
    narrow = (df if read is None else read).withColumns(halves).select(*same, time)
    sets = watch(narrow.groupBy(*same).agg(F.min(time).alias(time)))
    newest = F.col(time).desc_nulls_first() if nulls == "first" else F.col(time).desc_nulls_last()
    ranked = sets.withColumn("_rank", F.rank().over(W.partitionBy(*keys).orderBy(newest)))
    found = stage(ranked.where("_rank = 1").drop("_rank"), "newest")
    rows, won = _at_any(df, found, keys, time).withColumns(halves).alias("r"), found.alias("w")
    agree = [F.col(f"r.{c}").eqNullSafe(F.col(f"w.{c}")) for c in (*same, time)]
    return latest_per_key(rows.join(won, agree, "left_semi").select(*df.columns), keys, time, nulls=nulls)


#: Rows per group up to which the planner prunes a ranking inside each task by itself.
PLANNER_PRUNES = 1000
#: Parts that a group is ranked in first, beyond that.
RANKING_PARTS = 64


def top_per_group(
    df: DataFrame, groups: Sequence[str], order: Sequence[str | Column], n: int
) -> DataFrame:
    """The first ``n`` rows per group; a hot group is pruned before it meets in one task.

    Up to 1,000 rows the planner does that inside each task. Beyond, a group is first
    dealt into parts by its rows' values and each part ranked alone, so that the last
    task of a group sees ``n`` rows of each part at most.
    """
    ranking = W.partitionBy(*groups).orderBy(*order)
    if n > PLANNER_PRUNES:
        parted = df.withColumn("_part", F.pmod(F.xxhash64(*df.columns), F.lit(RANKING_PARTS)))
        inner = W.partitionBy(*groups, "_part").orderBy(*order)
        df = parted.withColumn("_rank", F.row_number().over(inner)).where(F.col("_rank") <= n).drop("_rank", "_part")
    return df.withColumn("_rank", F.row_number().over(ranking)).where(F.col("_rank") <= n).drop("_rank")


def dedup_snapshots(
    df: DataFrame,
    key: str = "product_id",
    time_column: str = "scraped_at",
    exact: bool = True,
    nulls: str = "last",
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Newest row per key, with or without exact dedup first.

    The two differ for a value that goes A, B, A: with ``exact`` the second A
    is a copy of the first and B is kept; without it the true newest A is.
    """
    rows = exact_dedup(df, time_column) if exact else df
    return latest_per_key(rows, [key], time_column, tie_break, nulls)
