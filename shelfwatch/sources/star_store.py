"""The star as declared, bucketed tables that a reload replaces all at once.

Every load writes tables of its own: with the declared column types, dimension and fact
bucketed and sorted by product key, so that joining them and finding the newest snapshot
per product need no exchange of the fact. When all are written and audited, one pointer
makes them current (:mod:`shelfwatch.sources.versions`). A reader resolves the pointer
once; during a reload it sees the old star, after it the new one, never a mixture. A load
that fails leaves the old star as it was.

A bucket is read by one task. Where a few products hold a large part of all snapshots,
:func:`bucket_rows` shows it; read such a star with ``spark.sql.sources.bucketing.enabled``
off, and Spark's skew join splits those products instead.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.plans import warehouse
from shelfwatch.schema import BUCKET_KEYS, STAR_TYPES
from shelfwatch.session import pack, passing_shuffles, passing_stages, sliced
from shelfwatch.sources import versions

#: Buckets of a small star.
BUCKETS = 64
#: Landing rows per bucket beyond that: a bucket is written, sorted and read by one task.
ROWS_PER_BUCKET = 500_000
#: Landing rows whose fact is dealt to its buckets at once; the shuffle files on disk are those of so many rows.
ROWS_AT_ONCE = 48_000_000
#: The tables that are written as they are built.
BUILT = {"dim-product": "dim_product", "fact": "fact_product_snapshot"}


class StarRefused(ValueError):
    """A table does not have the declared columns, or an audit found faults."""


def conform(df: DataFrame, name: str) -> DataFrame:
    """``df`` in declared column order; raises where a column is missing, surplus or of another type."""
    declared, found = STAR_TYPES[name], dict(df.dtypes)
    faults = [f"{c}: {found.get(c, 'absent')}, declared {t}" for c, t in declared.items() if found.get(c) != t]
    faults += [f"{c}: not declared" for c in found if c not in declared]
    if faults:
        raise StarRefused(f"{name}: " + "; ".join(faults))
    return df.select(*declared)


def _write(df: DataFrame, name: str, table: str, path: str, buckets: int, mode: str = "errorifexists") -> None:
    checked = conform(df, name)
    key = BUCKET_KEYS.get(name)
    if key is None:
        # Labels and dates, one file.
        checked.coalesce(1).write.option("path", path).saveAsTable(table, format="parquet", mode=mode)
        return
    # The same hash deals rows to tasks and to buckets: one file per bucket. The fact comes dealt.
    dealt = checked if name == "fact_product_snapshot" else checked.repartition(buckets, key)
    writer = dealt.write.bucketBy(buckets, key).sortBy(key).option("path", path).option("compression", "zstd")
    writer.saveAsTable(table, format="parquet", mode=mode)


def table_name(state: dict, name: str) -> str:
    return f"{state['database']}.{name}__{state['version']}"


def _register(spark: SparkSession, state: dict, name: str) -> str:
    """The catalog table of a published star; declared again where this catalog does not know it."""
    table = table_name(state, name)
    if not spark.catalog.tableExists(table):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {state['database']}")
        columns = ", ".join(f"{c} {t}" for c, t in STAR_TYPES[name].items())
        key = BUCKET_KEYS.get(name)
        buckets = f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {state['buckets']} BUCKETS " if key else ""
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {buckets}LOCATION '{state['paths'][name]}'")
    return table


def audit(star: dict[str, DataFrame]) -> list[str]:
    """What is wrong with a star: surplus keys, facts without dimension rows, NULLs where none may be."""
    unique = warehouse.audit_unique(star).where("surplus_rows > 0").selectExpr("table_name || '.' || key_name || ' repeats'")
    orphans = warehouse.audit_foreign_keys(star).where("orphan_rows > 0").selectExpr("dimension || ' lacks keys of the fact'")
    nulls = warehouse.audit_not_null(star).where("null_count > 0").selectExpr("table_name || '.' || column_name || ' holds NULL'")
    return [row[0] for part in (unique, orphans, nulls) for row in part.collect()]  # one row per declared key or column


def reload_star(
    spark: SparkSession, raw: DataFrame, root: str, database: str = "curated", buckets: int = BUCKETS, audited: bool = True,
    landed: bool = False,
) -> dict[str, DataFrame]:
    """Load the star of the landing rows ``raw`` and make it current; returns it.

    ``buckets`` is the least number of buckets; there are more where a bucket would get more
    than ``ROWS_PER_BUCKET`` rows. The fact moves once, to its buckets, and is written there;
    beyond ``ROWS_AT_ONCE`` rows some buckets after the others. ``landed`` tells that ``raw`` is
    read from files, which need no copy. What was staged on the way is deleted.

    Raises :class:`StarRefused` where a table does not conform or an audit finds a fault,
    and :class:`versions.ConcurrentPublish` where another reload was faster; the star
    that was current stays current then, and what was written is deleted.
    """
    before = versions.numbers(spark, root)
    number = before[-1] + 1 if before else 1
    version = f"v{number}_{uuid.uuid4().hex[:8]}"
    state = {
        "database": database, "version": version, "buckets": buckets,
        "paths": {name: f"{root}/{version}/{name}" for name in STAR_TYPES},
    }
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    slices = 1

    def buckets_for(landing: DataFrame) -> int:
        nonlocal slices
        rows = landing.count()
        state["buckets"] = max(buckets, -(-rows // ROWS_PER_BUCKET))
        slices = min(state["buckets"], -(-rows // ROWS_AT_ONCE))
        return state["buckets"]

    def write(df: DataFrame, name: str) -> DataFrame:
        key = BUCKET_KEYS.get(name)
        for part in sliced(df, slices if name == BUILT["fact"] else 1, key, state["buckets"]):
            _write(part, name, table_name(state, name), state["paths"][name], state["buckets"], "append")
        return spark.table(table_name(state, name))

    def stage(df: DataFrame, label: str) -> DataFrame:
        return write(df, BUILT[label]) if label in BUILT else pack(df, label)

    try:
        with passing_shuffles(spark), passing_stages(spark):
            staged = warehouse.build_star(raw, stage, buckets_for, landed)
            for name, df in staged.items():
                if name not in BUILT.values():
                    write(df, name)
        with passing_shuffles(spark), passing_stages(spark):
            star = _frames(spark, state)
            faults = audit(star) if audited else []
        if faults:
            raise StarRefused("; ".join(faults))
        versions.publish(spark, root, state, number)
    except Exception:
        _drop(spark, root, state)
        raise
    return star


def _frames(spark: SparkSession, state: dict) -> dict[str, DataFrame]:
    return {name: spark.table(_register(spark, state, name)) for name in STAR_TYPES}


def _drop(spark: SparkSession, root: str, state: dict) -> None:
    for name in STAR_TYPES:
        spark.sql(f"DROP TABLE IF EXISTS {table_name(state, name)}")
    versions.delete(spark, f"{root}/{state['version']}")


def read_star(spark: SparkSession, root: str, number: int | None = None) -> dict[str, DataFrame]:
    """The current star (or a given number), every table of one load."""
    state = versions.state(spark, root, number)
    if state is None:
        raise FileNotFoundError(f"no star below {root}")
    return _frames(spark, state)


def loads_together(spark: SparkSession, root: str, name: str, numbers: list[int]) -> DataFrame:
    """A bucketed table as several loads wrote it, with the number of the ``load``, as one table over their files.

    A bucket of all loads is read by one task, so rows are compared between loads without a
    shuffle. Loads with different numbers of buckets are appended to each other instead.
    """
    states = [versions.state(spark, root, number) for number in numbers]
    if len({state["buckets"] for state in states}) > 1:
        frames = [read_star(spark, root, n)[name].withColumn("load", F.lit(n)) for n in numbers]
        return reduce(DataFrame.unionByName, frames)
    key, buckets = BUCKET_KEYS[name], states[0]["buckets"]
    table = f"{states[0]['database']}.{name}__loads_{uuid.uuid4().hex[:8]}"
    columns = ", ".join(f"{c} {t}" for c, t in STAR_TYPES[name].items())
    spark.sql(
        f"CREATE TABLE {table} ({columns}, load int) USING parquet PARTITIONED BY (load)"
        f" CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{root}/_{table.rsplit('.', 1)[1]}'"
    )
    for number, state in zip(numbers, states, strict=True):
        spark.sql(f"ALTER TABLE {table} ADD PARTITION (load={number}) LOCATION '{state['paths'][name]}'")
    return spark.table(table)


def drop_old(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete all but the newest ``keep`` loads, once no reader uses them; returns how many went."""
    old = versions.forget(spark, root, keep)
    for state in old:
        _drop(spark, root, state)
    return len(old)


def bucket_rows(star: dict[str, DataFrame], buckets: int = BUCKETS) -> DataFrame:
    """``bucket, row_count`` of the fact, largest first: how evenly its buckets are filled."""
    # The hash that also deals rows to buckets.
    bucket = F.pmod(F.hash("product_key"), F.lit(buckets)).alias("bucket")
    return star["fact_product_snapshot"].groupBy(bucket).agg(F.count("*").alias("row_count")).orderBy(F.desc("row_count"), "bucket")
