"""Incremental load of arriving snapshot files into the star; the cost follows the batch.

The store below a root folder holds

* ``fact/batch_id=N``: the fact rows of micro-batch N, only ever appended;
* keyed tables (``products``, ``latest``): the newest row per product, dealt by the hash of
  the key into a fixed number of parts. A batch reads and rewrites only the parts that its
  products fall into; every rewrite is a folder of its own, ``<table>/batch_id=N/part=P``;
* the ledger: one pointer file per batch (:mod:`shelfwatch.sources.versions`), which names
  the last batch, the folder that is current for every part, the keys of the labels and the
  dates seen so far.

A batch counts once its pointer is renamed into place. A batch that fails before that and
runs again overwrites its own folders, one that runs again after it changes nothing, and a
reader resolves the ledger once and never sees half a batch. The newest row is the maximum
of a struct, so merging it batch by batch gives what one load of all files gives.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch.functions.dates import calendar_parts, to_time
from shelfwatch.operators.dedup import latest_per_key, near_newest
from shelfwatch.plans import warehouse
from shelfwatch.schema import FACT_MEASURES, PRODUCT_ATTRIBUTES, STAR_TYPES
from shelfwatch.session import materialise, pack, passing_shuffles, passing_stages, sliced
from shelfwatch.sources import versions
from shelfwatch.sources.star_store import ROWS_AT_ONCE

#: Parts of a keyed table; choose it so that a part is some hundred megabytes at the size the store will have.
PARTS = 64
LABELS = ["price_tier", "discount_band"]
#: Different labels and dates that the ledger holds at most.
MOST_LISTED = 100_000

# Keyed tables: key, time and the columns that settle equal times, newest first.
KEYED = {
    "products": ("product_key", "scraped_at", PRODUCT_ATTRIBUTES),
    "latest": ("product_key", "date_key", ["snapshot_ts", *FACT_MEASURES]),
}


def _part(key: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def _empty(parts: int) -> dict:
    return {"batch": -1, "parts": parts, "dates": [], "labels": {c: [] for c in LABELS}, "folders": {t: {} for t in KEYED}}


def _listed(rows: DataFrame, column: str, known: Sequence) -> list:
    """The values of a column that are new, in order; they are few, or the load is refused."""
    new = rows.select(column).where(F.col(column).isNotNull()).distinct().limit(MOST_LISTED + 1).collect()
    found = sorted({r[0] for r in new} - set(known))
    if len(known) + len(found) > MOST_LISTED:
        raise ValueError(f"more than {MOST_LISTED} different values of {column}")
    return found


def _label_dimension(spark: SparkSession, label: str, known: Sequence[str]) -> DataFrame:
    """Keys by order of appearance in the ledger, so that a label keeps its key."""
    return spark.createDataFrame(list(enumerate(known, 1)), f"{label}_key bigint, {label} string")


def _merge(spark: SparkSession, root: str, state: dict, table: str, rows: DataFrame, batch_id: int) -> None:
    """The newest rows per key of a batch put into the keyed table; ``state`` then names the rewritten parts."""
    key, time, tie_break = KEYED[table]
    folders = state["folders"][table]
    near = near_newest(rows, [key], time)
    newest = materialise(
        latest_per_key(near, [key], time, tie_break).withColumn("part", _part(key, state["parts"])), f"newest-{table}"
    )
    touched = sorted(r.part for r in newest.select("part").distinct().collect())  # at most PARTS rows
    old = [f"{root}/{table}/batch_id={folders[str(p)]}/part={p}" for p in touched if str(p) in folders]
    merged = newest
    if old:
        held = spark.read.schema(newest.drop("part").schema).parquet(*old).withColumn("part", _part(key, state["parts"]))
        merged = latest_per_key(newest.unionByName(held), ["part", key], time, tie_break)
    merged.hint("rebalance", "part").write.mode("overwrite").partitionBy("part").parquet(f"{root}/{table}/batch_id={batch_id}")
    folders.update({str(p): batch_id for p in touched})


def upsert(spark: SparkSession, root: str, landing: DataFrame, batch_id: int, parts: int = PARTS) -> bool:
    """Load the landing rows of one batch; False where this batch is in the store already.

    Batches come in ascending order, as a stream's do; ``parts`` counts for an empty store only.
    """
    state = versions.state(spark, root) or _empty(parts)
    if batch_id <= state["batch"]:
        return False
    with passing_shuffles(spark), passing_stages(spark):
        rows = pack(landing.select(*warehouse.STAR_COLUMNS), "arrival")
        for label in LABELS:
            state["labels"][label] += _listed(rows, label, state["labels"][label])
        days = rows.select(F.to_date(to_time(F.col("scraped_at"))).cast("string").alias("day"))
        state["dates"] = sorted([*state["dates"], *_listed(days, "day", state["dates"])])
        # Written, so that Spark knows they are small and does not move the rows by a handful of labels.
        tiers, bands = (materialise(_label_dimension(spark, c, state["labels"][c]), c) for c in LABELS)
        fact = f"{root}/fact/batch_id={batch_id}"
        loaded = warehouse.load_fact(rows, tiers, bands, arrival=batch_id)  # it comes dealt over all tasks
        for i, part in enumerate(sliced(loaded, -(-rows.count() // ROWS_AT_ONCE), "product_key")):
            part.write.mode("append" if i else "overwrite").option("compression", "zstd").parquet(fact)
        _merge(spark, root, state, "latest", spark.read.schema(_fact_schema()).parquet(fact), batch_id)
        _merge(spark, root, state, "products", warehouse.identified(rows), batch_id)
    versions.publish(spark, root, state | {"batch": batch_id}, batch_id)
    return True


def _fact_schema() -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"{c} {t}" for c, t in STAR_TYPES["fact_product_snapshot"].items()))


def _keyed_rows(spark: SparkSession, root: str, state: dict, table: str, schema: T.StructType) -> DataFrame:
    paths = [f"{root}/{table}/batch_id={b}/part={p}" for p, b in state["folders"][table].items()]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_store(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The star of all committed batches, and ``latest_fact``, the newest fact row per product.

    The ledger is read once; later batches do not show in what is returned.
    """
    state = versions.state(spark, root)
    if state is None:
        raise FileNotFoundError(f"no store below {root}")
    products = T.StructType([
        T.StructField("scraped_at", T.TimestampNTZType()), T.StructField("product_key", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in PRODUCT_ATTRIBUTES],
    ])
    days = spark.createDataFrame([(d,) for d in state["dates"]], "day string").select(F.to_date("day").alias("day"))
    batches = T.StructType([*_fact_schema().fields, T.StructField("batch_id", T.LongType())])
    fact = spark.read.schema(batches).parquet(f"{root}/fact").where(F.col("batch_id") <= state["batch"]).drop("batch_id")
    return {
        "dim_date": days.select(*calendar_parts(F.col("day"))),
        "dim_price_tier": _label_dimension(spark, "price_tier", state["labels"]["price_tier"]),
        "dim_discount_band": _label_dimension(spark, "discount_band", state["labels"]["discount_band"]),
        "dim_product": warehouse.typed_products(_keyed_rows(spark, root, state, "products", products)),
        "fact_product_snapshot": fact,
        "latest_fact": _keyed_rows(spark, root, state, "latest", _fact_schema()),
    }


def latest_snapshots(store: dict[str, DataFrame]) -> DataFrame:
    """The latest view of a store: no snapshot but the newest per product is read."""
    return warehouse.star_join(store["latest_fact"], store, newest=True)


def run_upsert(
    stream: DataFrame, root: str, checkpoint: str, parts: int = PARTS,
    transform: Callable[[DataFrame], DataFrame] = warehouse.to_landing,
) -> None:
    """Load everything that has arrived, then stop; ``transform`` makes landing rows of a batch."""

    def store(batch: DataFrame, batch_id: int) -> None:
        upsert(batch.sparkSession, root, transform(batch), batch_id, parts)

    query = (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
