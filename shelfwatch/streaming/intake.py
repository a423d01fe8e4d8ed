"""Incremental intake: new snapshot files become fact rows, once each.

Instead of picking the newest file, a file stream takes whatever arrived since
its last run. Every micro-batch goes to a folder named by its batch id and is
written in overwrite mode, so a batch that is retried after a lost executor or
driver replaces itself and no row is doubled.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from shelfwatch.operators.dedup import exact_dedup, latest_per_key
from shelfwatch.schema import RAW_COLUMNS, text_schema


def csv_stream(
    spark: SparkSession, folder: str, pattern: str = "*.csv", files_per_batch: int = 1000, multiline: bool = False,
    columns: Sequence[str] = RAW_COLUMNS,
) -> DataFrame:
    """Snapshot files of a folder as a stream of text rows; ``multiline`` as in :func:`read_text_csv`."""
    return (
        spark.readStream.schema(text_schema(list(columns)))
        .options(
            header=True, quote='"', escape='"', multiLine=multiline, enforceSchema=False,
            pathGlobFilter=pattern, maxFilesPerTrigger=files_per_batch,
        )
        .csv(folder)
    )


def run_intake(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = exact_dedup,
) -> None:
    """Process everything available, then stop. Call again when files arrived."""

    def store(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    query = (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def intake_rows(spark: SparkSession, out: str, time_column: str = "scraped_at") -> DataFrame:
    """All stored rows; copies that arrived in different batches are merged."""
    return exact_dedup(spark.read.parquet(out).drop("batch_id"), time_column)


def intake_latest(
    spark: SparkSession, out: str, key: str = "product_id", time_column: str = "scraped_at",
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """The newest stored row per key; equals the batch result over the same files."""
    rows = intake_rows(spark, out, time_column)
    return latest_per_key(rows, [key], time_column, tie_break)
