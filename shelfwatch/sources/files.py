"""CSV and Parquet snapshots: reading, header checks, landing, sinks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.schema import CLEAN_COLUMNS, CSV_NULL_TOKENS, RAW_COLUMNS, text_schema
from shelfwatch.session import materialise

DATE_IN_NAME = r"(\d{4}-\d{2}-\d{2})"


def read_text_csv(
    spark: SparkSession, path: str | Sequence[str], multiline: bool = False, fail_fast: bool = False
) -> DataFrame:
    """CSV with a header, every column text, header names trimmed.

    ``multiline`` admits line breaks in quoted cells, at the price that one file
    is one task; without it large files are split. All files must share one header:
    another column order raises instead of shifting cells. Rows with too many or too
    few cells are read as far as they go; see :func:`malformed_rows`, or set ``fail_fast``.
    """
    options = {
        "header": True,
        "quote": '"',
        "escape": '"',
        "multiLine": multiline,
        "mode": "FAILFAST" if fail_fast else "PERMISSIVE",
    }
    header = spark.read.options(**options).csv(path).columns
    df = spark.read.options(**options, enforceSchema=False).schema(text_schema(header)).csv(path)
    return df.toDF(*[c.strip() for c in header])


def malformed_rows(spark: SparkSession, path: str | Sequence[str], multiline: bool = False) -> DataFrame:
    """The rows whose number of cells is not the header's, as ``line`` text: what a permissive read would cut or pad."""
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": multiline}
    header = spark.read.options(**options).csv(path).columns
    schema = text_schema([*header, "_line"])
    rows = spark.read.options(**options, columnNameOfCorruptRecord="_line").schema(schema).csv(path)
    # Written with all cells: Spark refuses a query for the malformed lines alone.
    return materialise(rows.where(F.col("_line").isNotNull()), "malformed").select(F.col("_line").alias("line"))


def require_columns(df: DataFrame, required: Iterable[str] = RAW_COLUMNS) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def load_raw(spark: SparkSession, path: str | Sequence[str], multiline: bool = False) -> DataFrame:
    """A raw product snapshot; raises when a required column is missing."""
    return require_columns(read_text_csv(spark, path, multiline))


def latest_file(spark: SparkSession, folder: str, pattern: str) -> str:
    """Newest file of a folder by modification time; file contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    newest = files.agg(F.max(F.struct("modificationTime", "path")).alias("f")).first().f
    if newest is None:
        raise FileNotFoundError(f"No files matching {pattern!r} in {folder}")
    return newest.path


def newest_rows(
    spark: SparkSession, path: str | Sequence[str], by: Sequence[str] = ("category",), multiline: bool = False
) -> DataFrame:
    """The rows of the newest file per date and values of ``by``, with the last date in its path as ``file_date``.

    Age is the modification time the scan itself reports; of equal times the larger path
    wins. Files are read where they lie, and the choice, a row per date and group, is joined
    by path: nothing is listed on the driver. NULL is a group of its own.
    """
    df = read_text_csv(spark, path, multiline)
    rows = df.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_modification_time").alias("_time")
    ).withColumn("file_date", F.regexp_extract("_file", f".*{DATE_IN_NAME}", 1))
    groups = ["file_date", *by]
    newest = rows.groupBy(*groups).agg(F.max(F.struct("_time", "_file")).alias("_newest"))
    chosen = newest.select(*[F.col(c).alias(f"_{c}") for c in groups], F.col("_newest._file").alias("_chosen"))
    same = F.col("_file") == F.col("_chosen")
    for c in groups:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    return rows.join(chosen, same, "left_semi").drop("_file", "_time")


def null_csv_tokens(df: DataFrame, tokens: Sequence[str] = CSV_NULL_TOKENS) -> DataFrame:
    """The null texts of the landing format, on every column.

    The reader's ``nullValue`` takes one text only and keeps a quoted empty cell.
    """
    tokens = list(tokens)
    return df.select(*[F.when(~F.col(c).isin(tokens), F.col(c)).alias(c) for c in df.columns])


def copy_into(
    spark: SparkSession, path: str | Sequence[str], table: str, columns: Sequence[str] = CLEAN_COLUMNS,
    multiline: bool = False,
) -> None:
    """Append named files to a landing table, columns matched by name in any case.

    A malformed row aborts the load; the table keeps what it held before.
    """
    df = null_csv_tokens(read_text_csv(spark, path, multiline, fail_fast=True))
    by_name = {c.lower(): c for c in df.columns}
    aligned = df.select(
        *[(F.col(by_name[c]) if c in by_name else F.lit(None).cast("string")).alias(c) for c in columns]
    )
    aligned.write.mode("append").saveAsTable(table)


def file_date(path: str | Column) -> Column:
    """The date in a file name, else today."""
    name = F.regexp_extract(F.lit(path) if isinstance(path, str) else path, DATE_IN_NAME, 1)
    return F.coalesce(F.nullif(name, F.lit("")), F.current_date().cast("string"))


def dated_name(spark: SparkSession, prefix: str, input_path: str) -> str:
    """``prefix_<date of the input file, else today>``."""
    tag = spark.range(1).select(file_date(input_path).alias("d")).first().d
    return f"{prefix}_{tag}"


_WRITTEN = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


#: Rows per packed CSV file: it cannot be split, so a task reads all of it.
ROWS_PER_FILE = 1_000_000


def _csv_writer(df: DataFrame, mode: str, packed: bool):
    writer = df.write.mode(mode).options(**_WRITTEN)
    return writer.option("compression", "gzip").option("maxRecordsPerFile", ROWS_PER_FILE) if packed else writer


def write_csv(df: DataFrame, path: str, packed: bool = False) -> None:
    """CSV part files with a header; quotes and the blanks around a cell survive a round trip.

    ``packed`` files are gzipped (``*.csv.gz``) and small enough for a task each.
    """
    _csv_writer(df, "overwrite", packed).csv(path)


def append_csv(df: DataFrame, path: str, packed: bool = False) -> None:
    """The same, beside the files that are there: an arrival for a stream."""
    _csv_writer(df, "append", packed).csv(path)


def write_clean(df: DataFrame, folder: str, input_path: str, prefix: str = "clean") -> str:
    """Cleaned rows as CSV below ``folder``, named by the date of their input; returns the path."""
    path = f"{folder.rstrip('/')}/{dated_name(df.sparkSession, prefix, input_path)}"
    write_csv(df, path)
    return path


def write_snapshot(df: DataFrame, path: str, date_column: str = "scrape_date", fmt: str = "csv") -> None:
    """Append a raw snapshot below one folder per scrape date.

    ``rebalance`` gathers each date into few files and splits a date that would
    overload one task.
    """
    writer = df.hint("rebalance", date_column).write.mode("append").partitionBy(date_column).format(fmt)
    if fmt == "csv":
        writer = writer.options(header=True, quote='"', escape='"')
    writer.save(path)
