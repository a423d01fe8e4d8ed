"""Helpers that several corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.session import materialise

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once below the shared checkpoint folder and read back."""
    return materialise(df, label)


def own_columns(docs: DataFrame) -> list[Column]:
    """The columns of ``docs``, whatever signs their names hold."""
    return [F.col(quoted(c)) for c in docs.columns]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def unused(docs: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened by underscores until no column of ``docs`` has it in any case."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other character as it is; NULL counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), ASCII_UPPER, ASCII_LOWER)


def text_key(text: Column) -> Column:
    """128 bits that stand for a text, as a struct ``a, b``; NULL counts as empty."""
    bare = F.coalesce(text.cast("string"), F.lit(""))
    return F.struct(F.xxhash64(bare).alias("a"), F.xxhash64(F.lit("text"), bare).alias("b"))


def slot(key: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots))


def bit_filter(keys: DataFrame, column: str, slots: int = 1 << 20) -> DataFrame:
    """One row, one array: a bitmap of ``slots`` bits with the slot of every key set.

    Its size is fixed (``slots / 8`` bytes), so it may be used as a scalar in any
    later filter. The more keys, the more bits are set and the less the filter
    removes; a row whose key is present always passes.
    """
    words = slots // 64
    at = slot(F.col(column), slots)
    filled = keys.select(at.alias("_slot")).selectExpr(
        "shiftright(_slot, 6) AS _word", "shiftleft(1L, CAST(_slot & 63 AS INT)) AS _bit"
    )
    filled = filled.groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    blank = keys.sparkSession.range(0, words, 1, 1).select(F.col("id").alias("_word"), F.lit(0).cast("bigint").alias("_bits"))
    dense = blank.unionByName(filled).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    ordered = F.sort_array(F.collect_list(F.struct("_word", "_bits")))
    return dense.agg(F.transform(ordered, lambda x: x["_bits"]).alias("bitmap"))


def passes(bitmap: DataFrame, key: Column, slots: int = 1 << 20) -> Column:
    """Whether the slot of ``key`` is set in a bitmap made by ``bit_filter``."""
    at = slot(key, slots)
    word = F.get(bitmap.scalar(), F.shiftright(at, 6).cast("int"))
    return word.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(F.lit(63)).cast("int"))) != 0
