"""Line dedup by how many distinct sites a line is on.

Every line gets a HyperLogLog sketch of its sites, built from the lines as they stand.
Sketches are built inside each task, merged by aggregation, and estimate the spread of
the line; a line on every page of the corpus is one small sketch per task. Where the
estimate lies near the threshold, its error could decide, so the sites of those lines,
and of no others, are listed and counted exactly. Lines spread over at least
``min_sites`` sites are boilerplate and leave every document.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwatch.llm.common import bit_filter, own_columns, passes, staged, unused

#: Distinct sites from which on a line is boilerplate.
MIN_SITES = 10
#: Registers of a sketch, as a power of two.
LOG_REGISTERS = 12
#: Standard errors of a sketch, on either side of the threshold, within which sites are counted.
ERRORS = 6


def line_key(line: Column) -> Column:
    """128 bits that stand for a line without the blanks around it."""
    bare = F.trim(line)
    return F.struct(F.xxhash64(bare).alias("a"), F.xxhash64(F.lit("line"), bare).alias("b"))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def spread_lines(
    docs: DataFrame,
    text_column: str = "text",
    site_column: str = "source",
    min_sites: int = MIN_SITES,
    log_registers: int = LOG_REGISTERS,
) -> DataFrame:
    """The keys (``line``) of boilerplate lines.

    Blank lines have no key. A NULL site counts as one site of its own. The band in
    which a line is counted exactly is ``ERRORS`` standard errors of the sketch and one site at least.
    """
    site = F.coalesce(F.concat(F.lit("s"), F.col(site_column).cast("string")), F.lit("none"))
    seen = docs.select(F.explode(_lines(F.col(text_column))).alias("_line"), site.alias("_site")).where(
        F.trim("_line") != ""
    )
    seen = seen.select(line_key(F.col("_line")).alias("line"), "_site")
    sketches = seen.groupBy("line").agg(F.hll_sketch_agg("_site", log_registers).alias("sketch"))
    spread = sketches.select("line", F.hll_sketch_estimate("sketch").alias("sites"))
    margin = max(1.0, ERRORS * 1.04 / math.sqrt(2**log_registers) * min_sites)
    spread = staged(spread.where(F.col("sites") >= min_sites - margin), "line-spread")
    clear = spread.where(F.col("sites") > min_sites + margin).select("line")
    near = spread.where(F.col("sites") <= min_sites + margin).select("line")
    # A bitmap keeps most other lines out of the shuffle, the join the rest; copies combine inside the task.
    maybe = seen.where(passes(bit_filter(near.select(F.col("line.a").alias("a")), "a"), F.col("line.a")))
    exact = (
        maybe.distinct().join(near, "line", "left_semi").groupBy("line").agg(F.count("*").alias("sites"))
        .where(F.col("sites") >= min_sites).select("line")
    )
    return staged(clear.unionByName(exact), "boilerplate")


def drop_spread_lines(
    docs: DataFrame, text_column: str = "text", site_column: str = "source", min_sites: int = MIN_SITES
) -> DataFrame:
    """``docs`` with ``_kept`` (the text without boilerplate lines), ``_n_lines`` and ``_n_removed``.

    A NULL or empty text has one, empty, line and stays empty. Blank lines stay. What
    leaves a text depends on the text alone, so the positions are worked out once per
    different text, however many documents hold it. The rows of an empty table are none;
    NULL sites are one site, repeated rows are cleaned alike. A document's own column of an
    added name stays, the added one then has underscores behind its name.
    """
    key, gone_at, of = unused(docs, "_digest", "_gone", "_of")
    kept_name, lines_name, removed_name = unused(docs, "_kept", "_n_lines", "_n_removed")
    boilerplate = spread_lines(docs, text_column, site_column, min_sites)
    digest = F.sha2(F.coalesce(F.col(text_column), F.lit("")), 256)
    placed = docs.select(digest.alias("_digest"), F.posexplode(_lines(F.col(text_column))).alias("_at", "_line")).where(
        F.trim("_line") != ""
    )
    hits = placed.select("_digest", "_at", line_key(F.col("_line")).alias("line")).join(boilerplate, "line", "left_semi")
    gone = hits.groupBy(F.col("_digest").alias(of)).agg(F.collect_set("_at").alias(gone_at))
    joined = docs.withColumn(key, digest).join(gone.hint("shuffle_hash"), F.col(key) == F.col(of), "left")
    lines = _lines(F.col(text_column))
    left = F.when(F.col(gone_at).isNull(), lines).otherwise(
        F.filter(lines, lambda line, at: ~F.array_contains(F.col(gone_at), at))
    )
    return joined.select(
        *own_columns(docs),
        F.concat_ws("\n", left).alias(kept_name),
        F.size(lines).cast("bigint").alias(lines_name),
        F.when(F.col(gone_at).isNull(), F.lit(0)).otherwise(F.size(gone_at)).cast("bigint").alias(removed_name),
    )
