"""Mixing sources to target weights by systematic sampling.

Targets come from sums along the sources, one row each. Each document of a source is expected
``target / source size`` times. The expected copies are summed up along the
documents of the source in order of size, one random offset is added, and a
document is taken once for every whole number that its stretch of the sum crosses.
Ordered by size, every size is taken at the same rate, so the words taken come
close to the target whatever the offset.

The running sum needs each document's rank in its source. Ranges of (source, size)
are dealt to tasks, ranked there, and shifted by the counts of the ranges before
them, so a source with a third of all rows is spread over many tasks. Only keys are dealt
and ranked; the documents themselves move once, to their copies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwatch.llm.common import own_columns, staged, unused

WEIGHTS = (5, 2, 1)
#: Words of the mix as a share of all words, and the most a document may be taken, both in halves.
TOTAL_HALVES = 3
MOST_COPIES = 2
SEED = "mix"


def word_count(text: Column) -> Column:
    """Runs of characters other than blanks and the controls from tab to carriage return; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def _with_sums_before(rows: DataFrame, order: Sequence[Column], *columns: str) -> DataFrame:
    """``rows`` with, per column, the sum over the rows before in a strict ``order`` as ``<column>_before``.

    Ranges of the order are dealt to tasks and summed there; one row per range meets in a task.
    """
    dealt = staged(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "sums")
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)

    def before(column: str, window) -> Column:
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    per_range = dealt.groupBy("range").agg(*[F.sum(c).alias(c) for c in columns])
    shifts = per_range.select("range", *[before(c, earlier).alias(f"{c}_shift") for c in columns])
    summed = dealt.withColumns({f"{c}_here": before(c, within) for c in columns}).join(shifts, "range")
    return summed.select(*rows.columns, *[(F.col(f"{c}_here") + F.col(f"{c}_shift")).alias(f"{c}_before") for c in columns])


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """``source, weight, source_size, target`` from rows with ``source, size``.

    The common level is where the sum of ``min(weight x level, 2 x size)`` meets the
    total. Sources are ordered by the level at which they are full; those before the
    first that stays below its cap are full. Numbers and sums along the sources come from
    ranges, so a source per host or per document is no task's burden. An empty table has none.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.lit(1).cast("bigint").alias("one"))
    by_name = [F.col("source").isNull(), F.col("source")]
    choice = F.array(*[F.lit(w).cast("bigint") for w in weights])
    weighed = _with_sums_before(per_source, by_name, "one").select(
        "source", "source_size",
        F.element_at(choice, (F.col("one_before") % len(weights) + 1).cast("int")).alias("weight"),
        (F.lit(MOST_COPIES) * F.col("source_size")).alias("cap"),
    )
    # Full at the level cap / weight; names settle equal levels.
    summed = staged(_with_sums_before(weighed, [F.col("cap") / F.col("weight"), *by_name], "cap", "weight"), "levels")
    total = summed.agg(F.struct(F.sum("weight").alias("weight"), F.sum("source_size").alias("size")).alias("total")).scalar()
    left = summed.withColumn("weight_left", total["weight"] - F.col("weight_before")).withColumn(
        "halves_left", F.lit(TOTAL_HALVES) * total["size"] - 2 * F.col("cap_before")
    )
    # cap / weight < left / weight left: the source is full. Levels rise, so the full ones come first.
    flagged = left.withColumn("full", 2 * F.col("cap") * F.col("weight_left") <= F.col("halves_left") * F.col("weight"))
    level = flagged.where("NOT full").agg(F.min(F.struct("cap_before", "halves_left", "weight_left")).alias("at")).scalar()
    return flagged.select(
        "source", "weight", "source_size",
        F.when(F.col("full"), F.col("cap").cast("double"))
        .otherwise(F.col("weight") * level["halves_left"] / (2 * level["weight_left"]))
        .alias("target"),
    )


def offset(source: Column, seed: str = SEED) -> Column:
    """The one random offset of a source, in [0, 1), the same in every run."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(source, F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def added_names(docs: DataFrame) -> list[str]:
    """The names of the size, the source's size, its target and the copies in the result for ``docs``."""
    return unused(docs, "_size", "_source_size", "_target", "_copies")


def systematic_mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    source_column: str = "source",
    size: Column | None = None,
    text_column: str = "text",
    tie: Sequence[str] = (),
    weights: Sequence[int] = WEIGHTS,
    seed: str = SEED,
) -> DataFrame:
    """The rows of ``docs`` with ``_size, _source_size, _target, _copies`` behind their own columns.

    A document is taken 0 to 2 times. NULL sources are one source, the last. A NULL or
    empty text has size 0; a source of size 0 has target 0 and nothing of it is taken.
    Documents of one size are ordered by id (NULL first), then by ``tie``; rows that
    are equal in all of these are interchangeable. An empty table gives an empty result.
    A document's own column of an added name stays as it is; the added one then has
    underscores behind its name (:func:`added_names`).
    """
    size_name, source_size, target, copies_name = added_names(docs)
    place_name, held, rank, *plan_names = unused(
        docs, "_place", "_range", "_rank", "_s", "_r", "_shift", "_plan_size", "_plan_target"
    )
    of_source, of_range, shift, plan_size, plan_target = plan_names
    sized = docs.withColumn(size_name, word_count(F.col(text_column)) if size is None else size.cast("bigint"))
    # Equal rows are told apart by their place, so that no range grows with them.
    sized = sized.withColumn(place_name, F.monotonically_increasing_id())
    keys = [F.col(source_column), F.col(size_name), F.col(id_column), *[F.col(c) for c in tie], F.col(place_name)]
    whole = staged(sized, "sized")
    narrow = whole.select(*dict.fromkeys([source_column, size_name, id_column, *tie, place_name]))
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The number of the range is stored, so that later steps agree on it.
    dealt = staged(narrow.repartitionByRange(width, *keys).withColumn(held, F.spark_partition_id()), "ranges")
    goals = staged(targets(dealt.select(F.col(source_column).alias("source"), F.col(size_name).alias("size")), weights), "targets")
    counted = dealt.groupBy(F.col(source_column).alias(of_source), F.col(held).alias(of_range)).agg(F.count("*").alias("n"))
    earlier = Window.partitionBy(of_source).orderBy(of_range).rowsBetween(Window.unboundedPreceding, -1)
    shifts = counted.select(of_source, of_range, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(shift))
    plan = shifts.join(goals, F.col(of_source).eqNullSafe(F.col("source"))).select(
        of_source, of_range, shift, F.col("source_size").alias(plan_size), F.col("target").alias(plan_target)
    )
    within = Window.partitionBy(source_column, held).orderBy(*keys[1:])
    ranked = dealt.withColumn(rank, F.row_number().over(within))
    joined = ranked.join(plan, F.col(source_column).eqNullSafe(F.col(of_source)) & (F.col(held) == F.col(of_range)))
    rate = F.when(F.col(plan_size) > 0, F.col(plan_target) / F.col(plan_size)).otherwise(F.lit(0.0))
    place = F.col(rank) + F.col(shift)
    start = offset(F.col(source_column), seed)
    copies = F.floor(rate * place + start) - F.floor(rate * (place - 1) + start)
    taken = joined.select(
        place_name, F.col(plan_size).alias(source_size), F.col(plan_target).alias(target), copies.cast("bigint").alias(copies_name)
    )
    return whole.join(taken, place_name).select(*own_columns(docs), size_name, source_size, target, copies_name)


def mixed_documents(docs: DataFrame, text_column: str = "text", **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the number of the copy.

    That number is the last column, ``copy``, or ``copy_`` and so on where documents have a
    ``copy`` of their own; all their columns stay as they are. NULL and empty texts have size
    0; a source without words is not taken from. An empty table gives no rows.
    """
    number, tie = unused(docs, "copy", "_tie")
    tied = docs.withColumn(tie, F.xxhash64(F.col(text_column)))
    copies = F.col(added_names(tied)[-1])
    taken = systematic_mix(tied, text_column=text_column, tie=[tie], **options).where(copies > 0)
    return taken.select(*own_columns(docs), F.explode(F.sequence(F.lit(1).cast("bigint"), copies)).alias(number))
