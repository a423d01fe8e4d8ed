"""Number expressions: tolerant casts, roundings, bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_double(c: Column) -> Column:
    """Text to double; anything but a plain number is NULL.

    The guard keeps out ``5d``, ``inf`` and ``nan``, which a bare cast accepts.
    An exponent beyond the range still gives an infinity; see ``finite``.
    """
    return F.when(c.rlike(NUMBER_TEXT), c.try_cast("double"))


def finite(c: Column) -> Column:
    """NULL for NaN and both infinities."""
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def to_exact(c: Column) -> Column:
    """Text to a wide decimal; decimals know no ``5d`` or ``inf``, so no guard is needed."""
    return F.trim(c).try_cast("decimal(38,10)")


def whole(exact: Column) -> Column:
    """The bigint a decimal stands for, NULL when it has a fraction: ``12.0`` is 12, ``12.5`` is NULL."""
    return F.when(exact == F.floor(exact), exact.try_cast("bigint"))


def to_decimal(c: Column, precision: int, scale: int) -> Column:
    """Round to ``scale``; NULL on bad text or overflow."""
    return c.try_cast(f"decimal({precision},{scale})")


def to_key(c: Column) -> Column:
    """Numeric identifier of the warehouse: whole part of a number text."""
    return to_decimal(c, 38, 0).try_cast("bigint")


def round_half_even(c: Column, digits: int) -> Column:
    """The array-library rounding used by the cleaning rules (ties to even)."""
    scale = float(10**digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def round_report(c: Column, digits: int) -> Column:
    """Report rounding, ties away from zero.

    The detour over a decimal removes binary noise, so that two engines agree
    on a tie whatever the order in which they added the doubles.
    """
    return F.round(c.cast("decimal(28,6)"), digits).cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, NULL for a zero divisor."""
    return F.try_divide(numerator, denominator)


def band(
    c: Column, edges: Sequence[float | None], labels: Sequence[str], right: bool = True
) -> Column:
    """Label of the interval that holds ``c``; NULL outside all of them.

    ``right`` closes intervals on their upper edge, otherwise on their lower
    one. A last edge of ``None`` leaves the top interval open.
    """
    if len(edges) != len(labels) + 1:
        raise ValueError("bands need one more edge than labels")

    def below(edge: float) -> Column:
        return c <= F.lit(edge) if right else c < F.lit(edge)

    out = F.when(c.isNull() | below(edges[0]), F.lit(None).cast("string"))
    for upper, label in zip(edges[1:], labels, strict=True):
        out = out.when(F.lit(True) if upper is None else below(upper), F.lit(label))
    return out
