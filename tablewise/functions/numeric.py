"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_div(num: Column, den: Column) -> Column:
    """num / den, null when den is 0 or null (ANSI mode raises on x/0)."""
    return num / F.nullif(den, F.lit(0))


def revenue(price: str = "l_extendedprice", discount: str = "l_discount") -> Column:
    return F.col(price) * (F.lit(1) - F.col(discount))


# Doubles from here on are whole numbers.
_WHOLE = float(1 << 53)


def stable_round(x: Column, digits: int) -> Column:
    """Half-up rounding written as plain IEEE arithmetic,
    floor(x * 10^d + 0.5) / 10^d, so any engine that evaluates the same
    expression on the same double gets the same result (engines' own
    `round` differ on doubles that sit next to a tie). Values too large to
    have digits left to round, NaN and the infinities stay as they are."""
    x = x.cast("double")
    scaled = x * F.lit(float(10 ** digits))
    fits = F.abs(scaled) < F.lit(_WHOLE)
    # Out of range the inner value is 0, so that no branch overflows.
    inner = F.when(fits, scaled).otherwise(F.lit(0.0))
    return F.when(fits, F.floor(inner + F.lit(0.5)) / F.lit(float(10 ** digits))).otherwise(x)


def exact_mean(x: Column) -> Column:
    """Mean from an exact decimal sum: independent of summation order, so the
    same on any partitioning. Values need fewer than 28 integer digits."""
    return F.sum(x.cast("decimal(38,10)")).cast("double") / F.count(x)


def fine_mean(x: Column, parts: int = 1 << 16) -> Column:
    """Mean of doubles that hardly depends on the order of the rows: whole
    ``1/parts`` are added up exactly as longs, and only the rests, below one
    part each, as doubles. Where a value or the sum of parts leaves the range
    of a long, the plain mean."""
    scaled = x * F.lit(float(parts))
    fits = F.abs(scaled) < F.lit(_WHOLE)
    inner = F.when(fits, scaled).otherwise(F.when(x.isNotNull(), F.lit(0.0)))
    whole = F.floor(inner)
    total = F.try_sum(whole).cast("double") + F.sum(inner - whole)
    n = F.count(x)
    return F.when((F.count_if(~fits) == 0) & F.try_sum(whole).isNotNull(),
                  safe_div(total / F.lit(float(parts)), n)).otherwise(F.avg(x))
