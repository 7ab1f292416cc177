"""Exact decimal arithmetic helpers (half-up rounding, guarded division)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(15,2)"


def guarded(numerator: Column, denominator: Column) -> Column:
    """Division that yields NULL for a zero denominator."""
    return numerator / F.nullif(denominator, F.lit(0))


def exact_avg(total: Column, n: Column) -> Column:
    """Mean of a decimal from its sum and count, rounded once.

    ``avg`` would round to six digits first and to two afterwards.
    """
    return F.round(guarded(total, n), 2).cast(MONEY)


def pct(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` rounded to two digits; NULL for a zero whole."""
    return F.round(guarded(F.lit(100).cast("decimal(3,0)") * part, whole), 2).cast(MONEY)


def money(c: Column) -> Column:
    return c.cast(MONEY)
