"""Rounding and ratio helpers shared by the reports.

Percentages are computed in DECIMAL (like the reference's NUMERIC), so
``round(.., 2)`` rounds half-up on the exact ratio and not on a binary
double; results are returned as DOUBLE.  A zero denominator gives NULL.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

HUNDRED = Decimal("100.0")


def percent(numerator: Column, denominator: Column, scale: int = 2) -> Column:
    return F.round(F.lit(HUNDRED) * numerator / F.nullif(denominator, F.lit(0)), scale).cast("double")


def round0(c: Column) -> Column:
    """ROUND(x, 0) as DOUBLE (half-up)."""
    return F.round(c, 0).cast("double")


def int_midpoint(a: str, b: str) -> Column:
    """(a + b) / 2 on two INT columns, integer (truncating) division; the sum
    is a BIGINT, so it can't overflow."""
    return F.expr(f"(cast({a} as bigint) + cast({b} as bigint)) div 2")
