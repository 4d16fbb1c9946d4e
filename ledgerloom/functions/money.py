"""Exact decimal quotients. Money never passes through floating point."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T


def half_up_ratio(numerator: Column, denominator: Column, scale: int) -> Column:
    """``numerator / denominator`` rounded once, half away from zero; null for a zero or null denominator.

    The quotient is taken on integers, so no intermediate scale can round it a first time.
    The numerator is money; the denominator a decimal of at most 23 digits before and 10 after the point.
    """
    numerator = numerator.cast("decimal(22,2)")
    n = F.abs(numerator) * F.lit(2 * 10**scale).cast("decimal(6,0)")
    d = F.abs(denominator)
    units = F.call_function("div", n + d, d * F.lit(2).cast("decimal(1,0)"))
    signed = units.cast("decimal(20,0)") * F.when(
        (numerator < 0) != (denominator < 0), F.lit(-1)
    ).otherwise(F.lit(1)).cast("decimal(1,0)")
    quotient = signed * F.lit(f"{10**-scale:.{scale}f}").cast(f"decimal({scale + 1},{scale})")
    return F.when(denominator != 0, quotient)


def money(value: Column, precision: int = 34, scale: int = 2) -> Column:
    return value.cast(f"decimal({precision},{scale})")


#: Amounts of statement lines.
AMOUNT = T.DecimalType(12, 2)


def cents(amount: Column, kind: T.DataType) -> Column:
    """An amount of a statement line as a bigint, whose sums travel in a third of the bytes that sums of decimals take; a sum of
    more than nine million of the largest amounts would fail. Amounts of another type stay as they are."""
    return (amount * F.lit(100)).cast("bigint") if kind == AMOUNT else amount


def of_cents(total: Column, kind: T.DataType) -> Column:
    """A sum of ``cents`` as the sum of the amounts would be."""
    return (total.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(22,2)") if kind == AMOUNT else total
