"""Numeric helpers that follow NumPy's and Python's rounding instead of Java's."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(value: Column, digits: int = 2) -> Column:
    """NumPy rounding: scale, round to the nearest even integer, scale back (0.125 -> 0.12)."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def one_decimal(value: Column) -> Column:
    """Text of a non-negative double with one decimal, decided on its exact binary value.

    Java formats the shortest decimal form half-up (0.35 -> 0.4) while the expected texts come
    from the binary value (0.35 is a little below the tie -> 0.3). Only a product that lands
    exactly on a tie can go wrong, so the rounding error of ``value * 10`` breaks the tie: the
    value is split into a float and a remainder whose products with 10 are both exact.
    """
    scaled = value * 10.0
    head = value.cast("float").cast("double")
    error = (head * 10.0 - scaled) + (value - head) * 10.0
    tie = (scaled - F.floor(scaled)) == 0.5
    tenths = (
        F.when(tie & (error < 0), F.floor(scaled))
        .when(tie & (error > 0), F.ceil(scaled))
        .otherwise(F.rint(scaled))
        .cast("bigint")
    )
    return F.when(value == float("inf"), F.lit("inf")).otherwise(
        F.format_string("%d.%d", F.try_divide(tenths, F.lit(10)).cast("bigint"), F.pmod(tenths, F.lit(10)))
    )
