"""Number semantics that Spark's own functions don't have."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(x: Column, places: int) -> Column:
    """Scaled, rounded to the nearest with halves towards plus infinity, and scaled back, in doubles.

    F.round rounds halves away from zero and in decimals, and floor(y + 0.5) fails just below a half.
    """
    k = float(10**places)
    y = x.cast("double") * k
    down = F.floor(y)
    return F.when(F.isnan(y) | (F.abs(y) >= 2.0**52), x.cast("double")).otherwise(F.when(y - down >= 0.5, F.ceil(y)).otherwise(down).cast("double") / k)


def js_number(x: Column) -> Column:
    """A double as shortest text: integral values without a fraction."""
    whole = F.floor(x)
    return F.when(x == whole, whole.cast("string")).otherwise(x.cast("string"))


def at_least(x: Column, threshold: float) -> Column:
    """x >= threshold, where NaN is not (Spark orders NaN above all numbers)."""
    return ~F.isnan(x) & (x >= F.lit(float(threshold)))


def not_below(x: Column, threshold: float) -> Column:
    """not (x < threshold), which lets NaN pass."""
    return F.isnan(x) | ~(x < F.lit(float(threshold)))
