"""Price expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from notevalue.functions import fixed


def price_bin(price: Column, bins: int = fixed.BINS, low: float = fixed.MIN_PRICE, high: float = fixed.MAX_PRICE) -> Column:
    """Index of the equal-width bin in log price, clipped into `0 .. bins - 1`."""
    bucket = F.width_bucket(F.log1p(price), F.lit(math.log1p(low)), F.lit(math.log1p(high) + 1e-9), F.lit(bins))
    return F.greatest(F.lit(0), F.least(F.lit(bins - 1), bucket - 1)).cast("bigint")


def whole_dollars(amount: Column) -> Column:
    """Rounded to a whole number, ties to even, as text."""
    return F.bround(amount, 0).cast("bigint").cast("string")


def signed_dollars(amount: Column) -> Column:
    """Whole dollars with an explicit sign."""
    return F.concat(F.when(amount < 0, F.lit("-")).otherwise(F.lit("+")), whole_dollars(F.abs(amount)))


def cents(amount: Column) -> Column:
    """Two decimals without thousands separators, ties to even."""
    return F.format_string("%.2f", F.bround(amount, 2))


def geometric_mean(price: Column) -> Column:
    """The mean that suits log-normal prices (an aggregate)."""
    return F.expm1(F.avg(F.log1p(price)))
