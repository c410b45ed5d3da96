"""Sums of doubles that are the same however the rows are ordered and dealt out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits of one digit. A digit is at most 2**24, so a long holds the sum of 2**39 of them.
DIGIT_BITS = 24
#: Powers of two that the digits stand for, the largest first.
WEIGHTS = (48, 24, 0, -24, -48, -72, -96)
#: Values from here on are left to the plain sum.
LIMIT = 2.0 ** (WEIGHTS[0] + DIGIT_BITS)


def exact_sum(x: Column) -> Column:
    """An aggregate: the sum of a numeric column as a double, independent of row order.

    Each value is cut into seven whole digits of 24 bits, the digits of one weight
    are summed as longs, and the seven sums are put together at the end, smallest
    first. Nothing is rounded before that end, so partial sums merge in any order.
    Scaling by a power of two, ``rint`` and the difference of two neighbours are all
    exact. Bits below 2**-97 of a single value are lost, always the same ones.

    NULL is passed over, and the sum of nothing is NULL. NaN, infinities and values
    from 2**72 on go through the plain sum, which is not independent of the order.
    """
    x = x.cast("double")
    fits = F.abs(x) < LIMIT  # false for NaN, which is the largest value to Spark

    def whole(weight: int) -> Column:
        return F.rint(x * 2.0**-weight)

    total = F.lit(0.0)
    for weight in reversed(WEIGHTS):
        digit = whole(weight)
        if weight != WEIGHTS[0]:
            digit = digit - whole(weight + DIGIT_BITS) * 2.0**DIGIT_BITS
        digits = F.sum(F.when(fits, digit.cast("bigint")))
        total = total + digits.cast("double") * 2.0**weight
    rest = F.sum(F.when(~fits, x))
    return F.coalesce(total + F.coalesce(rest, F.lit(0.0)), rest)
