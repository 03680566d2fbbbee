"""Sums, means and rounding that do not depend on how the input is split.

A sum of doubles changes in its last bits with the order of the rows. Inputs
here have a known number of decimals, so a value is turned into an integer
(``12.3`` with one decimal is ``123``) and integers are summed instead. That
costs about as much as summing doubles; a sum of DECIMAL values costs several
times more, since every addition allocates.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# A scaled value is split into a high part and a low part of LIMB_BITS bits that
# are summed apart. One BIGINT sum would overflow on a very large group; the two
# hold groups of up to 2**43 rows and sums of up to 2**83.
LIMB_BITS = 20
LIMB_SIZE = 1 << LIMB_BITS

# Doubles hold every integer below this exactly.
EXACT_LIMIT = float(1 << 53)


def scaled_integer(value: Column, scale: int) -> Column:
    """``value * 10**scale`` as BIGINT; fails on a value with more decimals.

    A double that stands for a number of at most ``scale`` decimals is the
    nearest double to ``k / 10**scale``, which is what the division yields.
    """
    unit = float(10**scale)
    nearest = F.rint(value * unit)
    fits = (nearest / unit == value) & (F.abs(nearest) < EXACT_LIMIT)
    complaint = F.concat(
        F.lit(f"value does not fit {scale} decimals: "), value.cast("string")
    )
    return (
        F.when(fits, nearest.cast("bigint"))
        .when(value.isNotNull(), F.raise_error(complaint).cast("bigint"))
    )


def exact_sum(value: Column, scale: int | None) -> Column:
    """Aggregate: sum as ``DECIMAL(38, scale)``, the same for any row order.

    ``scale=None`` is for values of unbounded decimals: a plain sum of doubles,
    whose last bits depend on the order.
    """
    if scale is None:
        return F.sum(value)
    whole = scaled_integer(value, scale)
    # try_sum is NULL where a plain sum would wrap around with ANSI mode off.
    high = F.try_sum(F.shiftright(whole, LIMB_BITS)).cast("decimal(20,0)")
    low = F.try_sum(whole.bitwiseAND(F.lit(LIMB_SIZE - 1))).cast("decimal(20,0)")
    total = _unscaled(high * F.lit(Decimal(LIMB_SIZE)) + low, scale)
    overflow = F.raise_error(F.lit("a sum is too large")).cast(f"decimal(38,{scale})")
    return F.when(total.isNotNull() | (F.count(value) == 0), total).otherwise(overflow)


def exact_list_sum(values: Column, scale: int | None) -> Column:
    """Sum of one array as ``DECIMAL(38, scale)``, or as DOUBLE without a scale."""
    if scale is None:
        return F.aggregate(values, F.lit(0.0), lambda total, v: total + v)
    whole = F.transform(values, lambda v: scaled_integer(v, scale))
    # Two sums of whole numbers, as above; a list is too short for either to overflow.
    zero = F.lit(0).cast("bigint")
    both = F.transform(
        F.array(whole),
        lambda w: F.struct(
            F.aggregate(w, zero, lambda total, v: total + F.shiftright(v, LIMB_BITS)).alias("high"),
            F.aggregate(w, zero, lambda total, v: total + v.bitwiseAND(F.lit(LIMB_SIZE - 1))).alias("low"),
        ),
    )[0]
    high, low = (both[name].cast("decimal(20,0)") for name in ("high", "low"))
    return _unscaled(high * F.lit(Decimal(LIMB_SIZE)) + low, scale)


def _unscaled(whole: Column, scale: int) -> Column:
    return (whole * F.lit(Decimal(1).scaleb(-scale))).cast(f"decimal(38,{scale})")


def exact_mean(value: Column, scale: int | None) -> Column:
    """Aggregate: true mean, total sum over total count."""
    return exact_sum(value, scale).cast("double") / F.count(value)


def one_zero(value: Column) -> Column:
    """The value, with 0.0 for -0.0; else the least of both would depend on the order of the rows."""
    return value + F.lit(0.0)


def _scaled_and_rounded(value: Column, digits: int) -> Column:
    unit = float(10**digits)
    return F.rint(value * unit) / unit


def round_half_even(value: Column, digits: int = 1) -> Column:
    """Nearest, ties to even: 0.25 becomes 0.2 and 0.35 becomes 0.4.

    A tie is one of the scaled value, as in ``rint(10 * x) / 10``. ``bround`` takes
    the decimal text of the value instead, so that a mean of exactly 52731.45
    that was computed as 52731.450000000004 is no tie for it.
    """
    return one_zero(_scaled_and_rounded(value, digits))


def format_rounded(value: Column, digits: int = 1) -> Column:
    """Text of the rounded value. The sign stays when it rounds to zero: ``-0.0``."""
    return F.format_string(f"%.{digits}f", _scaled_and_rounded(value, digits))


def whole_part(number: Column, by: int) -> Column:
    """Integer division, down also below zero; going through doubles would blur large row numbers."""
    divisor = F.lit(by).cast("bigint")
    return F.call_function("div", number - F.pmod(number, divisor), divisor)
