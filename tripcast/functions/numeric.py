"""Numeric helpers (F11, F12, F14, F15) and exact sums."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def truncate_int(c: Column) -> Column:
    """Truncating integer cast, toward zero like Python ``int()``."""
    return c.try_cast("int")


# Exact sums of doubles, whatever their order and size. A value counts as the decimal that it prints as: an
# integer times a power of ten, added up with those of its power (its band) as a decimal integer of 38 digits.
# Powers are multiples of LIMB, so that the bands' sums are digits of base 10 ** LIMB that only need carrying.
LIMB = 8
USUAL = -1  # the band of values below 10 ** 18 with at most 8 decimals, nearly all
_INTEGER = "decimal(38,0)"


def _usual(c: Column) -> Column:
    """c times 10 ** 8 if it is of the usual band, else null."""
    scaled = c.try_cast("decimal(26,8)")
    return F.when(scaled.cast("double") == c, (scaled * F.lit(10 ** LIMB).cast("decimal(9,0)")).cast(_INTEGER))


def _printed(c: Column) -> tuple[Column, Column]:
    """Digits (a string) and power of ten of what abs(c) prints as."""
    parts = F.split(F.abs(c).cast("string"), "E")
    number, power = F.get(parts, F.lit(0)), F.coalesce(F.get(parts, F.lit(1)).cast("int"), F.lit(0))
    point = F.instr(number, ".")
    decimals = F.when(point > 0, F.length(number) - point).otherwise(0)
    return F.replace(number, F.lit("."), F.lit("")), power - decimals


def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def band(c: Column) -> Column:
    """The band in which a double is added up; values that aren't finite have none."""
    c = c.cast("double")
    _, power = _printed(c)
    return F.when(_usual(c).isNotNull(), F.lit(USUAL)).when(_finite(c), F.floor(power / LIMB).cast("int"))


def amount(c: Column) -> Column:
    """The integer that a double adds to its band."""
    c = c.cast("double")
    digits, power = _printed(c)
    shifted = F.concat(digits, F.repeat(F.lit("0"), F.pmod(power, F.lit(LIMB)).cast("int"))).cast(_INTEGER)
    return F.coalesce(_usual(c), F.when(_finite(c), F.when(c < 0, -shifted).otherwise(shifted)))


def special(c: Column) -> Column:
    """Values that aren't finite; their sum is what every sum with them is."""
    return F.when(~_finite(c.cast("double")), c.cast("double"))


def added(bands: Column) -> Column:
    """The double next to the exact total of bands, an array of (band int, total decimal(38,0)); null if it is empty.

    A band may occur more than once.
    """
    sums = F.filter(bands, lambda x: x.band.isNotNull() & x.total.isNotNull())
    low, high = F.array_min(F.transform(sums, lambda x: x.band)), F.array_max(F.transform(sums, lambda x: x.band))
    zero, base = F.lit(0).cast(_INTEGER), F.lit(10 ** LIMB).cast("decimal(9,0)")

    def digits(sign: int) -> Column:
        """(carry, text): the total from its lowest band on as digits, five limbs beyond the highest band."""
        start = F.struct(zero.alias("carry"), F.lit("").alias("text"))

        def step(state: Column, k: Column) -> Column:
            own = F.aggregate(F.filter(sums, lambda x: x.band == k), state.carry, lambda t, x: (t + sign * x.total).cast(_INTEGER))
            rest = F.pmod(own, base).cast(_INTEGER)
            return F.struct(((own - rest) / base).cast(_INTEGER).alias("carry"), F.concat(F.lpad(rest.cast("string"), LIMB, "0"), state.text).alias("text"))

        return F.aggregate(F.sequence(low, high + 5), start, step)

    def number(found: Column, sign: str) -> Column:
        return F.concat(F.lit(sign), found.text, F.lit("E"), (low * LIMB).cast("string")).cast("double")

    return F.when(F.size(sums) > 0, F.when(digits(1).carry >= 0, number(digits(1), "")).otherwise(number(digits(-1), "-")))


def ratio(num: Column, den: Column) -> Column:
    """num / den as doubles."""
    return num.cast("double") / den.cast("double")


def ratio_or_zero(num: Column, den: Column) -> Column:
    """num / den, 0.0 when den <= 0."""
    return F.when(den > 0, ratio(num, den)).otherwise(F.lit(0.0))
