"""Column expressions shared by the plans. All are built-in functions inside codegen."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchantlake import contract as C


def month_keys(ts: Column) -> list[Column]:
    """Year and month as numbers: cheaper to group by than a label made for every row."""
    return [F.year(ts).alias("year"), F.month(ts).alias("month")]


def month_label(year: Column, month: Column) -> Column:
    """``yyyy-MM``; null stays null."""
    return F.date_format(F.make_date(year, month, F.lit(1)), "yyyy-MM")


def month_start(ts: Column) -> Column:
    return F.date_trunc("month", ts)


def hour_of(ts: Column) -> Column:
    return F.hour(ts)


def city_label(city: Column) -> Column:
    """``City_<id>``; a null city stays null."""
    return F.concat(F.lit(C.CITY_PREFIX), city.cast("string"))


def exact_sum(amount: Column, digits: int = C.MONEY_DIGITS) -> Column:
    """Order-independent sum of amounts, as a decimal with ``digits`` after the point.

    Whole units and groups of digits are added as integers, which costs a small part
    of adding decimals. An amount that is no number, too large, or has more digits
    than are kept is an error: nothing is rounded away in silence.
    """
    unit = 10**digits
    whole = amount.cast("bigint")
    rest = F.rint((amount - whole) * float(unit)).cast("bigint")
    # Numbers of units below 2**53 are exact as doubles; others are compared as decimals.
    near = (whole.cast("double") * unit + rest) / F.lit(float(unit)) == amount
    far = (whole.cast("decimal(20,0)") + rest.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-digits))).cast("double") == amount
    kept = F.when(F.abs(whole) < 2**53 // unit, near).otherwise(far)
    message = F.concat(F.lit(f"more than {digits} digits after the point: "), amount.cast("string"))
    rest = F.when(kept | amount.isNull(), rest).otherwise(F.raise_error(message).cast("bigint"))
    # Narrow types: a sum of wide decimals would lose digits to make room.
    total = F.sum(whole).cast("decimal(20,0)")
    for place in range(0, digits, 4):
        width = min(4, digits - place)
        lower = 10 ** (digits - place - width)
        group = (rest / lower).cast("bigint")
        rest = rest - group * lower
        total = total + F.sum(group).cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-place - width))
    return total.cast(T.DecimalType(38, digits))


def dearer(amount: Column, units: int) -> Column:
    """``amount`` and so many whole units, added as decimals: as doubles, 2047.36 and 1 give more digits than either has.

    An amount that is no number, or has more digits than are kept, stays one.
    """
    exact = amount.try_cast(T.DecimalType(30, C.MONEY_DIGITS))
    return F.when(exact.cast("double") == amount, (exact + units).cast("double")).otherwise(amount + units)


def money_sum(amount: Column) -> Column:
    return exact_sum(amount).cast("double")


def sum_of_totals(total: Column) -> Column:
    """Sum of a few totals, as a decimal."""
    return F.sum(total.cast(C.TOTALS))


def ratio(part: Column, whole: Column) -> Column:
    """Division that gives null, not an error, when there is nothing to divide by."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def letter_rank(letter: Column) -> Column:
    """A is best (1), E is worst (5); anything else is null."""
    return F.nullif(
        F.array_position(F.array(*map(F.lit, C.RANGE_LETTERS)), F.upper(F.trim(letter))),
        F.lit(0),
    )


def is_financed(installments: Column) -> Column:
    """Null, zero and negative installments all mean a single payment."""
    return F.coalesce(installments > 0, F.lit(False))


def financing(financed: Column) -> Column:
    return F.when(financed, F.lit(C.FINANCED)).otherwise(F.lit(C.NOT_FINANCED))


def financed_revenue(amount: Column) -> Column:
    """What is expected back: the full amount, or half of it when the buyer defaults."""
    return F.lit(1.0 - C.DEFAULT_RATE) * amount + (
        F.lit(C.DEFAULT_RATE) * F.lit(C.PAID_BEFORE_DEFAULT) * amount
    )


def financed_profit(amount: Column) -> Column:
    return financed_revenue(amount) * F.lit(C.GROSS_MARGIN)


def single_payment_profit(amount: Column) -> Column:
    return amount * F.lit(C.GROSS_MARGIN)


def installments_recommended(amount: Column) -> Column:
    """Expected profit reaches the tolerated part of the ideal one; null means no."""
    return F.coalesce(financed_profit(amount) >= C.PROFIT_TOLERANCE * single_payment_profit(amount), F.lit(False))
