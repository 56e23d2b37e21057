"""Numbers from text, and rounding that is the same in every SQL engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.functions.text import strip

# A plain decimal number. Casting alone would also take "1d", "2f" and "NaN".
NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
INTEGER = r"^[+-]?[0-9]+$"

# Currency sign and digit separator dropped from money texts.
CURRENCY_SIGN = "₹"
DIGIT_SEPARATOR = ","


def parse_number(text: Column) -> Column:
    """Double from stripped text; null when the text is not a plain number."""
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def money_text(text: Column) -> Column:
    """Money text without currency sign and digit separators, stripped."""
    for drop in (CURRENCY_SIGN, DIGIT_SEPARATOR):
        text = F.replace(text, F.lit(drop), F.lit(""))
    return strip(text)


def not_negative(number: Column, data_type: T.DataType) -> Column:
    """The number, or 0 when it is null, not a number, or negative."""
    zero = F.lit(0).cast(data_type)
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        number = F.nanvl(number, zero)
    return F.greatest(F.coalesce(number, zero), zero)


def round2(col: Column) -> Column:
    """Double rounded to 2 decimals, half away from zero, in IEEE steps any engine repeats."""

    def half_up(positive: Column) -> Column:
        return F.floor(positive * F.lit(100.0) + F.lit(0.5)).cast("double") / F.lit(100.0)

    return F.when(col < 0, -half_up(-col)).otherwise(half_up(col))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Rounded quotient, null when the denominator is 0."""
    return round2(F.try_divide(numerator.cast("double"), denominator.cast("double")))


def share_pct(part: Column, total: Column) -> Column:
    """Rounded percentage of ``total``, null when the total is 0."""
    return round2(F.try_divide(part.cast("double") * F.lit(100.0), total.cast("double")))
