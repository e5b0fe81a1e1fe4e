"""Prices, changes and their text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricetrail.functions.text import collapse_ends

PRICE = "decimal(18,6)"

# A plain number. Spark's cast alone would also take `1d`, `nan` and `inf`.
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def price_number(c: Column, currency_sign: bool = False) -> Column:
    """Price text to a double: thousands commas (and ``$``) dropped, bad text NULL."""
    bare = collapse_ends(F.regexp_replace(c, "[,$]" if currency_sign else ",", ""))
    return F.when(bare.rlike(_NUMBER), bare.try_cast("double"))


def to_price(c: Column) -> Column:
    return c.try_cast(PRICE)


def two_places(c: Column) -> Column:
    """Half-up rounding to cents, on decimals so that ties are exact."""
    return F.round(c.cast("decimal(38,6)"), 2).cast("decimal(18,2)")


def percent_change(start: Column, end: Column) -> Column:
    """Change in percent, NULL from a zero start."""
    s, e = start.cast("double"), end.cast("double")
    return F.try_divide(e - s, s) * F.lit(100.0)


def money_text(c: Column) -> Column:
    """``$1,234.50``"""
    return F.concat(F.lit("$"), F.format_number(c, 2))


def percent_text(c: Column, signed: bool = False) -> Column:
    """``1.23%``, or ``+1.23%`` when signed."""
    body = F.concat(F.call_function("format_number", c, F.lit("0.00")), F.lit("%"))
    if not signed:
        return body
    return F.when(c < 0, body).otherwise(F.concat(F.lit("+"), body))


def price_band(c: Column) -> Column:
    """Price rounded to one place, the height of a label row."""
    return F.round(c.cast(PRICE), 1).cast("decimal(18,1)")
