"""Strict and lenient number handling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE_TYPE = "decimal(10,2)"
AMOUNT_DECIMALS = 18
AMOUNT_TYPE = f"decimal(38,{AMOUNT_DECIMALS})"
# Sign, digits, fraction (group 1) and exponent (group 2).
NUMBER = r"^\s*[+-]?(?=\d|\.\d)\d*+(?:\.(\d*))?(?:[eE]([+-]?\d+))?\s*$"


def price_strict(price: Column) -> Column:
    """Text to money; bad text fails the job (ANSI cast), null stays null."""
    return price.cast(PRICE_TYPE)


def price_lenient(price: Column) -> Column:
    """Text to double; null or unparsable text counts as zero."""
    return F.coalesce(price.try_cast("double"), F.lit(0.0))


def decimal_or_null(text: Column) -> Column:
    """Text to an exact decimal, null where it is no number or has too many digits to be held exactly."""
    fraction = F.length(F.rtrim(F.regexp_extract(text, NUMBER, 1), F.lit("0")))
    exponent = F.coalesce(F.regexp_extract(text, NUMBER, 2).try_cast("int"), F.lit(0))
    # In 64 bits: an exponent of any size is no reason to fail.
    exact = fraction.cast("long") - exponent.cast("long") <= AMOUNT_DECIMALS
    return F.when(exact, text.try_cast(AMOUNT_TYPE))


def is_number(text: Column) -> Column:
    """Whether a text is a number at all, of whatever size."""
    return text.rlike(NUMBER)


def guarded_ratio(top: Column, bottom: Column) -> Column:
    """Division in doubles, null for a zero divisor."""
    return top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))
