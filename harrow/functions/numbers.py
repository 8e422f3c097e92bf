"""Numbers in text: strict parsing and rendering at 15 significant digits."""

from __future__ import annotations

import math
from decimal import ROUND_HALF_EVEN, Context, Decimal

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_FLOAT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_DIGITS = Context(prec=15, rounding=ROUND_HALF_EVEN)


def parse_double(c: Column) -> Column:
    """A double for a plain decimal or scientific number, else null; blanks around it are not allowed."""
    return F.when(c.rlike(_FLOAT), c.try_cast("double"))


def parse_padded_double(c: Column) -> Column:
    """:func:`parse_double` after trimming white space."""
    return parse_double(F.regexp_replace(c, r"^\s+|\s+$", ""))


def is_plain_number(c: Column) -> Column:
    """Digits with at most one decimal point: what the audit accepts."""
    return c.rlike(r"^[0-9]+(\.[0-9]+)?$")


def format_value(x: float | None) -> str | None:
    """One double in fixed notation with at most 15 significant digits; a NaN is null."""
    if x is None or math.isnan(x):
        return None
    if math.isinf(x):
        return "Inf" if x > 0 else "-Inf"
    text = format(_DIGITS.create_decimal(Decimal(x)), "f")
    text = text.rstrip("0").rstrip(".") if "." in text else text
    return "0" if text in ("-0", "") else text


@F.pandas_udf(StringType())
def format_double(values: pd.Series) -> pd.Series:
    """:func:`format_value` over a column, once for each distinct value of a batch."""
    found = {x: format_value(float(x)) for x in values.dropna().unique()}
    return values.map(found).astype(object).where(values.notna(), None)


def double_text(c: Column) -> Column:
    """A double as fixed-notation text with at least one decimal, as rules on numeric columns spell it."""
    # the shortest digits that give the same double, padded with zeros
    fixed = lambda places: F.regexp_replace(F.format_string(f"%.{places}f", c), r"(\.[0-9]+?)0+$", "$1")
    return F.when(F.abs(c) >= 1e7, fixed(12)).when((F.abs(c) < 1e-3) & (c != 0), fixed(345)).otherwise(c.cast("string"))
