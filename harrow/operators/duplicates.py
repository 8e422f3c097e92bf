"""Repeated facts: summing, listing and auditing them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrow.settings import HarmonizeError


def _keys(df: DataFrame, value: str) -> list[str]:
    if value not in df.columns:
        raise HarmonizeError(f"value column '{value}' not found in data")
    return [c for c in df.columns if c != value]


#: Doubles are cut into whole parts of 2^-16 and of 2^-69; what is too large or too fine for that is summed as doubles.
_HIGH, _LOW = 2.0**16, 2.0**53


def exact_sum(value: str) -> Column:
    """A sum of doubles with all their bits, which doesn't depend on the order of rows where the parts are whole.

    A single value stays as it is, and a group of nulls alone is null.  All sums are combined before the shuffle.
    """
    x = F.col(value)
    fits = F.coalesce(F.abs(x) < 2.0**36, F.lit(False))
    high = F.when(fits, F.floor(x * _HIGH))
    low = F.when(fits, (x * _HIGH - high.cast("double")) * _LOW)
    whole = F.count_if(low == F.floor(low).cast("double")) == F.count(x)
    parts = F.try_add(F.try_multiply(F.try_sum(high.cast("decimal(20,0)")), F.lit(2**53).cast("decimal(18,0)")), F.try_sum(F.floor(low).cast("decimal(20,0)")))
    exact = parts.cast("double") / F.lit(_HIGH * _LOW)
    return F.when(F.count(x) == 1, F.max(x)).otherwise(F.coalesce(F.when(whole, exact), F.sum(x)))


def sum_duplicates(df: DataFrame, value: str = "value") -> DataFrame:
    """Rows that agree in all columns but the value as one row with their sum; a group of nulls stays null and a row alone as it is."""
    keys = _keys(df, value)
    return (df.groupBy(*keys) if keys else df).agg(exact_sum(value).alias(value)).select(*df.columns)


def _sizes(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    return df.groupBy(*[F.col(c).alias(f"__{name}_{i}") for i, c in enumerate(keys)]).agg(F.count("*").alias(f"__{name}")).where(F.col(f"__{name}") > 1)


def _same(df: DataFrame, keys: list[str], name: str) -> Column:
    """Null-safe equality of all keys."""
    out: Column = F.lit(True)
    for i, c in enumerate(keys):
        out = out & df[c].eqNullSafe(F.col(f"__{name}_{i}"))
    return out


def duplicate_rows(df: DataFrame, value: str = "value") -> DataFrame:
    """The rows of every group of more than one that :func:`sum_duplicates` sums.

    Group sizes are counted before the shuffle and only those over one are joined back, so a
    group of any size never meets in one task.
    """
    keys = _keys(df, value)
    if not keys:
        return df.limit(0)
    return df.join(_sizes(df, keys, "n"), _same(df, keys, "n"), "left_semi")


def duplicate_audit(df: DataFrame, value: str = "value") -> DataFrame:
    """The same rows with ``dup_full`` (equal in all columns) and ``dup_excl_value`` (always true)."""
    for flag in ("dup_full", "dup_excl_value"):
        if flag in df.columns:
            raise HarmonizeError(f"the frame already has a column '{flag}'")
    keys = [c for c in df.columns if c != value]
    if not keys:
        return df.limit(0).withColumns({"dup_full": F.lit(True), "dup_excl_value": F.lit(True)})
    repeated = df.join(_sizes(df, keys, "n"), _same(df, keys, "n"), "left_semi")
    if value not in df.columns:
        return repeated.withColumns({"dup_full": F.lit(True), "dup_excl_value": F.lit(True)})
    full = _sizes(df, df.columns, "f")
    flagged = repeated.join(full, _same(repeated, df.columns, "f"), "left")
    return flagged.select(*[repeated[c] for c in df.columns], F.col("__f").isNotNull().alias("dup_full"), F.lit(True).alias("dup_excl_value"))
