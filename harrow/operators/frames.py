"""Operators on whole frames: ordering, canonical cells, empty columns, unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from harrow.functions import text
from harrow.settings import CANONICAL_COLUMNS, HarmonizeError


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def canonical_cells(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Every ``;``-separated cell of the text columns in canonical form: distinct tokens in order, null when blank."""
    return df.withColumns({c: text.canonical_cell(F.col(c)) for c in (string_columns(df) if columns is None else columns)})


def canonical_order(df: DataFrame) -> DataFrame:
    """Sorted by the canonical columns that are present, nulls last.

    A range sort over all keys; frames without any of them stay as they are.
    """
    keys = [F.col(c).asc_nulls_last() for c in CANONICAL_COLUMNS if c in df.columns]
    return df.orderBy(*keys) if keys else df


def drop_null_values(df: DataFrame, column: str = "value", enabled: bool = True) -> DataFrame:
    return df.where(F.col(column).isNotNull()) if enabled and column in df.columns else df


def null_columns(df: DataFrame) -> list[str]:
    """Columns without a value, in one pass; none where the frame is empty or has no value at all."""
    counts = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(F.col(c)).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    empty = [c for i, c in enumerate(df.columns) if counts[f"c{i}"] == 0]
    return [] if counts["rows"] == 0 or len(empty) == len(df.columns) else empty


def drop_null_columns(df: DataFrame) -> DataFrame:
    return df.drop(*null_columns(df))


def diagonal_union(frames: list[DataFrame]) -> DataFrame:
    """All rows, by column name; columns that a frame lacks are null."""
    if not frames:
        raise HarmonizeError("nothing to combine")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def consolidate(frames: list[DataFrame]) -> DataFrame:
    """The canonical columns in order, further ones last; ``iso_whep`` starts as the prefix and the row's year."""
    df = diagonal_union(frames)
    missing = {c: F.lit(None).cast("string") for c in CANONICAL_COLUMNS if c not in df.columns}
    df = df.withColumns(missing) if missing else df
    seeded = F.concat(F.lit("iso-"), F.col("year"))
    df = df.withColumn("iso_whep", seeded if "iso_whep" in missing else F.col("iso_whep"))
    return df.select(*CANONICAL_COLUMNS, *[c for c in df.columns if c not in CANONICAL_COLUMNS])
