"""From wide sheets to long facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrow.functions import text
from harrow.operators.frames import drop_null_values
from harrow.operators.headers import clean_year_names, year_columns
from harrow.settings import BASE_COLUMNS, COMMODITY_START, KEY_TEXT_COLUMNS, UNKNOWN_COMMODITY, HarmonizeError


def non_blank_base_rows(df: DataFrame, base: tuple[str, ...] = BASE_COLUMNS) -> DataFrame:
    """Rows with text in at least one base column; none if there are no base columns."""
    keep: Column = F.lit(False)
    for c in base:
        keep = keep | (F.col(c).isNotNull() & ~F.coalesce(F.length(F.regexp_replace(c, r"^\s+|\s+$", "")) == 0, F.lit(True)))
    return df.where(keep)


def normalize_keys(df: DataFrame, commodity: str | Column, base: tuple[str, ...] = BASE_COLUMNS) -> DataFrame:
    """Missing base columns as nulls, ``commodity`` set, and the key columns and footnotes normalized; ``unit`` stays."""
    df = df.withColumns({c: F.lit(None).cast("string") for c in base if c not in df.columns}) if set(base) - set(df.columns) else df
    name = F.lit(text.normalize_value(commodity)) if isinstance(commodity, str) else F.coalesce(text.normalize(commodity), F.lit(""))
    keys = [c for c in (*KEY_TEXT_COLUMNS, "footnotes") if c in df.columns]
    return df.withColumns({"commodity": name, **{c: text.normalize(F.col(c)) for c in keys}})


def commodity_name(c: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(UNKNOWN_COMMODITY))


def to_long(df: DataFrame) -> DataFrame:
    """One row for each row and year column, with ``year`` and ``value`` as text; null values stay."""
    years = year_columns(df.columns)
    if not years:
        raise HarmonizeError("the frame has no year columns")
    ids = [c for c in df.columns if c not in years]
    return df.withColumns({y: F.col(y).cast("string") for y in years}).unpivot(ids, years, "year", "value")


def with_provenance(df: DataFrame, file: Column, yearbook: Column) -> DataFrame:
    return df.withColumns({"file": file, "notes": F.lit(None).cast("string"), "yearbook": yearbook})


def transform_wide(df: DataFrame, file: str, yearbook: str, commodity: str, drop_nulls: bool = True) -> tuple[DataFrame, DataFrame]:
    """One file's wide rows with normalized keys and clean year headers, and the same as long rows."""
    if not (file and yearbook and commodity):
        raise HarmonizeError("file, yearbook and commodity must not be empty")
    wide = normalize_keys(df, commodity)
    wide = wide.toDF(*clean_year_names(wide.columns))
    long = with_provenance(to_long(wide), F.lit(file), F.lit(yearbook))
    return wide, drop_null_values(long, enabled=drop_nulls)


def file_metadata(paths: DataFrame, column: str = "file_path") -> DataFrame:
    """``file_path, file_name, commodity, yearbook, is_ascii, error_message`` from paths whose names are ``_``-separated parts."""
    name = F.element_at(F.split(column, "/"), -1)
    parts = F.split(F.col("file_name"), "_")
    year = F.get(F.filter(parts, lambda p: p.rlike(r"^\d{4}$")), F.lit(0))
    last = F.regexp_replace(F.element_at(parts, -1), r"\.[^.]+$", "")
    tail = F.concat(F.slice(parts, COMMODITY_START, F.greatest(F.size(parts) - COMMODITY_START, F.lit(0))), F.array(last))
    ascii_only = F.col("file_name").rlike(r"\A[\x00-\x7F]*\z")
    return (
        paths.select(F.col(column).alias("file_path"), name.alias("file_name"))
        .withColumn("commodity", F.when(F.size(parts) >= COMMODITY_START, F.array_join(tail, "_")))
        .withColumn("yearbook", F.when((F.size(parts) >= 2) & year.isNotNull(), F.concat_ws("_", F.get(parts, F.lit(0)), year)))
        .withColumn("is_ascii", ascii_only)
        .withColumn("error_message", F.when(~ascii_only, F.concat(F.lit("non-ascii file name detected: "), F.col("file_name"))))
    )
