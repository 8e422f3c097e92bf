"""Validation of long facts and the audit of their columns."""

from __future__ import annotations

import warnings
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from harrow.functions import numbers, text
from harrow.operators.frames import diagonal_union
from harrow.operators.places import places_in_groups
from harrow.settings import AUDIT_COLUMNS, BASE_COLUMNS, CANONICAL_COLUMNS, HarmonizeError
from harrow.workspace import Workspace

FIRST_YEAR = 1900
MANDATORY, YEAR, DUPLICATE = 1, 2, 3
FINDINGS = "row_index long, audit_column string, audit_type string, audit_message string"
FINDING_MESSAGES = {"character_non_empty": "value must be a non-empty character string", "numeric_string": "value must be a numeric string"}


def numbered(df: DataFrame, order: list[str], workspace: Workspace | None = None) -> DataFrame:
    """``df`` in the order of files by first appearance, with ``_file_rank``, ``_row_in_file`` and ``_global_row``.

    ``order`` gives each row's place.  Rows are sorted and numbered by ranges, so a file of any size is spread over all tasks.
    """
    rows = places_in_groups(df, "file", order, workspace or Workspace(df.sparkSession, "numbered"))
    return rows.withColumnsRenamed({"_rank": "_file_rank", "_in_group": "_row_in_file", "_place": "_global_row"})


def _error(kind: int, a: Column, b: Column, message: Column) -> list[Column]:
    return [F.col("_file_rank").cast("long").alias("file_rank"), F.lit(kind).cast("long").alias("type_rank"), a.cast("long").alias("key_a"), b.cast("long").alias("key_b"), message.alias("message")]


def mandatory_errors(rows: DataFrame, required: tuple[str, ...]) -> DataFrame:
    """One error for each null or empty value of a required column, in one pass over the rows."""
    checks = [F.struct(F.lit(i).alias("a"), F.lit(c).alias("c"), (F.col(c).isNull() | (F.col(c) == "")).alias("bad")) for i, c in enumerate(required, 1)]
    found = rows.withColumn("_check", F.explode(F.filter(F.array(*checks), lambda x: x["bad"])))
    message = F.format_string("missing mandatory value in document '%s', row_id '%s', column '%s'", F.coalesce("file", F.lit("NA")), F.col("_row_in_file").cast("string"), F.col("_check.c"))
    return found.select(*_error(MANDATORY, F.col("_check.a"), F.col("_global_row"), message))


def year_errors(rows: DataFrame, last_year: int) -> DataFrame:
    """Errors for each file's distinct years and year ranges outside ``FIRST_YEAR`` to ``last_year`` or in the wrong order."""
    years = rows.where(F.col("year").isNotNull() & (F.col("year") != "")).groupBy("_file_rank", "year").agg(F.min("_global_row").alias("_at"))
    single, pair = F.col("year").rlike(r"^\d{4}$"), F.col("year").rlike(r"^\d{4}-\d{4}$")
    start, end = F.substring("year", 1, 4).try_cast("int"), F.substring("year", 6, 4).try_cast("int")
    limits = f"[{FIRST_YEAR}, {last_year}]"
    outside = lambda y: (y < FIRST_YEAR) | (y > last_year)
    kinds = F.array(
        F.struct(F.lit(1).alias("b"), (single & outside(start)).alias("bad"), F.format_string(f"year value '%s' is outside plausible range {limits}", F.col("year")).alias("m")),
        F.struct(F.lit(1).alias("b"), (pair & (start > end)).alias("bad"), F.format_string("year range '%s' has start year greater than end year", F.col("year")).alias("m")),
        F.struct(F.lit(2).alias("b"), (pair & ((start < FIRST_YEAR) | (end > last_year))).alias("bad"), F.format_string(f"year range '%s' contains year outside plausible range {limits}", F.col("year")).alias("m")),
    )
    found = years.withColumn("_k", F.explode(F.filter(kinds, lambda x: x["bad"])))
    return found.select(*_error(YEAR, F.col("_at"), F.col("_k.b"), F.col("_k.m")))


def duplicate_errors(rows: DataFrame) -> DataFrame:
    """One error for each group of rows that agree in all canonical columns, in order of appearance."""
    keys = [c for c in CANONICAL_COLUMNS if c in rows.columns]
    groups = rows.groupBy(*keys).agg(F.count("*").alias("_count"), F.min("_global_row").alias("_at"), F.min("_file_rank").alias("_file_rank")).where("_count > 1")
    shown = [F.concat(F.lit(f"{c} = "), F.coalesce(F.col(c).cast("string"), F.lit("NA"))) for c in keys]
    message = F.concat(F.lit("duplicate entries detected (count "), F.col("_count").cast("string"), F.lit(") for "), F.concat_ws(", ", *shown))
    return groups.select(*_error(DUPLICATE, F.col("_at"), F.lit(1), message))


def validate_long(df: DataFrame, order: list[str], required: tuple[str, ...] = BASE_COLUMNS, current_year: int | None = None, workspace: Workspace | None = None) -> tuple[DataFrame, DataFrame]:
    """``df`` with all required columns, and its errors ``file_rank, type_rank, key_a, key_b, message``.

    ``order`` names the columns that give the rows' places.  Errors are ordered by their four ranks; missing values come first in a
    file, then years, then repeated rows.
    """
    if "file" not in df.columns or not required:
        raise HarmonizeError("validation needs a 'file' column and required columns")
    if "year" not in df.columns:
        raise HarmonizeError("validation needs a 'year' column")
    missing = {c: F.lit(None).cast("string") for c in required if c not in df.columns}
    df = df.withColumns(missing) if missing else df
    rows = numbered(df, order, workspace)
    last = (current_year if current_year is not None else date.today().year) + 1
    errors = diagonal_union([mandatory_errors(rows, required), year_errors(rows, last), duplicate_errors(rows)])
    if workspace is not None:  # a sort looks at its rows twice, and these take several passes to find
        errors = workspace.save(errors, "errors")
    return df, errors.orderBy("file_rank", "type_rank", "key_a", "key_b")


def _finding(column: str, kind: str, bad: Column) -> Column:
    return F.struct(F.lit(column).alias("audit_column"), F.lit(kind).alias("audit_type"), F.lit(FINDING_MESSAGES[kind]).alias("audit_message"), bad.alias("bad"))


def non_empty_check(column: str) -> Column:
    c = F.col(column).cast("string")
    return _finding(column, "character_non_empty", F.coalesce(text.is_blank(c), F.lit(True)))


def numeric_check(column: str) -> Column:
    c = F.col(column).cast("string")
    return _finding(column, "numeric_string", F.coalesce(~numbers.is_plain_number(c), F.lit(False)))


#: Audit types by name; more can be added.
CHECKS = {"character_non_empty": non_empty_check, "numeric_string": numeric_check}


def audit_plan(columns: list[str], audit_columns: tuple[str, ...] = AUDIT_COLUMNS) -> dict[str, list[str]]:
    plan = {"character_non_empty": list(dict.fromkeys(audit_columns))}
    return plan | ({"numeric_string": ["value"]} if "value" in columns else {})


def audit_findings(df: DataFrame, row_index: str, plan: dict[str, list[str]], only: list[str] | None = None) -> DataFrame:
    """The findings of all checks in one pass: ``row_index, audit_column, audit_type, audit_message``."""
    unknown = [k for k in plan if k not in CHECKS]
    if unknown:
        warnings.warn(f"unsupported audit types were skipped: {', '.join(unknown)}", stacklevel=2)
    wanted = [(k, c) for k in plan if k in CHECKS and (only is None or k in only) for c in plan[k]]
    absent = [c for _, c in wanted if c not in df.columns]
    if absent:
        raise HarmonizeError(f"columns are missing from the dataset: {', '.join(absent)}")
    if not wanted:
        return df.sparkSession.createDataFrame([], FINDINGS)
    found = F.explode(F.filter(F.array(*[CHECKS[k](c) for k, c in wanted]), lambda x: x["bad"]))
    return df.select(F.col(row_index).cast("long").alias("row_index"), found.alias("f")).select("row_index", "f.audit_column", "f.audit_type", "f.audit_message")


def parse_values(df: DataFrame, column: str = "value") -> DataFrame:
    """``df`` with the value column as a double; what isn't a number becomes null and the row stays."""
    if column not in df.columns or not isinstance(df.schema[column].dataType, StringType):
        return df.withColumn(column, F.col(column).cast("double")) if column in df.columns else df
    return df.withColumn(column, numbers.parse_double(F.col(column)))
