"""Places of rows in an order, for tables of any size.

Rows are sorted by ranges over all tasks and written once.  Each range is counted, and the sums over the ranges before it
give its rows their places, so no window and no task ever holds more than a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harrow.workspace import Workspace

RANGE, AT = "__range", "__at"


def in_ranges(df: DataFrame, order: list[str | Column], workspace: Workspace) -> DataFrame:
    """``df`` sorted by ranges, written to the shared folder, with the number of each row's range and a number that rises inside it."""
    # without a number, so that small neighbouring ranges are read as one
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return workspace.save(rows.withColumns({RANGE: F.spark_partition_id(), AT: F.monotonically_increasing_id()}), "ranges")


def _before(sizes: DataFrame, count: str) -> Column:
    """The sum of a count over all earlier ranges; ``sizes`` has one row a range."""
    return F.coalesce(F.sum(count).over(Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def row_numbers(df: DataFrame, order: list[str | Column], name: str, workspace: Workspace) -> DataFrame:
    """``df`` with each row's place in an order, from 1; rows that agree in all of ``order`` come in any order."""
    rows = in_ranges(df, order, workspace)
    sizes = rows.groupBy(RANGE).agg(F.count("*").alias("n"), F.min(AT).alias("first"))
    shifts = sizes.select(F.col(RANGE).alias("__of"), (_before(sizes, "n") + 1 - F.col("first")).alias("__shift"))
    return rows.join(F.broadcast(shifts), F.col(RANGE) == F.col("__of")).withColumn(name, F.col(AT) + F.col("__shift")).drop(RANGE, AT, "__of", "__shift")


def sums_before(df: DataFrame, order: list[str | Column], sums: dict[str, str], workspace: Workspace) -> DataFrame:
    """``df`` with, for each ``new: column`` of ``sums``, the sum of the column over all rows before in the order."""
    rows = in_ranges(df, order, workspace)
    totals = rows.groupBy(RANGE).agg(*[F.sum(c).alias(f"__{new}") for new, c in sums.items()])
    bases = totals.select(F.col(RANGE).alias("__of"), *[_before(totals, f"__{new}").alias(f"__{new}") for new in sums])
    inside = Window.partitionBy(RANGE).orderBy(AT).rowsBetween(Window.unboundedPreceding, -1)
    own = {new: F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"__{new}") for new, c in sums.items()}
    return rows.join(F.broadcast(bases), F.col(RANGE) == F.col("__of")).withColumns(own).drop(RANGE, AT, "__of", *[f"__{new}" for new in sums])


def places_in_groups(df: DataFrame, group: str, order: list[str], workspace: Workspace) -> DataFrame:
    """``df`` with ``_rank`` of its group by first appearance in ``order``, ``_in_group`` inside it, and ``_place`` over all, from 1.

    Groups whose first rows agree in all of ``order`` rank by their names, nulls first.

    A group, nulls being one, may hold any share of the rows: it is cut into ranges like everything else.  The tables
    beside the rows have a row for each group and range that meet, and one for each group.
    """
    rows = in_ranges(df, [group, *order], workspace)
    parts = rows.groupBy(RANGE, group).agg(F.count("*").alias("n"), F.min(AT).alias("start"), F.min(F.struct(*order)).alias("first"))
    parts = workspace.save(parts, "parts")
    firsts = parts.groupBy(group).agg(F.sum("n").alias("n"), F.min("first").alias("first")).withColumn("one", F.lit(1).cast("long"))
    groups = sums_before(firsts, ["first", group], {"__base": "n", "__earlier": "one"}, workspace)
    # a group's parts are as many as its ranges
    earlier_parts = Window.partitionBy("__g").orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        parts.select(F.col(RANGE).alias("__r"), F.col(group).alias("__g"), "n", "start")
        .withColumn("__own", F.coalesce(F.sum("n").over(earlier_parts), F.lit(0)) + 1 - F.col("start"))
        .join(groups.select(F.col(group).alias("__h"), "__base", "__earlier"), F.col("__g").eqNullSafe(F.col("__h")))
        .select("__r", "__g", "__own", "__base", (F.col("__earlier") + 1).alias("_rank"))
    )
    numbered = rows.join(shifts, (F.col(RANGE) == F.col("__r")) & F.col(group).eqNullSafe(F.col("__g")))
    numbered = numbered.withColumn("_in_group", F.col(AT) + F.col("__own")).withColumn("_place", F.col("__base") + F.col("_in_group"))
    return numbered.drop(RANGE, AT, "__r", "__g", "__own", "__base")
