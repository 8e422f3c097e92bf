"""Distinct cells and their way back into the rows.

What depends on a few cells alone is worked out once for each distinct combination of them, counted before the shuffle,
and joined back.  The counts tell which combinations are hot: these few are broadcast, the rest is joined plainly, with
the rows of hot ones dealt out evenly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructType

from harrow.workspace import Workspace

#: A combination is hot from this share of the rows on, so there are fewer than this many, and it has at most so many bytes.
HOT_SHARE, HOT_BYTES = 1000, 4096


def observed(df: DataFrame, label: str, workspace: Workspace, **metrics: Column) -> tuple[DataFrame, dict]:
    """``df`` written and reread, with aggregates that are taken while it is written."""
    seen = Observation()
    saved = workspace.save(df.observe(seen, *[c.alias(k) for k, c in metrics.items()]), label)
    return saved, seen.get


def distinct_cells(df: DataFrame, cells: dict[str, Column], workspace: Workspace, **metrics: Column) -> tuple[DataFrame, dict]:
    """Every combination of ``cells`` with its count ``n``, written once; ``metrics`` are taken of it, besides ``rows``."""
    counted = df.groupBy(*[c.alias(name) for name, c in cells.items()]).agg(F.count("*").alias("n"))
    return observed(counted, "cells", workspace, rows=F.coalesce(F.sum("n"), F.lit(0)), **metrics)


def _bytes(df: DataFrame, columns: list[str]) -> Column:
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c in columns if isinstance(df.schema[c].dataType, StringType)]
    return reduce(Column.__add__, texts, F.lit(0))


def join_back(df: DataFrame, cells: dict[str, Column], found: DataFrame, rows: int, changed: Column | None = None) -> DataFrame:
    """``df`` with the further columns of ``found``, by null-safe equality of its ``cells``.

    ``found`` has a row for each combination with its count ``n``, of ``rows`` in all.  Rows of combinations for which
    ``changed`` isn't true get nulls.  Hot combinations, changed or not, are broadcast; the rest, as large as it may be, is
    joined on the cells, and there the rows that already have their values are dealt out by a hash of the whole row.
    """
    added = [c for c in found.columns if c not in cells and c != "n"]
    wanted = F.lit(True) if changed is None else F.coalesce(changed, F.lit(False))
    small = _bytes(found, [*cells, *added]) <= HOT_BYTES
    is_hot = (F.col("n") * HOT_SHARE > rows) & small
    pick = lambda tag, extra: found.where(extra).select(*[F.col(c).alias(f"__{tag}_{c}") for c in (*cells, *added)], wanted.alias(f"__{tag}"), F.pmod("n", F.lit(1)).alias("__none"))
    hot, cold = pick("hot", is_hot).drop("__none"), pick("cold", ~is_hot & wanted)
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, (ArrayType, MapType, StructType))]
    same = reduce(Column.__and__, [c.eqNullSafe(F.col(f"__hot_{name}")) for name, c in cells.items()])
    met = df.withColumn("__row", F.xxhash64(F.spark_partition_id(), *plain)).join(F.broadcast(hot), same, "left")
    done = F.col("__hot").isNotNull()
    # the cold side's number is always 0, which only its rows tell, so it stays a key of the join
    met = met.withColumn("__deal", F.when(done, F.pmod("__row", F.lit(1 << 30)) + 1).otherwise(F.lit(0).cast("long")))
    keys = [F.when(~done, c).eqNullSafe(F.col(f"__cold_{name}")) for name, c in cells.items()]
    met = met.join(cold, reduce(Column.__and__, keys, F.col("__deal") == F.col("__none")), "left")
    value = lambda c: F.when(F.col("__hot"), F.col(f"__hot_{c}")).otherwise(F.col(f"__cold_{c}"))
    return met.select(*[F.col(f"`{c}`") for c in df.columns], *[value(c).alias(c) for c in added])
