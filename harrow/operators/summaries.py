"""Which rules were used and which were not."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.functions import text
from harrow.operators.units import conversion_table
from harrow.rules.table import RuleFile
from harrow.settings import CATALOG, STAGE_ORDER, STAGE_SUMMARY, STANDARDIZE_CATALOG, STANDARDIZE_ORDER, STANDARDIZE_SUMMARY, UNMATCHED_KEY

_NUMERIC = ("unit_factor", "unit_offset", "detected_prefix", "unit_factor_effective")


def without_matches(left: DataFrame, right: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows of ``left`` for whose keys ``right`` has no row; nulls are equal to nulls."""
    known = right.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return left.join(known, condition, "left_anti")


def _typed(df: DataFrame, columns: tuple[str, ...], longs: tuple[str, ...] = ("loop", "affected_rows"), doubles: tuple[str, ...] = ()) -> DataFrame:
    kind = lambda c: "long" if c in longs else "double" if c in doubles else "string"
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(kind(c)).alias(c) for c in columns])


def _sorted(df: DataFrame, order: tuple[str, ...]) -> DataFrame:
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order])


def summarize_stage(audit: DataFrame) -> DataFrame:
    """A stage's audit as the nine summary columns, in order."""
    for kind in ("source", "target"):
        if f"value_{kind}" not in audit.columns and f"value_{kind}_result" in audit.columns:
            audit = audit.withColumn(f"value_{kind}", F.col(f"value_{kind}_result"))
    return _sorted(_typed(audit, STAGE_SUMMARY).na.fill(0, ["affected_rows"]), STAGE_ORDER)


def rule_catalog(spark: SparkSession, files: list[RuleFile]) -> DataFrame:
    """All distinct rules that say anything, blanks as nulls."""
    blank = lambda v: v if v is not None and v.strip(text.BLANKS) else None
    rows = [tuple([f.name, *[blank(r.get(c)) for c in CATALOG[1:]]]) for f in files for r in f.raw]
    rows = [r for r in dict.fromkeys(rows) if any(v is not None for v in r[1:])]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in CATALOG))


def unmatched_rules(catalog: DataFrame, matched: DataFrame) -> DataFrame:
    """Catalog rules that never matched, with no affected rows."""
    rest = without_matches(_typed(catalog, CATALOG).distinct(), _typed(matched, UNMATCHED_KEY), UNMATCHED_KEY)
    zero = F.lit(0).cast("long")
    return _sorted(rest.withColumns({"loop": zero, "affected_rows": zero}).select(*STAGE_SUMMARY), STAGE_ORDER)


def merge_stage_summaries(matched: DataFrame, unmatched: DataFrame) -> DataFrame:
    return _sorted(matched.unionByName(unmatched.na.fill(0, ["loop"])), STAGE_ORDER)


def _standardize_typed(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    df = _typed(df, columns, doubles=_NUMERIC)
    texts = [c for c in columns if c not in _NUMERIC and c != "affected_rows"]
    return df.withColumns({c: text.blank_to_null(F.col(c)) for c in texts})


def summarize_standardize(audit: DataFrame) -> DataFrame:
    return _sorted(_standardize_typed(audit, STANDARDIZE_SUMMARY).na.fill(0, ["affected_rows"]), STANDARDIZE_ORDER)


def standardize_catalog(spark: SparkSession, rules: list[dict]) -> DataFrame:
    table = conversion_table(spark, rules).withColumnRenamed("source_rule_file", "rule_file_identifier")
    known = F.col("commodity_key").isNotNull() | F.col("unit_source").isNotNull() | F.col("unit_target").isNotNull()
    return _standardize_typed(table, STANDARDIZE_CATALOG).where(known).distinct()


def unmatched_standardize(catalog: DataFrame, matched: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Conversion rules that converted nothing; by normalized keys where counts are given, else by all columns."""
    if counts is not None and not counts.isEmpty():
        keys = counts.select(text.normalize(F.col("rule_commodity_match_key")).alias("__c"), text.normalize(F.col("unit_source_key")).alias("__u")).distinct()
        own = (text.normalize(F.col("commodity_key")) == F.col("__c")) & (text.normalize(F.col("unit_source")) == F.col("__u"))
        rest = catalog.join(keys, own, "left_anti")
    else:
        rest = without_matches(catalog, _standardize_typed(matched, STANDARDIZE_CATALOG), STANDARDIZE_CATALOG)
    return _sorted(rest.withColumn("affected_rows", F.lit(0).cast("long")).select(*STANDARDIZE_SUMMARY), STANDARDIZE_ORDER)


def merge_standardize_summaries(matched: DataFrame, unmatched: DataFrame) -> DataFrame:
    return _sorted(matched.unionByName(unmatched), STANDARDIZE_ORDER)
