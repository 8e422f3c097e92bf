"""Unit standardization by affine conversion rules.

A leading number of a unit is folded into the value unless the unit as written has a rule of its
own; then the rule of the row's commodity applies, or else the fallback rule of the unit.
The commodity and the unit alone decide this, so it is done once for each distinct pair of them.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from harrow.functions import numbers, text
from harrow.operators.frames import canonical_cells
from harrow.operators.duplicates import duplicate_rows, sum_duplicates
from harrow.operators.pairs import distinct_cells, join_back, observed
from harrow.settings import CONVERSION_ALIASES, CONVERSION_COLUMNS, FALLBACK_COMMODITY, HarmonizeError
from harrow.workspace import Workspace

# Fixed value: the pattern of a unit with a leading number.
_PREFIX = r"^(\s*[0-9][0-9.,]*(?:[eE][+-]?[0-9]+)?)[ _-]+(.+)$"
PREPARED = (
    "commodity_key string, unit_source string, unit_target string, unit_factor string, unit_offset string, source_rule_sheet string, "
    "source_rule_file string, unit_factor_num double, unit_offset_num double, commodity_match_key string, unit_source_key string"
)
COUNTS = (
    "rule_commodity_match_key", "applied_commodity_match_key", "unit_source_key", "source_unit_raw",
    "rule_multiplier", "detected_prefix", "affected_rows", "unit_factor_effective",
)


def canonical_conversion_names(columns: list[str]) -> dict[str, str]:
    """Which legacy headers are renamed; two for one canonical name are an error."""
    renames = {a: b for a, b in CONVERSION_ALIASES.items() if a in columns and b not in columns}
    twice = [b for b, n in Counter(renames.values()).items() if n > 1]
    if twice:
        raise HarmonizeError(f"conversion rules have several headers for {', '.join(twice)}")
    return renames


def _number(value: object) -> float | None:
    try:
        return float(str(value).strip()) if value is not None else None
    except ValueError:
        return None


def prepare_conversions(rows: list[dict]) -> list[dict]:
    """Checked conversion rules with numeric factors and normalized keys.

    Errors: missing columns or values, repeated keys, factors that aren't finite, and a commodity's rule whose target is
    the source of another of its rules.
    """
    prepared = []
    for row in rows:
        renames = canonical_conversion_names(list(row))
        row = {renames.get(k, k): v for k, v in row.items()}
        missing = [c for c in CONVERSION_COLUMNS if c not in row]
        if missing:
            raise HarmonizeError(f"conversion rules lack columns: {', '.join(missing)}")
        null = [c for c in CONVERSION_COLUMNS if row[c] is None]
        if null:
            raise HarmonizeError(f"conversion rules lack values in: {', '.join(null)}")
        factor, offset = _number(row["unit_factor"]), _number(row["unit_offset"])
        for name, number in (("unit_factor", factor), ("unit_offset", offset)):
            if number is None or not math.isfinite(number):
                raise HarmonizeError(f"conversion {name} values must be finite")
        kept = {c: str(row[c]) for c in CONVERSION_COLUMNS} | {c: row.get(c) for c in ("source_rule_sheet", "source_rule_file")}
        keys = {"commodity_match_key": text.normalize_value(row["commodity_key"]), "unit_source_key": text.normalize_value(row["unit_source"])}
        prepared.append(kept | {"unit_factor_num": factor, "unit_offset_num": offset} | keys)
    sources = Counter((r["commodity_match_key"], r["unit_source_key"]) for r in prepared)
    if any(n > 1 for n in sources.values()):
        raise HarmonizeError("conversion rules repeat a (commodity_key, unit_source) pair after normalization")
    targets = {(r["commodity_match_key"], text.normalize_value(r["unit_target"])) for r in prepared}
    if any(k in sources and k[0] != FALLBACK_COMMODITY for k in targets):
        raise HarmonizeError("conversion rules chain conversions of one commodity; repeated runs would convert twice")
    return prepared


def conversion_table(spark: SparkSession, rules: list[dict]) -> DataFrame:
    names = [f.split()[0] for f in PREPARED.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rules], PREPARED)


@dataclass(frozen=True)
class Standardized:
    """``data`` is the dataset; ``pairs`` has each distinct commodity and unit with its count and its conversion, ``counts`` the rules that were used.

    Of a batch it is known how many ``rows`` there were, how many a rule converted (``matched``), and how many
    have a unit that none matched (``unmatched``).
    """

    data: DataFrame
    pairs: DataFrame
    counts: DataFrame
    rows: int = 0
    matched: int = 0
    unmatched: int = 0

    def matched_and_unmatched(self) -> tuple[int, int]:
        return self.matched, self.unmatched


def non_numeric_values(df: DataFrame, value: str) -> Column:
    c = F.col(value)
    if not isinstance(df.schema[value].dataType, StringType):
        return F.lit(False)
    return c.isNotNull() & (F.trim(c) != "") & numbers.parse_padded_double(c).isNull()


#: What a commodity and a unit alone decide.
DECIDED = ("__key", "__prefix", "__unit", "__matched", "__rule", "__target", "__factor", "__offset")


def convert_units(pairs: DataFrame, rules: list[dict]) -> DataFrame:
    """``pairs`` of ``__c`` and ``__u`` with what the rules make of them: the folded prefix and key, and the rule that applies.

    It needs joins with the broadcast rule table only, so it takes a stream's rows as well as a table of distinct pairs.
    """
    prefix = F.nullif(F.regexp_extract("__u", _PREFIX, 1), F.lit(""))
    base = F.nullif(F.regexp_extract("__u", _PREFIX, 2), F.lit(""))
    number = numbers.parse_padded_double(F.replace(prefix, F.lit(","), F.lit("")))
    rows = pairs.withColumns({"__own": text.normalize(F.col("__u")), "__commodity": text.normalize(F.col("__c")), "__number": number, "__base": base})
    rows = rows.withColumn("__fold", F.coalesce(F.col("__number").isNotNull() & ~F.col("__number").isin(1.0, float("inf")), F.lit(False)))
    if rules:
        table = conversion_table(pairs.sparkSession, rules).select("commodity_match_key", "unit_source_key", "unit_target", F.col("unit_factor_num").alias("factor"), F.col("unit_offset_num").alias("offset"))
        named = lambda p: table.select(*[F.col(c).alias(f"{p}_{c}") for c in table.columns])
        fallback = lambda p: named(p).where(F.col(f"{p}_commodity_match_key") == FALLBACK_COMMODITY).drop(f"{p}_commodity_match_key")
        # a prefixed unit that has a rule as written isn't folded
        rows = rows.join(F.broadcast(named("w").select("w_commodity_match_key", "w_unit_source_key", F.lit(True).alias("w_own"))), F.col("__fold") & (F.col("__commodity") == F.col("w_commodity_match_key")) & (F.col("__own") == F.col("w_unit_source_key")), "left")
        rows = rows.join(F.broadcast(fallback("v").select("v_unit_source_key", F.lit(True).alias("v_any"))), F.col("__fold") & (F.col("__own") == F.col("v_unit_source_key")), "left")
        rows = rows.withColumn("__fold", F.col("__fold") & F.col("w_own").isNull() & F.col("v_any").isNull())
    folded = lambda a, b: F.when(F.col("__fold"), a).otherwise(b)
    rows = rows.withColumns({"__prefix": folded(F.col("__number"), F.lit(1.0)), "__key": folded(text.normalize(F.col("__base")), F.col("__own")), "__unit": folded(F.trim(F.col("__base")), F.col("__u"))})
    if rules:
        rows = rows.join(F.broadcast(named("s")), (F.col("__commodity") == F.col("s_commodity_match_key")) & (F.col("__key") == F.col("s_unit_source_key")), "left")
        rows = rows.join(F.broadcast(fallback("f")), F.col("__key") == F.col("f_unit_source_key"), "left")
        specific = F.col("s_unit_target").isNotNull()
        general = ~specific & F.coalesce(F.col("__key") != "", F.lit(False)) & F.col("f_unit_target").isNotNull()
        pick = lambda c: F.when(specific, F.col(f"s_{c}")).when(general, F.col(f"f_{c}"))
        rows = rows.withColumns({
            "__matched": specific | general, "__rule": F.when(specific, F.col("__commodity")).when(general, F.lit(FALLBACK_COMMODITY)),
            "__target": pick("unit_target"), "__factor": pick("factor"), "__offset": pick("offset"),
        })
    else:
        rows = rows.withColumns({"__matched": F.lit(False), "__rule": F.lit(None).cast("string"), "__target": F.lit(None).cast("string"), "__factor": F.lit(None).cast("double"), "__offset": F.lit(None).cast("double")})
    return rows.select(*pairs.columns, "__commodity", *DECIDED)


def standardize(
    df: DataFrame, rules: list[dict], unit: str = "unit", value: str = "value", commodity: str = "commodity", check: bool = True, workspace: Workspace | None = None
) -> Standardized:
    """``df`` with values and units converted; other columns and rows without a matching rule stay.

    Each distinct commodity and unit is folded and matched once and joined back; a stream is converted row by row.
    ``check`` looks for values that aren't numbers first, and raises an error with some of them.
    """
    for c in (unit, value, commodity):
        if c not in df.columns:
            raise HarmonizeError(f"column '{c}' is missing")
    textual = isinstance(df.schema[value].dataType, StringType)
    if check and textual:
        bad = [r[0] for r in df.where(non_numeric_values(df, value)).select(value).distinct().limit(5).collect()]
        if bad:
            raise HarmonizeError(f"value column has values that are not numbers: {', '.join(bad)}")
    cells = {"__c": F.col(commodity).cast("string"), "__u": F.col(unit).cast("string")}
    if df.isStreaming:
        pairs = rows = convert_units(df.withColumns({**cells, "n": F.lit(1).cast("long")}), rules)
    else:
        workspace = workspace or Workspace(df.sparkSession, "units")
        distinct, seen = distinct_cells(df, cells, workspace)
        total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
        unknown = ~F.col("__matched") & F.coalesce(F.col("__key") != "", F.lit(False))
        pairs, found = observed(convert_units(distinct, rules), "units", workspace, matched=total(F.col("__matched")), unmatched=total(unknown))
        rows = join_back(df, cells, pairs.select(*cells, "n", *DECIDED), seen["rows"])
    raw = numbers.parse_padded_double(F.col(value)) if textual else F.col(value).cast("double")
    scaled = raw * F.col("__prefix")
    new_value = F.when(F.col("__matched"), scaled * F.col("__factor") + F.col("__offset")).otherwise(scaled)
    new_unit = F.when(F.col("__matched"), F.col("__target")).otherwise(F.col("__unit"))
    data = rows.select(*[new_value.alias(c) if c == value else new_unit.alias(c) if c == unit else F.col(c) for c in df.columns])
    keys = ("__rule", "__commodity", "__key", "__u", "__factor", "__prefix")
    counts = pairs.where("__matched").groupBy(*[F.col(k).alias(c) for k, c in zip(keys, COUNTS)]).agg(F.sum("n").alias("affected_rows")).withColumn("unit_factor_effective", F.col("rule_multiplier") * F.col("detected_prefix"))
    if df.isStreaming:
        return Standardized(data, pairs, counts)
    return Standardized(data, pairs, counts, seen["rows"], found["matched"], found["unmatched"])


def standardize_layer(df: DataFrame, rules: list[dict], aggregate: bool = True, workspace: Workspace | None = None) -> tuple[DataFrame, Standardized, DataFrame]:
    """Standardize, bring cells into canonical form and sum the rows that became equal; also the rows that were summed."""
    result = standardize(df, rules, workspace=workspace)
    data = canonical_cells(result.data)
    if not aggregate:
        return data, result, data.limit(0)
    return sum_duplicates(data), result, duplicate_rows(data)


def standardize_audit(rules: list[dict], counts: DataFrame) -> DataFrame:
    """Rules with their counts: one row for each rule, raw unit and prefix that it converted."""
    table = conversion_table(counts.sparkSession, rules).withColumnRenamed("commodity_key", "rule_commodity")
    joined = counts.join(F.broadcast(table), (table["commodity_match_key"] == counts["rule_commodity_match_key"]) & (table["unit_source_key"] == counts["unit_source_key"]))
    return joined.select(
        "affected_rows", F.col("source_rule_file").alias("rule_file_identifier"), F.col("applied_commodity_match_key").alias("commodity_key"), "unit_source", "unit_target",
        F.col("unit_factor_num").alias("unit_factor"), F.col("unit_offset_num").alias("unit_offset"), "source_unit_raw", "detected_prefix", "unit_factor_effective",
    )
