"""Rule tables on the driver: schema, checks, groups and compiled rules.

A rule table is written by hand and bounded by that; rows of the dataset never come here.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, NumericType, StringType

from harrow.functions import text
from harrow.settings import NA_VALUE, RULE_COLUMNS, STAGES, UNKEYED_COLUMNS, HarmonizeError

RawRule = dict[str, str | None]


@dataclass(frozen=True)
class RuleFile:
    """One file's rules: its name, columns and rows as read, and the canonical rows."""

    name: str
    columns: tuple[str, ...]
    raw: tuple[RawRule, ...]
    rules: tuple[RawRule, ...]
    has_source_values: bool


def check_stage(stage: str) -> str:
    if stage not in STAGES:
        raise HarmonizeError(f"unknown stage '{stage}'; stages are {', '.join(STAGES)}")
    return stage


def canonical_condition(value: str | None) -> str | None:
    """A rule cell in canonical token form; an exact-match mark stays in front."""
    body, exact = text.split_exact(value)
    cell = text.canonical_value(body)
    return f"#EXACT#{cell or ''}" if exact else cell


def rule_file(name: str, columns: list[str], rows: list[RawRule], stage: str) -> RuleFile:
    """Canonical rules of one table, whose columns may carry the stage as a prefix."""
    check_stage(stage)
    bare = [c.removeprefix(f"{stage}_") for c in columns]
    twice = [c for c, k in Counter(bare).items() if k > 1]
    if twice:
        raise HarmonizeError(f"rule file {name} repeats columns: {', '.join(twice)}")
    missing = [c for c in RULE_COLUMNS if c not in bare and c != "value_source"]
    if missing:
        raise HarmonizeError(f"rule file {name} lacks columns: {', '.join(missing)}")
    extra = [c for c in bare if c not in RULE_COLUMNS]
    if extra:
        raise HarmonizeError(f"rule file {name} has unexpected columns: {', '.join(extra)}")
    named = [{b: r.get(c) for b, c in zip(bare, columns)} for r in rows]
    rules = tuple({c: r.get(c) for c in RULE_COLUMNS} for r in named)
    return RuleFile(name, tuple(bare), tuple(named), rules, "value_source" in bare)


def referenced_columns(rules: tuple[RawRule, ...]) -> list[str]:
    """The dataset columns that rules name, sources first."""
    names = [(r[side] or "").strip(text.BLANKS) for side in ("column_source", "column_target") for r in rules]
    return [n for n in dict.fromkeys(names) if n]


def add_referenced_columns(df: DataFrame, rules: tuple[RawRule, ...]) -> DataFrame:
    twice = [c for c, k in Counter(df.columns).items() if k > 1]
    if twice:
        raise HarmonizeError(f"the dataset repeats columns: {', '.join(twice)}")
    new = {c: F.lit(None).cast("string") for c in referenced_columns(rules) if c not in df.columns}
    return df.withColumns(new) if new else df


def _cast_failures(spark: SparkSession, values: list[str], kind: str) -> list[str]:
    if not values:
        return []
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r["v"] for r in df.where(F.expr(f"try_cast(v as {kind}) is null")).limit(5).collect()]


def check_rules(file: RuleFile, df: DataFrame) -> None:
    """Abort on rules without columns, columns that the dataset lacks, repeated keys or values of a wrong type."""
    rules = file.rules
    for side in ("column_source", "column_target"):
        if any(r[side] is None for r in rules):
            raise HarmonizeError(f"rule file {file.name} has rows without {side}")
    absent = [c for c in referenced_columns(rules) if c not in df.columns]
    if absent:
        raise HarmonizeError(f"rule file {file.name} names columns that the dataset lacks: {', '.join(absent)}")
    folded = lambda v: NA_VALUE if v is None or not v.strip(text.BLANKS) else v
    keys = Counter((r["column_source"], folded(r["value_source_raw"]), r["column_target"], folded(r["value_target_raw"])) for r in rules)
    repeated = [k for k, n in keys.items() if n > 1]
    if repeated:
        raise HarmonizeError(f"rule file {file.name} repeats {len(repeated)} rule key(s), the first {repeated[0]}")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    for column, value in (("column_source", "value_source_raw"), ("column_target", "value_target_raw"), ("column_source", "value_source")):
        for name in dict.fromkeys(r[column] for r in rules):
            check_values(df.sparkSession, kinds.get(name), name, [r[value] for r in rules if r[column] == name], file.name)


def check_values(spark: SparkSession, kind, column: str, values: list[str | None], where: str) -> None:
    """Abort if plain rule values can't be values of a typed column; directives and blanks always can."""
    if kind is None or isinstance(kind, StringType):
        return
    plain = [text.split_exact(v)[0] for v in values if v is not None and v.strip(text.BLANKS)]
    plain = [v for v in plain if not (text.is_any(v) or text.is_replace(v))]
    target = "date" if isinstance(kind, DateType) else "bigint" if isinstance(kind, IntegralType) else "double" if isinstance(kind, NumericType) else None
    bad = _cast_failures(spark, plain, target) if target else []
    if bad:
        raise HarmonizeError(f"rule file {where}: values for column {column} are not of type {target}: {', '.join(bad)}")


@dataclass(frozen=True)
class Group:
    """The rules of one pair of columns, in order."""

    source: str
    target: str
    rules: tuple[RawRule, ...]
    has_source_values: bool


def _nulls_last(values: tuple[str | None, ...]) -> tuple:
    return tuple((v is None, (v or "").encode()) for v in values)


def groups(file: RuleFile) -> list[Group]:
    """Rules by (source, target) column: groups in order of target, then source; rules by code point, nulls last."""
    order = ("column_source", "column_target", "value_source_raw", "value_target_raw", "value_target")
    ordered = sorted(file.rules, key=lambda r: _nulls_last(tuple(r[c] for c in order)))
    found: dict[tuple[str, str], list[RawRule]] = {}
    for r in ordered:
        if r["column_source"] is not None and r["column_target"] is not None:
            found.setdefault((r["column_target"], r["column_source"]), []).append(r)
    return [Group(s, t, tuple(rs), file.has_source_values) for (t, s), rs in sorted(found.items(), key=lambda x: _nulls_last(x[0]))]


#: What a compiled rule is joined and rewritten by.
COMPILED = (
    "mode string, key string, o int, has boolean, s_kind string, s_result string, "
    "t_kind string, t_key string, t_result string"
)


@dataclass(frozen=True)
class Compiled:
    rows: tuple[tuple, ...]
    audit: tuple[dict, ...]

    @property
    def modes(self) -> set[str]:
        return {r[0] for r in self.rows}


def compile_group(group: Group, normalized: bool) -> Compiled:
    """Rules as rows to join: how their source matches (``any`` cell, ``cell`` or ``token``), its key, and the target's condition."""
    on_source = normalized and group.source not in UNKEYED_COLUMNS
    on_target = normalized and group.target not in UNKEYED_COLUMNS
    rows, audit, seen = [], [], set()
    for r in group.rules:
        raw, condition, result = r["value_source_raw"], r["value_target_raw"], text.encode_result(r["value_target"])
        identity = (raw, r["value_source"], condition, result)
        if identity in seen:
            continue
        seen.add(identity)
        body, exact = text.split_exact(raw)
        s_kind = "replace" if text.is_replace(raw) else "any" if text.is_any(body) else "exact" if exact or body is None else "plain"
        mode = "any" if s_kind in ("replace", "any") else "cell" if s_kind == "exact" else "token"
        key = "*" if mode == "any" else text.match_value(body, on_source)
        wanted, t_exact = text.split_exact(condition)
        t_kind = (
            "replace" if text.is_replace(condition) else "exact" if t_exact else "null" if wanted is None else "any" if text.is_any(wanted) else "plain"
        )
        s_result = r["value_source"] if r["value_source"] is not None and r["value_source"].strip(text.BLANKS) else None
        t_result = text.decode_result(result)
        rows.append((mode, key, len(rows), group.has_source_values, s_kind, s_result, t_kind, text.match_value(wanted, on_target), t_result))
        audit.append({"column_source": group.source, "value_source_raw": raw, "value_source_result": s_result, "column_target": group.target, "value_target_raw": condition, "value_target_result": t_result, "key": (key if mode != "any" else "*any*", text.match_value(condition, on_target), s_result, result)})
    return Compiled(tuple(rows), tuple(audit))
