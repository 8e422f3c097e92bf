"""One rule group as a relational plan.

A rewrite depends on the pair of cells (source, target) alone, so a group works on the distinct
pairs with their counts: tokens are exploded, joined with the broadcast rules, the hits of a pair are
gathered and resolved by array functions, and only changed pairs are joined back.  The
pairs are counted before the shuffle; a rule table is written by hand and always small.  How many cells change is
observed while the resolved pairs are written.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from harrow.functions import numbers, text
from harrow.operators.pairs import distinct_cells, join_back, observed
from harrow.rules.table import COMPILED, Compiled, Group, compile_group
from harrow.settings import CONCATENATED_COLUMNS, UNKEYED_COLUMNS
from harrow.workspace import Workspace

AUDIT_COLUMNS = ("column_source", "value_source_raw", "value_source_result", "column_target", "value_target_raw", "value_target_result", "affected_rows")
_HIT = "struct<i:int,o:int,has:boolean,s_kind:string,s_result:string,t_kind:string,t_result:string,matched:array<string>>"


@dataclass(frozen=True)
class GroupResult:
    data: DataFrame
    changed: int
    changed_columns: tuple[str, ...]
    audit: tuple[dict, ...]


def as_text(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    c = F.col(column)
    return c if isinstance(kind, StringType) else numbers.double_text(c) if isinstance(kind, DoubleType) else c.cast("string")


def target_matches(current: Column, kind: Column, key: Column, normalized: bool) -> Column:
    """Whether a cell meets a target condition."""
    whole = text.match_key(current, normalized) == key
    member = F.exists(text.tokens(current), lambda t: text.match_key(t, normalized) == key)
    plain = current.isNotNull() & (current != "") & (whole | (F.contains(current, F.lit(";")) & member))
    return (
        F.when(kind.isin("any", "replace"), F.lit(True))
        .when(kind == "null", current.isNull())
        .when(kind == "exact", current.isNotNull() & whole)
        .otherwise(F.coalesce(plain, F.lit(False)))
    )


def matched_tokens(current: Column, key: Column, normalized: bool) -> Column:
    """The tokens of a cell that a plain condition names; the cell itself when it isn't a list."""
    single = ~F.contains(current, F.lit(";"))
    return F.when(single, F.array(current)).otherwise(F.filter(text.tokens(current), lambda t: text.match_key(t, normalized) == key))


def _jvm() -> int:
    """Which JVM expressions belong to: building one takes many calls, so those that recur are kept."""
    return id(SparkContext._gateway)


@lru_cache(maxsize=32)
def _candidates(jvm: int, modes: frozenset[str], on_source: bool) -> Column:
    """The keys of ``s`` that rules are looked up by."""
    key = lambda mode, i, k: F.struct(F.lit(mode).alias("mode"), i.alias("i"), k.alias("key"))
    parts = [F.array().cast("array<struct<mode:string,i:int,key:string>>")]
    if "token" in modes:
        parts.append(F.transform(text.tokens(F.col("s")), lambda t, i: key("token", i, text.match_key(t, on_source))))
    if "cell" in modes:
        parts.append(F.array(key("cell", F.lit(-1), text.match_key(F.col("s"), on_source))))
    if "any" in modes:
        parts.append(F.array(key("any", F.lit(-2), F.lit("*"))))
    return F.inline(F.concat(*parts))


@lru_cache(maxsize=4)
def _conditions(jvm: int, on_target: bool) -> tuple[Column, Column]:
    """Whether ``t`` meets a rule's condition, and the tokens that the condition names."""
    named = F.when(F.col("t_kind") == "plain", matched_tokens(F.col("t"), F.col("t_key"), on_target)).otherwise(F.array().cast("array<string>"))
    return target_matches(F.col("t"), F.col("t_kind"), F.col("t_key"), on_target), named


def pair_hits(pairs: DataFrame, compiled: Compiled, on_source: bool, on_target: bool) -> DataFrame:
    """``pairs(s, t, n)`` with each rule that hits them."""
    rules = pairs.sparkSession.createDataFrame(list(compiled.rows), COMPILED)
    exploded = pairs.select("s", "t", "n", _candidates(_jvm(), frozenset(compiled.modes), on_source))
    met, named = _conditions(_jvm(), on_target)
    return exploded.join(F.broadcast(rules), ["mode", "key"]).where(met).withColumn("matched", named)


def _union(hits: Column, field: str) -> Column:
    """All results of some hits as one canonical cell."""
    return text.canonical_cell(F.array_join(F.filter(F.transform(hits, lambda h: h[field]), lambda x: x.isNotNull()), "; "))


def _rebuilt(cell: Column, hit_of, result: str, added: Column) -> Column:
    """A cell whose tokens take the result of their first hit, if any, with further tokens added."""

    def new(token: Column, i: Column) -> Column:
        hits = hit_of(token, i)
        return F.when(F.size(hits) > 0, F.get(hits, F.lit(0))[result]).otherwise(token)

    kept = F.filter(F.transform(text.tokens(cell), new), lambda x: x.isNotNull())
    more = F.filter(F.transform(added, lambda h: h[result]), lambda x: x.isNotNull())
    return text.canonical_cell(F.array_join(F.concat(kept, more), "; "))


@lru_cache(maxsize=8)
def _resolution(jvm: int, same_column: bool, concatenate: bool) -> dict[str, Column]:
    """How the ``hits`` of a pair, in order, make its new cells; each column may read those before it."""
    h = F.col("hits")
    competes = lambda x: x["has"] & (x["s_kind"] == "plain")
    # a rule loses when an earlier one has the same source token
    lost = F.transform(h, lambda x: competes(x) & F.exists(h, lambda y: competes(y) & (y["i"] == x["i"]) & (y["o"] < x["o"])))
    winners = F.filter(F.arrays_zip(h.alias("h"), lost.alias("lost")), lambda z: ~z["lost"])
    found = {"fair": F.transform(winners, lambda z: z["h"])}
    fair = F.col("fair")
    sources = lambda kind: F.filter(h, lambda x: x["has"] & (x["s_kind"] == kind))
    replaced, whole, plain, added = sources("replace"), sources("exact"), sources("plain"), sources("any")
    found["new_s"] = (
        F.when(F.size(replaced) > 0, _union(replaced, "s_result"))
        .when(F.size(whole) > 0, text.canonical_cell(F.get(whole, F.lit(0))["s_result"]))
        .when(
            (F.size(plain) > 0) | (F.size(added) > 0),
            _rebuilt(F.col("s"), lambda token, i: F.filter(plain, lambda x: x["i"] == i), "s_result", added),
        )
        .otherwise(F.col("s"))
    )
    live = F.col("new_s") if same_column else F.col("t")
    t_replaced = F.filter(h, lambda x: x["t_kind"] == "replace")
    if concatenate:
        incoming = F.filter(F.transform(fair, lambda x: text.blank_to_null(x["t_result"])), lambda x: x.isNotNull())
        merged = text.joined(F.array_sort(F.array_union(text.tokens(live), text.tokens(F.array_join(incoming, "; ")))))
        found["new_t"] = F.when(F.size(t_replaced) > 0, _union(t_replaced, "t_result")).when(F.size(incoming) > 0, merged).otherwise(live)
        found["target_before"] = live
    else:
        lost_of = F.filter(F.arrays_zip(h.alias("h"), lost.alias("lost")), lambda z: (z["h"]["t_kind"] == "exact") | ((z["h"]["t_kind"] == "null") & ~z["lost"]))
        t_whole = F.transform(lost_of, lambda z: z["h"])
        t_added = F.filter(h, lambda x: x["t_kind"] == "any")
        t_plain = F.filter(fair, lambda x: (x["t_kind"] == "plain") & (F.size(x["matched"]) > 0))
        found["new_t"] = (
            F.when(F.size(t_replaced) > 0, _union(t_replaced, "t_result"))
            .when(F.size(t_whole) > 0, text.canonical_cell(F.get(t_whole, F.lit(0))["t_result"]))
            .when(
                (F.size(t_plain) > 0) | (F.size(t_added) > 0),
                _rebuilt(live, lambda token, i: F.filter(t_plain, lambda x: F.array_contains(x["matched"], token)), "t_result", t_added),
            )
            .otherwise(live)
        )
        found["target_before"] = F.col("t")
    found["rules"] = F.transform(h, lambda x: x["o"])
    return found


def resolve(hits: DataFrame, same_column: bool, concatenate: bool) -> DataFrame:
    """Each hit pair with its new cells and the rules that hit it: ``s, t, n, new_s, new_t, target_before, rules``."""
    fields = ("i", "o", "has", "s_kind", "s_result", "t_kind", "t_result", "matched")
    gathered = hits.groupBy("s", "t", "n").agg(F.array_sort(F.collect_list(F.struct(*fields))).cast(f"array<{_HIT}>").alias("hits"))
    for name, column in _resolution(_jvm(), same_column, concatenate).items():
        gathered = gathered.withColumn(name, column)
    return gathered.select("s", "t", "n", "new_s", "new_t", "target_before", "rules")


@dataclass(frozen=True)
class Resolved:
    """The pairs that a group hits, written once, and how many source and target cells of the rows it changes."""

    compiled: Compiled
    pairs: DataFrame
    source_changed: int
    target_changed: int

    @property
    def changed(self) -> int:
        return self.source_changed + self.target_changed

    def rewrites(self) -> DataFrame:
        """``s, t, new_s, new_t`` of the pairs that become others."""
        differs = ~F.col("s").eqNullSafe(F.col("new_s")) | ~F.col("t").eqNullSafe(F.col("new_t"))
        return self.pairs.where(differs).select("s", "t", "new_s", "new_t")

    def changed_columns(self, group: Group) -> tuple[str, ...]:
        return tuple(dict.fromkeys([group.source] * bool(self.source_changed) + [group.target] * bool(self.target_changed)))


def resolve_group(pairs: DataFrame, group: Group, workspace: Workspace, normalized: bool = True) -> Resolved:
    """Resolve ``pairs(s, t, n)`` by one group; all its rules see the cells as they are."""
    compiled = compile_group(group, normalized)
    on_source = normalized and group.source not in UNKEYED_COLUMNS
    on_target = normalized and group.target not in UNKEYED_COLUMNS
    resolved = resolve(pair_hits(pairs, compiled, on_source, on_target), group.source == group.target, group.target in CONCATENATED_COLUMNS)
    differ = lambda a, b: F.coalesce(F.sum(F.when(~F.col(a).eqNullSafe(F.col(b)), F.col("n"))), F.lit(0))
    saved, seen = observed(resolved, "pairs", workspace, source=differ("s", "new_s"), target=differ("target_before", "new_t"))
    return Resolved(compiled, saved, seen["source"], seen["target"])


def rule_hits(pairs: DataFrame) -> DataFrame:
    """``o, hits``: how many rows each rule of some resolved pairs hit; a row a rule."""
    return pairs.select(F.explode("rules").alias("o"), "n").groupBy("o").agg(F.sum("n").alias("hits"))


def audit_rows(compiled: Compiled, by_rule: dict[int, int]) -> list[dict]:
    """The rules that were hit, each with the rows of all rules of its keys, in order."""
    by_key: dict[tuple, int] = {}
    for o, n in by_rule.items():
        key = compiled.audit[o]["key"]
        by_key[key] = by_key.get(key, 0) + n
    audit = [{c: a.get(c) for c in AUDIT_COLUMNS if c != "affected_rows"} | {"affected_rows": by_key[a["key"]]} for a in compiled.audit if a["key"] in by_key]
    order = ("column_source", "column_target", "value_source_raw", "value_target_raw")
    return sorted(audit, key=lambda a: tuple((a[c] is None, (a[c] or "").encode()) for c in order))


def apply_group(df: DataFrame, group: Group, workspace: Workspace, normalized: bool = True) -> GroupResult:
    """Rewrite ``df`` by one group; all its rules see the cells as they are at the start.

    Both columns become text.  ``changed`` counts source and target cells that differ; the audit has a row for each
    rule whose keys were hit, if anything changed.
    """
    cells = {"s": as_text(df, group.source), "t": as_text(df, group.target)}
    pairs, seen = distinct_cells(df, cells, workspace)
    resolved = resolve_group(pairs, group, workspace, normalized)
    if not resolved.changed:
        return GroupResult(df, 0, (), ())
    audit = audit_rows(resolved.compiled, {r["o"]: r["hits"] for r in rule_hits(resolved.pairs).collect()})
    same = F.col("s").eqNullSafe(F.col("r_s")) & F.col("t").eqNullSafe(F.col("r_t"))
    rewrites = resolved.rewrites().select(F.col("s").alias("r_s"), F.col("t").alias("r_t"), F.col("new_s").alias("__new_s"), F.col("new_t").alias("__new_t"), F.lit(True).alias("__hit"))
    found = pairs.join(rewrites, same, "left").drop("r_s", "r_t")
    out = join_back(df, cells, found, seen["rows"], F.col("__hit"))
    new = {group.source: "__new_s", group.target: "__new_t"}  # the same column takes the target's
    data = out.select(*[F.when(F.col("__hit"), F.col(new[c])).otherwise(as_text(out, c)).alias(c) if c in new else F.col(f"`{c}`") for c in df.columns])
    return GroupResult(data, resolved.changed, resolved.changed_columns(group), tuple(audit))
