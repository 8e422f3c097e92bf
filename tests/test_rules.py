from __future__ import annotations

import warnings

import pytest
from pyspark.sql import functions as F

from harrow.rules.apply import apply_group, matched_tokens, target_matches
from harrow.rules.stage import run_stage
from harrow.rules.table import Group, add_referenced_columns, check_rules, groups, rule_file
from harrow.settings import RULE_COLUMNS, HarmonizeError, MultiPass

COLUMNS = list(RULE_COLUMNS)


def rules_of(rows, source="commodity", target="unit", columns=COLUMNS):
    names = ("value_source_raw", "value_source", "value_target_raw", "value_target")
    return [{"column_source": source, "column_target": target} | dict(zip(names, r)) for r in rows]


def file_of(rows, columns=COLUMNS, stage="clean", name="clean_a.csv"):
    return rule_file(name, columns, rows, stage)


def apply(spark, workspace, cells, rows, source="commodity", target="unit", has_source=True, normalized=True):
    names = list(dict.fromkeys((source, target)))
    df = spark.createDataFrame([(i, *(c if isinstance(c, tuple) else (c,))) for i, c in enumerate(cells)], "i int, " + ", ".join(f"{n} string" for n in names))
    ordered = groups(file_of(rows, COLUMNS if has_source else [c for c in COLUMNS if c != "value_source"]))
    result = apply_group(df, ordered[0], workspace, normalized)
    out = [tuple(r)[1:] for r in sorted(result.data.collect())]
    return [r[0] if len(r) == 1 else r for r in out], result


def test_several_rules_and_their_audit(spark, workspace):
    rows = rules_of([("wheat", "WHEAT", "kg", "tonne"), ("cafe", "COFFEE", "kg", "gram")])
    out, result = apply(spark, workspace, [("wheat", "kg")] * 3 + [("Café", "kg")], rows)
    assert out == [("WHEAT", "tonne")] * 3 + [("COFFEE", "gram")]
    assert result.changed == 8 and result.changed_columns == ("commodity", "unit")
    assert [(a["value_source_raw"], a["affected_rows"]) for a in result.audit] == [("cafe", 1), ("wheat", 3)]


def test_source_only_target_only_and_no_match(spark, workspace):
    out, result = apply(spark, workspace, [("wheat", "kg")], rules_of([("wheat", "WHEAT", "kg", "kg")]))
    assert out == [("WHEAT", "kg")] and result.changed == 1 and len(result.audit) == 1
    out, result = apply(spark, workspace, [("maize", "kg")], rules_of([("maize", None, "kg", "tonne")]), has_source=False)
    assert out == [("maize", "tonne")] and result.changed == 1
    out, result = apply(spark, workspace, [("barley", "kg")], rules_of([("wheat", "WHEAT", "kg", "tonne")]))
    assert out == [("barley", "kg")] and result.changed == 0 and result.audit == ()


CASES = [
    # cells, rules, expected
    ([("a; b", "x; y")], [("b", "B", "y", "Y")], [("B; a", "Y; x")]),  # a token each, siblings stay
    ([("a; b", "x")], [("a; b", "Z", "x", "x")], [("a; b", "x")]),  # a plain source never meets a whole list
    ([("a; b", "x")], [("#EXACT#a; b", "Z", "x", "x")], [("Z", "x")]),
    ([("a", "x")], [("a", None, "x", "x")], [(None, "x")]),  # an empty result deletes the token
    ([("a; b", "x; y")], [("a", "a", "x", None)], [("a; b", "y")]),
    ([(None, "x"), ("a", "x")], [(None, "N", "x", "x")], [("N", "x"), ("a", "x")]),
    ([("a", None), ("a", "x")], [("a", "a", None, "N")], [("a", "N"), ("a", "x")]),
    ([("a", "x"), (None, "x")], [("#ANY#", "new", "x", "x")], [("a; new", "x"), ("new", "x")]),
    ([("a", "x"), ("a", None)], [("a", "a", "#ANY#", "add")], [("a", "add; x"), ("a", "add")]),
    ([("a", "x; y"), ("a", None)], [("a", "a", "#REPLACE#", "r; q")], [("a", "q; r"), ("a", "q; r")]),
    ([("a; b", "x")], [("#REPLACE#", "r", "x", "x"), ("a", "A", "x", "x")], [("r", "x")]),
    ([("a; b", "x")], [("#REPLACE#", None, "x", "x")], [(None, "x")]),
    ([("#REPLACE#", "x"), ("a", "x")], [("#EXACT##REPLACE#", "lit", "x", "x")], [("lit", "x"), ("a", "x")]),
    ([("a", "#ANY#"), ("a", "x")], [("a", "a", "#EXACT##ANY#", "lit")], [("a", "lit"), ("a", "x")]),
    ([("a", "x")], [("#EXACT##ANY#", "more", "x", "x")], [("a; more", "x")]),  # a source mark doesn't make the wildcard literal
    ([("a", "x; y")], [("a", "a", "#EXACT#x; y", "Z")], [("a", "Z")]),
    ([("a", "x; y")], [("a", "a", "x; y", "Z")], [("a", "x; y")]),  # a whole list matches but names no token
    ([("a", "")], [("a", "a", "#EXACT#", "Z")], [("a", "Z")]),
    ([("Café; cafe", "x")], [("cafe", "C", "x", "x")], [("C", "x")]),  # both spellings are tokens of their own
]


@pytest.mark.parametrize(("cells", "rows", "expected"), CASES)
def test_directives(spark, workspace, cells, rows, expected):
    assert apply(spark, workspace, cells, rules_of(rows))[0] == expected


def test_the_first_rule_of_a_token_wins_and_the_loser_leaves_the_target(spark, workspace):
    rows = rules_of([("a", "A1", "x", "X"), ("a", "A2", "y", "Y")])
    out, result = apply(spark, workspace, [("a", "x; y")], rows)
    assert out == [("A1", "X; y")]
    assert [a["affected_rows"] for a in result.audit] == [1, 1]  # both were hit


def test_losers_still_apply_exact_any_and_replace_targets(spark, workspace):
    rows = rules_of([("a", "A1", "#ANY#", "m"), ("a", "A2", "x", "lost"), ("#EXACT#a", "E", "#ANY#", "n")])
    out, _ = apply(spark, workspace, [("a", "x")], rows)
    assert out == [("E", "m; n; x")]


def test_without_normalization_keys_are_literal(spark, workspace):
    rows = rules_of([("wheat", "W", "kg", "kg")])
    assert apply(spark, workspace, [("Wheat", "kg"), ("wheat", "kg")], rows, normalized=False)[0] == [("Wheat", "kg"), ("W", "kg")]


def test_one_column_on_both_sides(spark, workspace):
    rows = rules_of([("a", "A", "b", "B")], source="unit", target="unit")
    out, result = apply(spark, workspace, ["a; b"], rows, source="unit", target="unit")
    assert out == ["A; B"]


def test_notes_are_concatenated(spark, workspace):
    rows = rules_of([("w", None, "#ANY#", "d; e")], target="notes")
    out, result = apply(spark, workspace, [("w", "b; c"), ("w", None), ("v", "n")], rows, target="notes", has_source=False)
    assert out == [("w", "b; c; d; e"), ("w", "d; e"), ("v", "n")] and result.changed == 2
    rows = rules_of([("w", None, "#REPLACE#", "only"), ("w", None, "#ANY#", "z")], target="notes")
    assert apply(spark, workspace, [("w", "b")], rows, target="notes", has_source=False)[0] == [("w", "only")]


def test_conditions_and_matched_tokens(spark):
    cases = [("café", "plain", "cafe", True), ("a; Café; b", "plain", "cafe", True), ("", "plain", "", False), ("", "exact", "", True), (None, "null", "..NA_MATCH_KEY..", True), (None, "plain", "a", False), (None, "any", "", True), ("a; b", "exact", "a", False)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, c string, kind string, key string, expected boolean")
    rows = df.select("i", "expected", target_matches(F.col("c"), F.col("kind"), F.col("key"), True).alias("m"), matched_tokens(F.col("c"), F.col("key"), True).alias("t")).collect()
    assert all(r["m"] == r["expected"] for r in rows), rows
    assert sorted(rows)[1]["t"] == ["Café"]


def test_groups_are_ordered_by_target_then_source():
    rows = rules_of([("b", "x", "k", "k")]) + rules_of([("a", "x", "k", "k")], source="polity") + rules_of([(None, "x", "k", "k"), ("é", "x", "k", "k"), ("Apple", "x", "k", "k")], target="continent")
    found = groups(file_of(rows))
    assert [(g.target, g.source) for g in found] == [("continent", "commodity"), ("unit", "commodity"), ("unit", "polity")]
    assert [r["value_source_raw"] for r in found[0].rules] == ["Apple", "é", None]


def test_rule_tables_are_checked(spark):
    df = spark.createDataFrame([("wheat", 5, 1.0)], "commodity string, year int, value double")
    with pytest.raises(HarmonizeError, match="lacks columns"):
        rule_file("f", ["column_source"], [], "clean")
    with pytest.raises(HarmonizeError, match="unexpected"):
        rule_file("f", [*COLUMNS, "other"], [], "clean")
    with pytest.raises(HarmonizeError, match="repeats columns"):
        rule_file("f", [*COLUMNS, "clean_value_target"], [], "clean")
    with pytest.raises(HarmonizeError, match="unknown stage"):
        rule_file("f", COLUMNS, [], "other")
    twice = rules_of([("a", "x", "k", "k"), ("a", "y", "k", "k")], target="commodity")
    with pytest.raises(HarmonizeError, match="repeats 1 rule key"):
        check_rules(file_of(twice), df)
    with pytest.raises(HarmonizeError, match="dataset lacks"):
        check_rules(file_of(rules_of([("a", "x", "k", "k")])), df)
    with pytest.raises(HarmonizeError, match="not of type bigint"):
        check_rules(file_of(rules_of([("a", "x", "abc", "5")], target="year")), df)
    check_rules(file_of(rules_of([("a", "x", "#ANY#", "5")], target="year")), df)
    added = add_referenced_columns(df, file_of(rules_of([("a", "x", "k", "k")])).rules)
    assert added.columns == ["commodity", "year", "value", "unit"]


def facts(spark, cells):
    return spark.createDataFrame(cells, "commodity string, unit string, notes string, footnotes string")


def test_a_stage_runs_to_a_fixpoint(spark, workspace):
    df = facts(spark, [("a", "k", None, None), ("z", "k; j", None, None)])
    rows = rules_of([("a", "b", "k", "k"), ("b", "c", "k", "k")])
    result = run_stage(df, [file_of(rows)], "clean", workspace, timestamp="t")
    assert sorted(r["commodity"] for r in result.data.collect()) == ["c", "z"]
    assert [(p.changed_value_count, p.stop_reason) for p in result.passes] == [(1, "continued"), (1, "continued"), (0, "converged_zero_change")]
    assert result.converged and "footnotes" not in result.data.columns and {r["unit"] for r in result.data.collect()} == {"k", "j; k"}
    audit = result.audit.orderBy("loop").collect()
    assert [(r["loop"], r["value_source_raw"], r["affected_rows"], r["rule_file_identifier"]) for r in audit] == [(1, "a", 1, "clean_a.csv"), (2, "b", 1, "clean_a.csv")]


def test_cycles_warn_or_abort(spark, workspace):
    df = facts(spark, [("a", "k", "n", "f")])
    rows = rules_of([("a", "b", "k", "k"), ("b", "a", "k", "k")])
    with pytest.warns(UserWarning, match="cycle detected at pass 2"):
        result = run_stage(df, [file_of(rows)], "clean", workspace)
    assert result.stop_reason == "cycle_detected" and "footnotes" in result.data.columns
    with pytest.raises(HarmonizeError, match="cycle"):
        run_stage(df, [file_of(rows)], "clean", workspace, MultiPass(cycle_policy="abort"))


def test_pass_limits(spark, workspace):
    df = facts(spark, [("a", "k", None, None)])
    rows = rules_of([("a", "b", "k", "k"), ("b", "c", "k", "k")])
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert run_stage(df, [file_of(rows)], "clean", workspace, MultiPass(max_passes=1)).stop_reason == "max_passes_reached"
    assert run_stage(df, [file_of(rows)], "clean", workspace, MultiPass(enabled=False)).stop_reason == "single_pass_completed"
    empty = run_stage(df, [], "harmonize", workspace)
    assert empty.converged and empty.audit.count() == 0


def test_group_without_rows(spark, workspace):
    df = facts(spark, [])
    group = Group("commodity", "unit", tuple(rules_of([("a", "b", "k", "k")])), True)
    assert apply_group(df, group, workspace).changed == 0
