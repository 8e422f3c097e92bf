from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from harrow.operators import duplicates, frames, headers, lists, reshape, summaries, units, validate
from harrow.rules.table import rule_file
from harrow.settings import RULE_COLUMNS, HarmonizeError


def test_header_names():
    given = ["Continent", "Country  Name", "Región / Zona", "Año - Base", "GDP (current US$)", "Población Total", "Year / Period", "  value - amount ", "Café au Lait", "São Paulo", "__leading", "A__B", "!!!", None]
    expected = ["continent", "country_name", "region/zona", "ano-base", "gdp_current_us", "poblacion_total", "year/period", "value-amount", "cafe_au_lait", "sao_paulo", "leading", "a_b", "", None]
    assert [headers.normalize_header(h) for h in given] == expected


def test_header_keys_as_a_column(spark):
    given = ["Continent", "Country  Name", "Región / Zona", "Año - Base", "GDP (current US$)", "a\u00a0\u00a0b", "\x1c x \x1f", "  value - amount ", "Ǻ/é", "K ı İ", "__leading", "A__B", "!!!", "", " ", "a-\n/b", "漢字 x", None]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(given)], "i int, h string")
    got = [r["k"] for r in df.select("i", headers.header_key(F.col("h")).alias("k")).orderBy("i").collect()]
    assert got == [headers.normalize_header(h) for h in given]


def test_header_renames_and_collisions():
    assert headers.canonical_renames(["Continent ", "Country", "Unit", "x"]) == {"Continent ": "continent", "Unit": "unit", "Country": "polity"}
    assert headers.canonical_renames(["country", "polity"]) == {}
    assert len(headers.header_collisions(["Unit", "unit "])) == 1 and not headers.header_collisions(["a", "b"])
    assert headers.year_columns(["1950", "1950-1951", "195", "year", "unit", "1950x"]) == ["1950", "1950-1951"]
    assert [headers.clean_year(n) for n in ("2020.0", "2020-21", "2020-21/2021-22", "unit")] == ["2020", "2020", "2020-2021", "unit"]
    with pytest.raises(HarmonizeError, match="collide"):
        headers.clean_year_names(["2020", "2020-21"])


WIDE = [("Asia", " Japan ", "kg", None, "1", "2", None), ("Asia", "Île", "t", "Note!", None, "4", "x")]
WIDE_SCHEMA = "Continent string, Country string, unit string, Footnotes string, `1950` string, `1951.0` string, `1952-53` string"


def test_wide_to_long(spark):
    df = headers.with_canonical_names(spark.createDataFrame(WIDE, WIDE_SCHEMA))
    wide, long = reshape.transform_wide(df, "f.xlsx", "fao_1950", "Rice (paddy)", drop_nulls=False)
    rows = sorted((r["polity"], r["year"], r["value"], r["commodity"], r["footnotes"], r["notes"]) for r in long.fillna({"value": "-", "footnotes": "-", "notes": "-"}).collect())
    assert rows[:3] == [("ile", "1950", "-", "rice (paddy)", "note", "-"), ("ile", "1951", "4", "rice (paddy)", "note", "-"), ("ile", "1952", "x", "rice (paddy)", "note", "-")]
    assert len(rows) == 6 and reshape.transform_wide(df, "f", "y", "c")[1].count() == 4
    with pytest.raises(HarmonizeError, match="year columns"):
        reshape.to_long(spark.createDataFrame([("a",)], "unit string"))
    with pytest.raises(HarmonizeError, match="empty"):
        reshape.transform_wide(df, "", "y", "c")


def test_base_rows(spark):
    df = spark.createDataFrame([(None, " "), ("a", None), (None, None), ("", "\t")], "continent string, polity string")
    assert [r[0] for r in reshape.non_blank_base_rows(df, ("continent", "polity")).collect()] == ["a"]
    assert reshape.non_blank_base_rows(df, ()).count() == 0


def test_file_metadata(spark):
    paths = ["/x/fao_1949_a_b_c_milk.xlsx", "/x/fao_a_b_c_d.xlsx", "/x/fao_1949_a_b_c_wheat_café.xlsx", "noparts.xlsx", "/x/a_b_1950_1951_e_palm_oil.v2.xlsx"]
    df = reshape.file_metadata(spark.createDataFrame([(p,) for p in paths], "file_path string"))
    got = {r["file_path"]: (r["commodity"], r["yearbook"], r["is_ascii"], r["error_message"]) for r in df.collect()}
    assert got[paths[0]] == ("milk", "fao_1949", True, None)
    assert got[paths[1]] == (None, None, True, None)
    assert got[paths[2]] == ("wheat_café", "fao_1949", False, "non-ascii file name detected: fao_1949_a_b_c_wheat_café.xlsx")
    assert got[paths[3]] == (None, None, True, None)
    assert got[paths[4]] == ("palm_oil.v2", "a_1950", True, None)


def facts(spark, rows):
    names = ["continent", "polity", "unit", "footnotes", "year", "value", "file"]
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "at int, " + ", ".join(f"{n} string" for n in names))


def test_validation_messages_in_order(spark):
    rows = [
        ("c", "p", "u", "f", "1950", "5", "B"), ("c", "q", "u", None, "3000", "10", "A"), ("c", "", "u", "f", "1899", "6", "B"),
        ("c", "q", "u", "", "1850-1800", "11", "A"), ("c", "p", "u", "f", "1950", "5", "B"), ("c", "q", "u", "f", "1960", "20", None),
    ]
    df, errors = validate.validate_long(facts(spark, rows).drop("x"), ["at"], current_year=2025)
    messages = [r["message"] for r in errors.collect()]
    assert messages[0] == "missing mandatory value in document 'B', row_id '2', column 'polity'"
    assert messages[1] == "year value '1899' is outside plausible range [1900, 2026]"
    assert messages[2].startswith("duplicate entries detected (count 2) for polity") or "count 2" in messages[2]
    assert messages[3:5] == ["missing mandatory value in document 'A', row_id '1', column 'footnotes'", "missing mandatory value in document 'A', row_id '2', column 'footnotes'"]
    assert messages[5:] == ["year value '3000' is outside plausible range [1900, 2026]", "year range '1850-1800' has start year greater than end year", "year range '1850-1800' contains year outside plausible range [1900, 2026]"]
    with pytest.raises(HarmonizeError):
        validate.validate_long(spark.range(1), ["id"])
    assert validate.validate_long(facts(spark, []), ["at"])[1].count() == 0


def test_audit(spark):
    values = ["10", "20.5", "bad", "-3.5", "", None, "3.", ".5", "1e5", "007", "0", "1,000", "+3", "  ", "12.34.56"]
    df = spark.createDataFrame([(i, v, None if i in (2, 3) else " " if i == 4 else "d") for i, v in enumerate(values, 1)], "i int, value string, document string")
    found = validate.audit_findings(df, "i", {"character_non_empty": ["document"], "numeric_string": ["value"]}).collect()
    assert sorted(r["row_index"] for r in found if r["audit_column"] == "document") == [2, 3, 4]
    assert sorted(r["row_index"] for r in found if r["audit_type"] == "numeric_string") == [3, 4, 5, 7, 8, 9, 12, 13, 14, 15]
    parsed = [r["value"] for r in validate.parse_values(df).orderBy("i").collect()]
    assert parsed == [10, 20.5, None, -3.5, None, None, 3, 0.5, 100000, 7, 0, None, 3, None, None]
    with pytest.warns(UserWarning, match="unsupported"):
        assert validate.audit_findings(df, "i", {"other": ["value"]}).count() == 0
    assert validate.audit_plan(["value", "x"], ("unit", "unit")) == {"character_non_empty": ["unit"], "numeric_string": ["value"]}


def test_duplicates(spark):
    rows = [("wheat", "g", 10.0), ("wheat", "g", 20.0), ("rice", "g", 5.0), ("corn", "g", None), ("corn", "g", 7.0), ("oat", None, None), ("oat", None, None)]
    df = spark.createDataFrame(rows, "commodity string, unit string, value double")
    assert sorted((r[0], r[2]) for r in duplicates.sum_duplicates(df).collect()) == [("corn", 7.0), ("oat", None), ("rice", 5.0), ("wheat", 30.0)]
    assert sorted(r[0] for r in duplicates.duplicate_rows(df).collect()) == ["corn", "corn", "oat", "oat", "wheat", "wheat"]
    flags = sorted((r["commodity"], r["dup_full"], r["dup_excl_value"]) for r in duplicates.duplicate_audit(df).collect())
    assert flags == [("corn", False, True), ("corn", False, True), ("oat", True, True), ("oat", True, True), ("wheat", False, True), ("wheat", False, True)]
    assert duplicates.sum_duplicates(df.select("value")).collect()[0][0] == 42.0
    assert duplicates.duplicate_audit(df.limit(0)).columns == ["commodity", "unit", "value", "dup_full", "dup_excl_value"]
    with pytest.raises(HarmonizeError):
        duplicates.duplicate_audit(df.withColumn("dup_full", F.lit(1)))
    tenths = spark.createDataFrame([("a", x / 10) for x in range(1, 200)], "k string, value double")
    assert duplicates.sum_duplicates(tenths).first()["value"] == 1990.0


RULES = [
    {"commodity_key": "egg", "unit_source": "1000 egg", "unit_target": "tonne", "unit_factor": "0.0539", "unit_offset": "0"},
    {"commodity_key": "#ALL#", "unit_source": "kg", "unit_target": "g", "unit_factor": "1000", "unit_offset": "0"},
    {"commodity_key": "temp", "unit_source": "celsius", "unit_target": "fahrenheit", "unit_factor": "1.8", "unit_offset": "32"},
    {"commodity_key": "#ALL#", "unit_source": "head", "unit_target": "tonne", "unit_factor": "0.001", "unit_offset": "0"},
]


def test_units(spark):
    rows = [("egg", "1000 egg", "2"), ("milk", "hectoliter", "10"), ("wheat", "kg", "5"), ("temp", "celsius", "100"), ("cow", "1,000 head", " 3 ")]
    df = spark.createDataFrame(rows, "commodity string, unit string, value string")
    result = units.standardize(df, units.prepare_conversions(RULES))
    got = {r["commodity"]: (r["unit"], round(r["value"], 9)) for r in result.data.collect()}
    assert got == {"egg": ("tonne", 0.1078), "milk": ("hectoliter", 10.0), "wheat": ("g", 5000.0), "temp": ("fahrenheit", 212.0), "cow": ("tonne", 3.0)}
    assert result.matched_and_unmatched() == (4, 1)
    net = {r["applied_commodity_match_key"]: round(r["unit_factor_effective"], 9) for r in result.counts.collect()}
    assert net == {"cow": 1.0, "wheat": 1000.0, "egg": 0.0539, "temp": 1.8}
    audit = units.standardize_audit(units.prepare_conversions(RULES), result.counts)
    assert sorted((r["commodity_key"], r["affected_rows"], r["unit_target"]) for r in audit.collect()) == [("cow", 1, "tonne"), ("egg", 1, "tonne"), ("temp", 1, "fahrenheit"), ("wheat", 1, "g")]
    unmatched = summaries.unmatched_standardize(summaries.standardize_catalog(spark, units.prepare_conversions(RULES)), summaries.summarize_standardize(audit), result.counts.where("applied_commodity_match_key <> 'egg'"))
    assert [r["commodity_key"] for r in unmatched.collect()] == ["egg"]


def test_units_without_rules_fold_the_prefix(spark):
    df = spark.createDataFrame([("a", "100 kg", 2.0), ("a", "1 kg", 2.0), ("a", None, 2.0)], "commodity string, unit string, value double")
    assert sorted((r["unit"] or "", r["value"]) for r in units.standardize(df, []).data.collect()) == [("", 2.0), ("1 kg", 2.0), ("kg", 200.0)]
    bad = spark.createDataFrame([("a", "kg", "x")], "commodity string, unit string, value string")
    with pytest.raises(HarmonizeError, match="not numbers: x"):
        units.standardize(bad, [])


@pytest.mark.parametrize(("rows", "message"), [
    ([RULES[1], RULES[1] | {"commodity_key": "all", "unit_source": "KG"}], "repeat"),
    ([RULES[0] | {"unit_factor": "inf"}], "finite"),
    ([RULES[0] | {"unit_offset": None}], "lack values"),
    ([{"unit_source": "kg"}], "lack columns"),
    ([RULES[2], RULES[2] | {"unit_source": "fahrenheit", "unit_target": "kelvin"}], "chain"),
])
def test_conversion_checks(rows, message):
    with pytest.raises(HarmonizeError, match=message):
        units.prepare_conversions(rows)


def test_legacy_conversion_headers():
    rule = {"commodity": "a", "from_unit": "kg", "to_unit": "g", "multiplier": "1000", "addend": "0"}
    assert units.prepare_conversions([rule])[0]["unit_factor_num"] == 1000.0
    with pytest.raises(HarmonizeError, match="several headers"):
        units.canonical_conversion_names(["from_unit", "source_unit"])


def test_summaries(spark):
    rows = [{"column_source": "polity", "value_source_raw": v, "value_source": None, "column_target": "unit", "value_target_raw": "kg", "value_target": "g"} for v in ("france", "spain", None)]
    catalog = summaries.rule_catalog(spark, [rule_file("r.csv", list(RULE_COLUMNS), rows, "clean")])
    audit = spark.createDataFrame([(1, 4, "r.csv", "polity", "france", None, "unit", "kg", "g"), (1, 1, "r.csv", "polity", None, None, "unit", "kg", "g")], "loop long, affected_rows long, rule_file_identifier string, column_source string, value_source_raw string, value_source_result string, column_target string, value_target_raw string, value_target_result string")
    matched = summaries.summarize_stage(audit)
    unmatched = summaries.unmatched_rules(catalog, matched)
    assert [(r["value_source_raw"], r["affected_rows"], r["loop"]) for r in unmatched.collect()] == [("spain", 0, 0)]
    merged = summaries.merge_stage_summaries(matched, unmatched).collect()
    assert [(r["loop"], r["value_source_raw"]) for r in merged] == [(0, "spain"), (1, "france"), (1, None)]


def test_lists(spark):
    layer = lambda rows: spark.createDataFrame(rows, "polity string, year long, value double")
    objects = {"d_raw": layer([("Spain", 10, 1.5), ("Åland", 9, None), ("France", 9, 10.0)]), "d_clean": layer([("x", 1, None)]), "d_normalize": layer([("x", 1, None)]), "d_harmonize": layer([(None, 1, 1.0)]), "d_wide_raw": layer([])}
    tables = lists.layer_tables(objects)
    assert list(tables) == ["raw", "clean", "normalize", "harmonize"]
    assert lists.unique_lists(tables["raw"], ["polity", "year", "value", "none"]) == {"polity": ["France", "Spain", "Åland"], "year": ["9", "10"], "value": ["(blank)", "1.5", "10"], "none": []}
    by_layer = {x: lists.unique_lists(df, ["polity"])["polity"] for x, df in tables.items()}
    assert lists.merged_sheets(by_layer) == {"raw": ["France", "Spain", "Åland"], "clean_normalize": ["x"], "harmonize": ["(blank)"]}
    assert lists.export_columns(tables, ("unit", "polity")) == ["polity"]
    with pytest.raises(HarmonizeError):
        lists.export_columns(tables, ("unit",))


def test_frames(spark):
    df = spark.createDataFrame([("b; a", "2", None), (None, "1", None), ("a", None, None)], "polity string, year string, notes string")
    assert [r["polity"] for r in frames.canonical_order(frames.canonical_cells(df)).collect()] == ["a", "a; b", None]
    assert frames.drop_null_columns(df).columns == ["polity", "year"]
    assert frames.drop_null_columns(df.limit(0)).columns == df.columns and frames.drop_null_columns(df.select("notes")).columns == ["notes"]
    joined = frames.consolidate([df, spark.createDataFrame([("x", "5")], "extra string, year string")])
    assert joined.columns[-1] == "extra" and len(joined.columns) == 14
    assert sorted(r["iso_whep"] or "" for r in joined.collect()) == ["", "iso-1", "iso-2", "iso-5"]
    with pytest.raises(HarmonizeError):
        frames.diagonal_union([])


def test_sums_keep_all_bits(spark):
    import math

    from harrow.operators.duplicates import sum_duplicates

    fine = [1 / 3, 2e-5 / 7, 0.1, 0.2, 123456.789]
    rows = [("alone", 1e-15), ("third", 1 / 3), ("none", None), ("none", None), ("one", None), ("one", 3.3e-13), ("large", 1e300), ("large", 1.0)]
    rows += [("fine", x) for x in fine] + [("tenths", 0.1), ("tenths", 0.2)]
    got = {r["k"]: r["value"] for r in sum_duplicates(spark.createDataFrame(rows, "k string, value double")).collect()}
    assert got == {"alone": 1e-15, "third": 1 / 3, "none": None, "one": 3.3e-13, "large": 1e300, "fine": math.fsum(fine), "tenths": 0.1 + 0.2}
