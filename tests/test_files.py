from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from harrow import cli
from harrow.plans.pipeline import run_pipeline
from harrow.settings import RULE_COLUMNS, HarmonizeError, MultiPass, Settings
from harrow.sources import rule_files, sinks, workbooks, xlsx


def test_workbooks_round_trip():
    sheets = {"A & B": [["x", None, "é\n<y>"], [None, " z "]], "two": [["1"]]}
    data = xlsx.workbook_bytes(sheets)
    assert xlsx.read_workbook(data) == sheets and data == xlsx.workbook_bytes(sheets)
    assert xlsx.sheet_table([["a"], ["1", "2"]]) == (["a", "column_2"], [["1", "2"]]) and xlsx.sheet_table([]) == ([], [])
    with pytest.raises(HarmonizeError):
        xlsx.read_workbook(b"BIFF")


@pytest.mark.parametrize(("raw", "shown"), [("5", "5"), ("5.0", "5"), ("0.1", "0.1"), ("1.2345678901234567", "1.2345678901234567"), ("1E3", "1000"), ("-2.50", "-2.5")])
def test_number_cells(raw, shown):
    assert xlsx.number_text(raw) == shown


def test_tsv_bytes(spark, tmp_path):
    rows = [("a\tb", 1.5, "x"), ('q"q', 1e16, ""), ("l\nl", None, None), (" pad ", 0.1 + 0.2, "c,d"), ("é", float("nan"), "e")]
    df = spark.createDataFrame(rows, "t string, v double, u string").coalesce(1)
    path = sinks.write_tsv(df, tmp_path / "o.tsv")
    assert path.read_text() == 't\tv\tu\n"a\tb"\t1.5\tx\n"q""q"\t10000000000000000\t""\n"l\nl"\t\t\n pad \t0.3\tc,d\né\t\te\n'
    with pytest.raises(HarmonizeError, match="overwrite"):
        sinks.write_tsv(df, path, overwrite=False)
    assert sinks.write_tsv(df.limit(0), tmp_path / "e.tsv").read_text() == "t\tv\tu\n"


def test_tsv_parts_and_failed_writes(spark, tmp_path):
    rows = spark.range(100).repartitionByRange(5, "id").sortWithinPartitions("id")
    many = sinks.write_tsv(rows, tmp_path / "m.tsv", one_file=False)
    whole = "".join(p.read_text() for p in sorted(many.iterdir()))
    assert whole == "id\n" + "".join(f"{i}\n" for i in range(100)) and len(list(many.iterdir())) == 6
    assert sinks.write_tsv(rows, many).read_text() == whole  # the folder gives way to a file
    empty = sinks.write_tsv(spark.createDataFrame([], "`a\tb` string"), tmp_path / "e", one_file=False)
    assert [p.read_text() for p in empty.iterdir()] == ['"a\tb"\n']
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        sinks.write_tsv(rows.select("id", F.expr("1 div (id - 70)").alias("x")), tmp_path / "x.tsv")
    assert sorted(p.name for p in tmp_path.iterdir()) == ["e", "m.tsv"]


def test_tsv_of_negative_zero(spark, tmp_path):
    import duckdb

    import __spark_entry__ as e

    rows = [(1, "a", 1, -0.0, "x"), (2, "b", 3, 0.0, "y"), (3, "c", 4, -7.0, "z"), (4, "d", 4, None, "z")]
    spark.createDataFrame(rows, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW customer AS FROM '{tmp_path}/customer.parquet/*.parquet'")
    got = e.queries()["tsv_round_trip"](spark, str(tmp_path))
    assert got.columns == ["c_custkey", "c_name", "share", "mark"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(con.sql(e.oracle_sql()["tsv_round_trip"]).fetchall())


def test_rule_files(tmp_path):
    (tmp_path / "clean_b.csv").write_text("clean_column_source,value_source_raw,column_target,value_target_raw,value_target\ncommodity,007,unit,kg,NA\ncommodity,,unit,\"b;a\",#ALL#\ncommodity,#exact# z;y,unit,x,w\n")
    (tmp_path / "clean_a.xlsx").write_bytes(xlsx.workbook_bytes({"notes": [["free text"]], "r": [list(RULE_COLUMNS), ["commodity", "a", "b", "unit", "c", "d"]]}))
    (tmp_path / "harmonize_x.csv").write_text("")
    first, second = rule_files.stage_rule_files(tmp_path, "clean")
    assert first.name == "clean_a.xlsx" and first.has_source_values and not second.has_source_values
    assert [(r["value_source_raw"], r["value_target_raw"], r["value_target"]) for r in second.rules] == [("007", "kg", None), (None, "a; b", "#ALL#"), ("#EXACT#y; z", "x", "w")]
    (tmp_path / "clean_c.xls").write_bytes(b"x")
    with pytest.raises(HarmonizeError, match="save .xls"):
        rule_files.stage_rule_files(tmp_path, "clean")
    assert rule_files.stage_rule_files(tmp_path / "none", "clean") == []


def test_conversion_files(tmp_path):
    header = ["commodity", "from_unit", "to_unit", "factor", "offset"]
    (tmp_path / "u.xlsx").write_bytes(xlsx.workbook_bytes({"Master Unit": [["x"]], "master_unit": [header], "s": [header, ["#ALL#", "kg", "g", "1000", "0"]]}))
    rules = rule_files.read_conversions(tmp_path)
    assert [(r["source_rule_sheet"], r["source_rule_file"], r["commodity_match_key"]) for r in rules] == [("s", "u.xlsx", "all")]
    assert rule_files.read_conversions(tmp_path / "none") == []
    assert all(p.exists() for p in rule_files.write_templates(tmp_path / "t"))


def make_corpus(root):
    settings = Settings(root=str(root), current_year=2025, multi_pass={"clean": MultiPass(max_passes=5)})
    settings.create_folders()
    header = ["Continent", "Country", "Unit", "Footnotes", "1950", "1951.0"]
    (settings.raw / "fao_1952_a_b_c_wheat.xlsx").write_bytes(xlsx.workbook_bytes({"production": [header, ["Asia", "Japan", "1000 kg", None, "2", "3.5"], [None, None, None, None, "9", "9"], ["Asia", "Nippon", "t", "x", None, "bad"]], "área": [header, ["Asia", "Japan", "ha", "n", "1", "1"]]}))
    (settings.raw / "sub").mkdir()
    (settings.raw / "sub" / "fao_1953_a_b_c_rice.xlsx").write_bytes(xlsx.workbook_bytes({"production": [header[1:], ["Japan", "kg", None, "7", "1800"], ["Japan", "kg", None, "1", None]]}))
    (settings.raw / "fao_1953_a_b_c_broken.xlsx").write_bytes(b"no")
    rules = "column_source,value_source_raw,value_source,column_target,value_target_raw,value_target\n"
    (settings.rules("clean") / "clean_1.csv").write_text(rules + "polity,nippon,japan,continent,asia,asia\npolity,never,x,continent,asia,asia\n")
    (settings.rules("harmonize") / "harmonize_1.csv").write_text(rules + "commodity,wheat,Wheat,notes,#REPLACE#,checked\n")
    conversion = [["commodity_key", "unit_source", "unit_target", "unit_factor", "unit_offset"], ["#ALL#", "kg", "tonne", "0.001", "0"], ["#ALL#", "bushel", "tonne", "0.02", "0"]]
    (settings.rules("standardize") / "u.xlsx").write_bytes(xlsx.workbook_bytes({"s": conversion}))
    return settings


def test_whole_run(spark, tmp_path):
    settings = make_corpus(tmp_path / "a")
    run = run_pipeline(spark, settings)
    reading = [r["_error"] for r in run.ingested.reading_errors.collect()]
    assert any("failed to read file 'fao_1953_a_b_c_broken.xlsx'" in m for m in reading)
    assert any("missing required base columns in file 'fao_1953_a_b_c_rice.xlsx': continent" in m for m in reading)
    assert any("non-ascii sheet name" in m for m in reading)
    assert any("missing mandatory value" in r["message"] for r in run.ingested.validation_errors.collect())
    rows = {(r["commodity"], r["variable"], r["polity"], r["unit"], r["year"], r["value"], r["notes"]) for r in run.postprocessed.harmonize.collect()}
    assert ("Wheat", "production", "japan", "tonne", "1950", 2.0, "checked") in rows
    assert ("rice", "production", "japan", "tonne", "1950", 0.008, None) in rows  # 7 kg and 1 kg are one fact
    assert ("Wheat", "production", "japan", "t", "1951", None, "checked") in rows
    logs = run.postprocessed.reports
    assert "never" in logs["clean_logs"].read_text() and "bushel" in logs["standardize_logs"].read_text()
    assert logs["raw_dup"].read_text().startswith("hemisphere\t") or "dup_full" in logs["raw_dup"].read_text()
    again = run_pipeline(spark, make_corpus(tmp_path / "b"))
    for name, path in {**run.processed, **run.lists}.items():
        assert path.read_bytes() == {**again.processed, **again.lists}[name].read_bytes()
    lists = xlsx.read_workbook(run.lists["commodity"].read_bytes())
    assert lists == {"raw_clean_normalize": [["rice"], ["wheat"]], "harmonize": [["Wheat"], ["rice"]]}


def test_checkpoints_and_empty_folders(spark, tmp_path, workspace):
    from harrow.plans.ingest import run_ingest

    settings = Settings(root=str(tmp_path), checkpoints=True, current_year=2025)
    settings.create_folders()
    with pytest.raises(HarmonizeError, match="no workbooks"):
        run_ingest(spark, settings, workspace)
    made = make_corpus(tmp_path)
    settings = Settings(root=made.root, checkpoints=True, current_year=2025)
    first = run_ingest(spark, settings, workspace).data.collect()
    for p in settings.raw.rglob("*.xlsx"):
        p.unlink()
    assert run_ingest(spark, settings, workspace).data.collect() == first
    with pytest.raises(HarmonizeError, match="does not exist"):
        workbooks.discover(spark, str(tmp_path / "nowhere"))


def test_dates_and_numbers_of_cells():
    from datetime import datetime
    from io import BytesIO

    out = BytesIO()
    xlsx.write_workbook(out, {"s": [["a", 0.1 + 0.2, 5.0, datetime(1996, 2, 29, 13, 5, 6), None, datetime(1900, 3, 1)]]})
    assert xlsx.read_workbook(out.getvalue()) == {"s": [["a", "0.30000000000000004", "5", "1996-02-29 13:05:06", None, "1900-03-01 00:00:00"]]}
    for code, dated in (("yyyy-mm-dd", True), ("[$-409]d-mmm;@", True), ("[h]:mm", True), ("0.00", False), ("General", False), ('0 "days"', False), ("#,##0\\ \\d", False), ("[Red]0", False), ("_-* #,##0.00_-", False)):
        assert xlsx.is_date_format(code) == dated, code
    assert [xlsx.date_text(x) for x in ("1", "59", "61", "44196.5")] == ["1900-01-01 00:00:00", "1900-02-28 00:00:00", "1900-03-01 00:00:00", "2020-12-31 12:00:00"]
    assert xlsx.date_text("0", from_1904=True) == "1904-01-01 00:00:00" and xlsx.date_text("1e9") == "1000000000"


def test_sheets_are_read_row_by_row():
    data = xlsx.workbook_bytes({"s": [["k", "unread", "v"], *[[str(i), "x", f"v{i}"] for i in range(5)]]})
    book = xlsx.Workbook(data)
    rows = book.rows("s", lambda first: {first.index("k"), first.index("v")})
    assert next(rows) == ["k", "unread", "v"] and next(rows) == ["0", None, "v0"] and len(list(rows)) == 4
    assert book.size("s") > 100


def test_folders_of_many_files(tmp_path):
    """Small files are opened by their tasks, in partitions that grow with the folder."""
    header = ["Continent", "Country", "Unit", "Footnotes", "1950"]
    for i in range(700):
        rows = [["Asia", f"p{k}", "kg", "f", str(k)] for k in range(2 if i else 20_000)]
        (tmp_path / f"fao_1952_a_b_c_{i:03d}.xlsx").write_bytes(xlsx.workbook_bytes({"s": [header, *rows], "t": [header, *rows[:1]]}))
    (tmp_path / "fao_1952_a_b_c_bad.xlsx").write_bytes(b"no")
    reader = workbooks.WorkbookReader(tmp_path.as_uri(), ("continent",), 1)
    parts = reader.partitions()
    assert len(parts) < 1000 and [s[2] for p in parts for s in p.sheets] == ["s", "t"] and sum(len(p.files) for p in parts) == 700
    rows = [r for p in parts for b in reader.read(p) for r in b.select(["file", "variable", "value", "_sheet_no", "_error"]).to_pylist()]
    errors = [r["_error"] for r in rows if r["_error"]]
    assert errors == ["failed to read file 'fao_1952_a_b_c_bad.xlsx': not an .xlsx workbook (.xls files can't be read)"]
    assert len(rows) == 1 + 699 * 3 + 20_001 and {(r["_sheet_no"], r["variable"]) for r in rows if r["file"]} == {(0, "s"), (1, "t")}


def test_ingest_finds_files_and_errors_once(spark, tmp_path, workspace, monkeypatch):
    """The folder is scanned by few tasks, and errors are found once, before they are sorted."""
    from harrow.plans.ingest import run_ingest

    saved = []
    save = workspace.save
    monkeypatch.setattr(workspace, "save", lambda df, label: saved.append((label, df.rdd.getNumPartitions())) or save(df, label))
    header = ["Continent", "Country", "Unit", "Footnotes", "1950"]
    settings = Settings(root=str(tmp_path), current_year=2025)
    settings.create_folders()
    for i in range(40 * spark.sparkContext.defaultParallelism):
        (settings.raw / f"fao_1952_a_b_c_{i:04d}.xlsx").write_bytes(xlsx.workbook_bytes({"s": [header, ["Ásia", f"p{i}", "kg", None if i == 7 else "f", "1"]]}))
    (settings.raw / "fao_1952_á_b_c_x.xlsx").write_bytes(b"no")
    found = run_ingest(spark, settings, workspace)
    assert dict(saved)["files"] <= spark.sparkContext.defaultParallelism
    assert "errors" in dict(saved) and all("errors" in f for f in found.validation_errors.inputFiles())
    assert [r["message"] for r in found.validation_errors.collect()] == ["missing mandatory value in document 'fao_1952_a_b_c_0007.xlsx', row_id '1', column 'footnotes'"]
    assert {r["_error"].partition(":")[0] for r in found.reading_errors.collect()} == {"non-ascii file name detected", "failed to read file 'fao_1952_á_b_c_x.xlsx'"}
    assert {(r["continent"], r["variable"]) for r in found.data.collect()} == {("asia", "s")}


def test_workbook_partitions(spark, tmp_path):
    header = ["Continent", "Country", "Unit", "Footnotes", "1950"]
    for name, sheets in (("fao_1952_a_b_c_x.xlsx", 3), ("fao_1952_a_b_c_y.xlsx", 1)):
        (tmp_path / name).write_bytes(xlsx.workbook_bytes({f"s{i}": [header, *[["Asia", f"p{k}", "kg", "f", str(k)] for k in range(40)]] for i in range(sheets)}))
    (tmp_path / "fao_1952_a_b_c_z.xlsx").write_bytes(b"no")
    reader = workbooks.WorkbookReader(tmp_path.as_uri(), ("continent",), 1)
    parts = reader.partitions()
    assert [[s[2] for s in p.sheets] for p in parts] == [["s0"], ["s1"], ["s2"], ["s0"]] and len(parts[-1].errors) == 1
    assert len(workbooks.WorkbookReader(tmp_path.as_uri(), ("continent",), 1 << 30).partitions()) == 1
    df = workbooks.read_long(spark, str(tmp_path), partition_bytes=1)
    assert df.rdd.getNumPartitions() == 4 and df.where("_error IS NULL").count() == 160 and df.where("_error IS NOT NULL").count() == 1
    assert {(r["_sheet_no"], r["variable"]) for r in df.where("file LIKE '%x.xlsx'").collect()} == {(0, "s0"), (1, "s1"), (2, "s2")}
    assert workbooks.WorkbookReader((tmp_path / "none").as_uri(), (), 1).__class__ is workbooks.WorkbookReader


def test_lists_are_compared_by_digests_and_written_by_tasks(spark, tmp_path, workspace):
    from harrow.operators.lists import layer_tables, merged_lists

    layer = lambda rows: spark.createDataFrame(rows, "polity string, year long, value double, none string")
    objects = {"d_raw": layer([("Spain", 10, 1.5, None), ("Åland", 9, None, None), ("France", 9, 10.0, None)]), "d_clean": layer([("France", 1, 2.0, None), ("Spain", 1, None, None), ("Åland", 1, None, None), ("Spain", 2, 2.0, None)]), "d_harmonize": layer([(None, 1, 1.0, None)]).limit(0)}
    lists = merged_lists(layer_tables(objects), ["polity", "year", "value", "none", "absent"], workspace)
    assert {c: lists.sheets(c) for c in lists.groups} == {
        "polity": {"raw_clean": 3, "normalize_harmonize": 0}, "year": {"raw": 2, "clean": 2, "normalize_harmonize": 0}, "value": {"raw": 3, "clean": 2, "normalize_harmonize": 0},
        "none": {"raw_clean": 1, "normalize_harmonize": 0}, "absent": {"raw_clean_normalize_harmonize": 0},
    }
    sinks.write_list_workbooks(lists, {c: (tmp_path / f"{c}.xlsx").as_uri() for c in lists.groups})
    got = {c: xlsx.read_workbook((tmp_path / f"{c}.xlsx").read_bytes()) for c in lists.groups}
    assert got["polity"] == {"raw_clean": [["France"], ["Spain"], ["Åland"]], "normalize_harmonize": []}
    assert got["year"] == {"raw": [["9"], ["10"]], "clean": [["1"], ["2"]], "normalize_harmonize": []}
    assert got["value"] == {"raw": [["(blank)"], ["1.5"], ["10"]], "clean": [["(blank)"], ["2"]], "normalize_harmonize": []}
    assert got["none"] == {"raw_clean": [["(blank)"]], "normalize_harmonize": []} and got["absent"] == {"raw_clean_normalize_harmonize": []}
    assert len(list(tmp_path.iterdir())) == 5


def test_export_contract_and_names(tmp_path, monkeypatch):
    from harrow.plans.export import check_output_paths
    from harrow.settings import dataset_name, project_root

    check_output_paths({"a": tmp_path}, {"b": tmp_path})
    for processed, lists in (({}, {"b": tmp_path}), ({"a": tmp_path}, {}), ({" ": tmp_path}, {"b": tmp_path})):
        with pytest.raises(HarmonizeError):
            check_output_paths(processed, lists)
    assert [dataset_name(n) for n in (" Données  (2020)! ", "Ünï", "trade_data_raw")] == ["donnees_2020", "uni", "trade_data_raw"]
    monkeypatch.delenv("HARROW_ROOT", raising=False)
    (tmp_path / "p" / "q" / "r").mkdir(parents=True)
    (tmp_path / "p" / "pyproject.toml").write_text("")
    assert project_root(tmp_path / "p" / "q" / "r") == (tmp_path / "p").resolve()
    monkeypatch.setenv("HARROW_ROOT", str(tmp_path))
    assert project_root(tmp_path / "p") == tmp_path.resolve()


def test_no_local_folder_on_a_cluster():
    from types import SimpleNamespace

    from harrow.workspace import shared_root

    conf = SimpleNamespace(get=lambda *a: None)
    cluster = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host:7077", getConf=lambda: conf))
    with pytest.raises(HarmonizeError, match="spark.checkpoint.dir"):
        shared_root(cluster)


def test_wide_sheet(spark):
    data = xlsx.workbook_bytes({"s": [["Country", "1950", "Some Thing"], ["x", "1", None]]})
    df = workbooks.read_sheet_wide(spark, data, "s")
    assert df.columns == ["polity", "1950", "some_thing"] and df.first()["polity"] == "x"


def test_bootstrap(tmp_path, capsys, monkeypatch):
    monkeypatch.setenv("HARROW_YEAR", "2020")
    monkeypatch.setenv("HARROW_CHECKPOINTS", "yes")
    assert cli.main(["bootstrap", "--root", str(tmp_path)]) == 0
    assert "raw" in capsys.readouterr().out and (tmp_path / "data" / "input" / "raw").is_dir()
    settings = Settings.from_environment(str(tmp_path))
    assert settings.current_year == 2020 and settings.checkpoints
    with pytest.raises(HarmonizeError):
        MultiPass(max_passes=0)


def test_streams(spark, tmp_path):
    from harrow.operators.units import prepare_conversions
    from harrow.streaming.rows import each_batch, standardize_stream

    rows = [("wheat", "2 kg", "5"), ("wheat", "b; a", "x")]
    spark.createDataFrame(rows, "commodity string, unit string, value string").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("commodity string, unit string, value string").parquet(f"{tmp_path}/in")
    rules = prepare_conversions([{"commodity_key": "#ALL#", "unit_source": "kg", "unit_target": "g", "unit_factor": "1000", "unit_offset": "0"}])
    query = each_batch(standardize_stream(stream, rules), lambda df: df.withColumn("n", F.lit(1)), f"{tmp_path}/out", f"{tmp_path}/state")
    query.awaitTermination(60)
    got = sorted((r["unit"], r["value"], r["n"]) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [("a; b", None, 1), ("g", 10000.0, 1)]
