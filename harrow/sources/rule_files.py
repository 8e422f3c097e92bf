"""Rule tables from ``.csv`` and ``.xlsx`` files, on the driver."""

from __future__ import annotations

import csv
from pathlib import Path

from harrow.functions import text
from harrow.operators.units import canonical_conversion_names, prepare_conversions
from harrow.rules.table import RuleFile, canonical_condition, check_stage, rule_file
from harrow.settings import CONVERSION_COLUMNS, EXCLUDED_SHEETS, RULE_COLUMNS, HarmonizeError
from harrow.sources.xlsx import read_workbook, sheet_table, workbook_bytes

_CONDITIONS = ("value_source_raw", "value_target_raw")


def _tables(path: Path) -> dict[str, tuple[list[str], list[list[str | None]]]]:
    if path.suffix.lower() == ".csv":
        with path.open(newline="", encoding="utf-8-sig") as f:
            rows = [[None if v in ("", "NA") else v for v in r] for r in csv.reader(f)]
        header = [v or "" for v in rows[0]] if rows else []
        return {path.stem: (header, [r + [None] * (len(header) - len(r)) for r in rows[1:]])}
    if path.suffix.lower() == ".xls":
        raise HarmonizeError(f"{path.name}: save .xls rule files as .xlsx or .csv")
    return {n: sheet_table(rows) for n, rows in read_workbook(path.read_bytes()).items()}


def _fits(columns: list[str], stage: str) -> bool:
    bare = {c.removeprefix(f"{stage}_") for c in columns}
    return bare <= set(RULE_COLUMNS) and set(RULE_COLUMNS) - {"value_source"} <= bare


def read_rule_file(path: Path, stage: str) -> RuleFile:
    """One file's rules with canonical cells; of a workbook all sheets that have the rule columns."""
    check_stage(stage)
    tables = _tables(path)
    if path.suffix.lower() != ".csv":
        tables = {n: t for n, t in tables.items() if _fits(t[0], stage)}
        if not tables:
            raise HarmonizeError(f"{path.name} has no sheet with the rule columns")
    columns = list(dict.fromkeys(c for header, _ in tables.values() for c in header))
    rows = []
    for header, body in tables.values():
        for r in body:
            row = dict(zip(header, r))
            rows.append({c: canonical_condition(v) if c.removeprefix(f"{stage}_") in _CONDITIONS else text.canonical_value(v) for c, v in row.items()})
    return rule_file(path.name, columns, rows, stage)


def stage_rule_files(folder: Path, stage: str) -> list[RuleFile]:
    """The files ``<stage>_*`` of a folder in order of their names."""
    found = [p for p in folder.iterdir() if p.is_file() and p.name.startswith(f"{stage}_") and p.suffix.lower() in (".xlsx", ".xls", ".csv")] if folder.is_dir() else []
    return [read_rule_file(p, stage) for p in sorted(found, key=lambda p: p.name)]


def read_conversions(folder: Path) -> list[dict]:
    """All conversion rules of a folder's workbooks, checked; each with its sheet and file."""
    excluded = {text.normalize_value(n) for n in EXCLUDED_SHEETS}
    rows: list[dict] = []
    for path in sorted((p for p in folder.iterdir() if p.suffix.lower() in (".xlsx", ".xls", ".csv")), key=lambda p: p.name) if folder.is_dir() else []:
        tables = {n: t for n, t in _tables(path).items() if text.normalize_value(n) not in excluded}
        if not tables:
            raise HarmonizeError(f"{path.name} has no sheets but excluded ones")
        fitting = 0
        for sheet, (header, body) in tables.items():
            renames = canonical_conversion_names(header)
            names = [renames.get(h, h) for h in header]
            if set(CONVERSION_COLUMNS) <= set(names):
                fitting += 1
                rows += [{c: dict(zip(names, r))[c] for c in CONVERSION_COLUMNS} | {"source_rule_sheet": sheet, "source_rule_file": path.name} for r in body]
        if not fitting:
            raise HarmonizeError(f"{path.name} has no sheet with the conversion columns")
    return prepare_conversions(rows)


def write_templates(folder: Path) -> list[Path]:
    """Empty rule workbooks to fill in."""
    folder.mkdir(parents=True, exist_ok=True)
    found = []
    for name, sheet, columns in (("clean_harmonize_template.xlsx", "rules", RULE_COLUMNS), ("standardize_units_template.xlsx", "units_standardization", CONVERSION_COLUMNS)):
        path = folder / name
        path.write_bytes(workbook_bytes({sheet: [list(columns)]}))
        found.append(path)
    return found
