"""Audit, clean, standardize and harmonize the facts."""

from __future__ import annotations

import shutil
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrow.operators import summaries, units
from harrow.operators.duplicates import duplicate_audit
from harrow.operators.frames import canonical_cells, canonical_order
from harrow.operators.pairs import observed
from harrow.operators.validate import parse_values
from harrow.plans.diagnostics import diagnostics_table, stage_rows, standardize_rows
from harrow.rules.stage import StageResult, run_stage
from harrow.settings import HarmonizeError, Settings
from harrow.sources.rule_files import read_conversions, stage_rule_files, write_templates
from harrow.sources.sinks import write_tsv
from harrow.workspace import Workspace


@dataclass(frozen=True)
class Postprocessed:
    raw: DataFrame
    clean: DataFrame
    normalize: DataFrame
    harmonize: DataFrame
    stages: dict[str, StageResult]
    standardized: units.Standardized
    diagnostics: DataFrame
    reports: dict[str, Path]


def preflight(settings: Settings, columns: list[str]) -> list[str]:
    """What would stop the run: missing rule folders, or columns that the stages need."""
    problems = [f"rule folder does not exist: {settings.rules(s)}" for s in ("clean", "standardize", "harmonize") if not settings.rules(s).is_dir()]
    return problems + [f"column is missing: {c}" for c in ("unit", "value", "commodity") if c not in columns]


def tidy(df: DataFrame) -> DataFrame:
    return canonical_order(canonical_cells(df))


def run_postpro(raw: DataFrame, settings: Settings, workspace: Workspace, dataset_name: str = "dataset") -> Postprocessed:
    """The four layers, with each one's rows written once to the shared folder."""
    shutil.rmtree(settings.audit / "logs", ignore_errors=True)
    settings.create_folders()
    raw = workspace.save(canonical_cells(raw), "raw")
    audited = parse_values(raw)
    write_templates(settings.audit / "templates")
    problems = preflight(settings, audited.columns)
    if problems:
        raise HarmonizeError("; ".join(problems))
    files = {s: stage_rule_files(settings.rules(s), s) for s in ("clean", "harmonize")}
    clean = run_stage(audited, files["clean"], "clean", workspace, settings.passes("clean"), dataset_name)
    clean_df = workspace.save(canonical_cells(clean.data), "clean")
    conversions = read_conversions(settings.rules("standardize"))
    normalized, standardized, _ = units.standardize_layer(clean_df, conversions, workspace=workspace)
    normalize_df, summed = observed(canonical_cells(normalized), "normalize", workspace, rows=F.count(F.lit(1)))
    harmonize = run_stage(normalize_df, files["harmonize"], "harmonize", workspace, settings.passes("harmonize"), dataset_name)
    harmonize_df = workspace.save(canonical_cells(harmonize.data), "harmonize")
    layers = {"raw": raw, "clean": clean_df, "normalize": normalize_df, "harmonize": harmonize_df}
    reports = write_logs(clean, harmonize, standardized, conversions, files, settings)
    for name, df in layers.items():
        reports[f"{name}_dup"] = write_tsv(canonical_order(duplicate_audit(df)), settings.audit / "duplicates" / f"{name}_dup.tsv")
    told = stage_rows("clean", clean) + standardize_rows("standardize_units", standardized, conversions, summed["rows"]) + stage_rows("harmonize", harmonize)
    diagnostics = diagnostics_table(raw.sparkSession, told)
    reports["diagnostics"] = write_tsv(diagnostics, settings.audit / "diagnostics" / "diagnostics.tsv")
    ordered = {n: canonical_order(df) for n, df in layers.items()}
    return Postprocessed(**ordered, stages={"clean": clean, "harmonize": harmonize}, standardized=standardized, diagnostics=diagnostics, reports=reports)


def write_logs(clean: StageResult, harmonize: StageResult, standardized: units.Standardized, conversions: list[dict], files: dict, settings: Settings) -> dict[str, Path]:
    """One TSV a stage with the rules that matched and those that didn't."""
    logs = settings.audit / "logs"
    logs.mkdir(parents=True, exist_ok=True)
    spark = clean.audit.sparkSession
    found = {}
    for name, result in (("clean", clean), ("harmonize", harmonize)):
        matched = summaries.summarize_stage(result.audit)
        merged = summaries.merge_stage_summaries(matched, summaries.unmatched_rules(summaries.rule_catalog(spark, files[name]), matched))
        found[f"{name}_logs"] = write_tsv(merged.withColumnsRenamed({"rule_file_identifier": "file", "affected_rows": "rows"}), logs / f"{name}_logs.tsv")
    matched = summaries.summarize_standardize(units.standardize_audit(conversions, standardized.counts))
    unmatched = summaries.unmatched_standardize(summaries.standardize_catalog(spark, conversions), matched, standardized.counts)
    merged = summaries.merge_standardize_summaries(matched, unmatched)
    shown = merged.select(
        F.col("rule_file_identifier").alias("file"), F.col("affected_rows").alias("rows"), "commodity_key", "source_unit_raw", "unit_source", "unit_target",
        "detected_prefix", "unit_factor", F.col("unit_factor_effective").alias("unit_factor_net"), "unit_offset",
    )
    found["standardize_logs"] = write_tsv(shown, logs / "standardize_logs.tsv")
    return found
