"""Layers and lists as files."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame

from harrow.functions import text
from harrow.operators.frames import canonical_cells, drop_null_columns
from harrow.operators.lists import export_columns, layer_tables, merged_lists
from harrow.settings import HarmonizeError, Settings
from harrow.sources.sinks import export_layers, write_list_workbooks
from harrow.sources.workbooks import as_uri
from harrow.workspace import Workspace


def export_lists(objects: dict[str, DataFrame], folder: Path, columns: tuple[str, ...], overwrite: bool = True, workspace: Workspace | None = None) -> dict[str, Path]:
    """``unique_<column>.xlsx`` for each column: a sheet a layer, layers with equal lists together."""
    tables = layer_tables(objects)
    wanted = export_columns(tables, columns)
    stems = [text.file_stem(c) for c in wanted]
    if len(set(stems)) != len(stems):
        raise HarmonizeError("columns to list have the same file name")
    folder.mkdir(parents=True, exist_ok=True)
    paths = {c: folder / f"unique_{stem}.xlsx" for c, stem in zip(wanted, stems)}
    taken = [p.name for p in paths.values() if p.exists()]
    if taken and not overwrite:
        raise HarmonizeError(f"file already exists and overwrite is disabled: {', '.join(taken)}")
    lists = merged_lists(tables, wanted, workspace or Workspace(next(iter(tables.values())).sparkSession, "lists"))
    write_list_workbooks(lists, {c: as_uri(str(p)) for c, p in paths.items()})
    return paths


def check_output_paths(processed: dict[str, Path], lists: dict[str, Path]) -> None:
    """Abort unless an export has layers and lists, each under a name."""
    for label, found in (("processed layers", processed), ("lists", lists)):
        if not found:
            raise HarmonizeError(f"the export has no {label}")
        if any(not str(name).strip() for name in found):
            raise HarmonizeError(f"the export has {label} without a name")


def run_export(layers: dict[str, DataFrame], settings: Settings, name: str = "harrow_data", workspace: Workspace | None = None) -> tuple[dict[str, Path], dict[str, Path]]:
    """Every layer without its empty columns as TSV, and the lists of their values."""
    objects = {f"{name}_{layer}": drop_null_columns(canonical_cells(df)) for layer, df in layers.items()}
    processed = export_layers(objects, settings.processed, settings.overwrite, settings.one_file)
    lists = export_lists(objects, settings.lists, settings.list_columns, settings.overwrite, workspace)
    check_output_paths(processed, lists)
    return processed, lists
