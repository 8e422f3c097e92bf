"""From a folder of workbooks to validated long facts."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.operators.frames import canonical_cells, canonical_order, consolidate, drop_null_values
from harrow.operators.validate import validate_long
from harrow.settings import HarmonizeError, Settings
from harrow.sources.workbooks import found_files, read_long
from harrow.workspace import Workspace

PLACE = ["_path", "_year_no", "_sheet_no", "_row_no"]


@dataclass(frozen=True)
class Ingested:
    data: DataFrame
    reading_errors: DataFrame
    validation_errors: DataFrame


def ingest_rows(rows: DataFrame, settings: Settings, workspace: Workspace | None = None) -> tuple[DataFrame, DataFrame]:
    """Consolidated facts of long rows that carry their places, and their validation errors."""
    checked, errors = validate_long(drop_null_values(rows) if settings.drop_nulls else rows, PLACE, settings.required, settings.current_year, workspace)
    data = consolidate([checked.drop(*PLACE, "_error", "iso_whep")])
    return canonical_order(canonical_cells(data)), errors


def run_ingest(spark: SparkSession, settings: Settings, workspace: Workspace) -> Ingested:
    """Read, reshape, validate and consolidate all workbooks.

    With checkpoints on, the result of an earlier run is read instead.
    """
    kept = settings.checkpoint_folder / "ingest"
    if settings.checkpoints and (kept / "complete.json").exists():
        read = lambda name: spark.read.parquet((kept / name).resolve().as_uri())
        return Ingested(canonical_order(canonical_cells(read("data"))), read("reading_errors"), read("validation_errors"))
    # one scan of the folder, by few tasks: a scan's own have 32 files each, however many there are
    files = workspace.save(found_files(spark, str(settings.raw)).coalesce(spark.sparkContext.defaultParallelism), "files")
    if files.isEmpty():
        raise HarmonizeError("no workbooks were found")
    rows = workspace.save(read_long(spark, str(settings.raw), settings.required), "long")
    named = files.where(F.col("error_message").isNotNull()).select(F.col("file_path").alias("_path"), F.col("error_message").alias("_error"))
    reading = named.unionByName(rows.where(F.col("_error").isNotNull()).select("_path", "_error"))
    data, errors = ingest_rows(rows.where(F.col("_error").isNull()), settings, workspace)
    result = Ingested(data, reading, errors)
    if settings.checkpoints:
        for name in ("data", "reading_errors", "validation_errors"):
            getattr(result, name).write.mode("overwrite").parquet((kept / name).resolve().as_uri())
        (kept / "complete.json").write_text(json.dumps({"columns": data.columns}))
    return result
