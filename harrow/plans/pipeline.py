"""Setup, ingest, post-processing and export in one run."""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import SparkSession

from harrow.plans.export import run_export
from harrow.plans.ingest import Ingested, run_ingest
from harrow.plans.postpro import Postprocessed, run_postpro
from harrow.settings import Settings, dataset_name
from harrow.workspace import Workspace


@dataclass(frozen=True)
class Run:
    ingested: Ingested
    postprocessed: Postprocessed
    processed: dict[str, Path]
    lists: dict[str, Path]


def run_pipeline(spark: SparkSession, settings: Settings, name: str = "dataset") -> Run:
    settings.create_folders()
    workspace = Workspace(spark, "pipeline")
    ingested = run_ingest(spark, settings, workspace)
    done = run_postpro(ingested.data, settings, workspace, name)
    layers = {"raw": done.raw, "clean": done.clean, "normalize": done.normalize, "harmonize": done.harmonize}
    processed, lists = run_export(layers, settings, f"{dataset_name(name)}_data" if name != "dataset" else "harrow_data", workspace)
    return Run(ingested, done, processed, lists)
