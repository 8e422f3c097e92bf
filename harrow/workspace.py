"""Intermediate tables of a run in the cluster's shared checkpoint folder.

A written table cuts the lineage and, unlike a local checkpoint, outlives any executor.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from harrow.settings import HarmonizeError


def shared_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset a fresh local one, which only a local session may use."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.partition("[")[0] == "local":
            raise HarmonizeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="harrow-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


class Workspace:
    """Tables of one run, each under its own path."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_root(spark)}/harrow/{name}-{uuid.uuid4().hex[:12]}"
        self._n = 0

    def folder(self, label: str) -> str:
        self._n += 1
        return f"{self.path}/{self._n:04d}-{label}"

    def save(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df`` and return a frame that reads it back."""
        where = self.folder(label)
        df.write.parquet(where)
        return self.spark.read.schema(df.schema).parquet(where)
