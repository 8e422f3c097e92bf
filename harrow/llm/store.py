"""Intermediate tables in the cluster's shared checkpoint folder.

Writing a table and reading it again cuts the lineage, and unlike a local
checkpoint it survives the loss of any executor.
"""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset a fresh local one, which only a local session may use."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="harrow-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


class Store:
    """Tables of one run of one operator, each under its own path."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_root(spark)}/harrow/{name}-{uuid.uuid4().hex[:12]}"
        self._n = 0

    def folder(self, label: str) -> str:
        self._n += 1
        return f"{self.path}/{self._n:03d}-{label}"

    def save(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df`` and return a frame that reads it back."""
        where = self.folder(label)
        df.write.parquet(where)
        return self.spark.read.schema(df.schema).parquet(where)

    def together(self, frames: list[DataFrame]) -> DataFrame:
        """The rows of several frames of the same columns returned by :meth:`save`, in one scan whose plan doesn't grow with their number."""
        paths = sorted({unquote(f.rpartition("/")[0]) for df in frames for f in df.inputFiles()})
        return self.spark.read.schema(frames[0].schema).parquet(*paths)

    def drop(self, df: DataFrame) -> None:
        """Delete the files behind a frame returned by :meth:`save` that nothing reads any more."""
        jvm = self.spark._jvm
        for where in {f.rpartition("/")[0] for f in df.inputFiles()}:
            if "/harrow/" in where:
                path = jvm.org.apache.hadoop.fs.Path(where)
                path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def clear(self) -> None:
        """Delete all tables of this run, once its result has been written elsewhere."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def reads(self, df: DataFrame) -> bool:
        """Whether ``df`` reads a table of this run."""
        return any(self.path.rpartition("/")[2] in f for f in df.inputFiles())

    def release(self) -> None:
        """Let the driver's JVM collect plans of finished jobs, so that Spark deletes their shuffle files."""
        for _ in range(2):  # the first lets go of plans that Python held, the second finds what they held
            gc.collect()
            self.spark._jvm.System.gc()
            time.sleep(0.5)
