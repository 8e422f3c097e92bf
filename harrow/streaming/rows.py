"""The row-local operators over streams.

Cells, values and units depend on their own row and the broadcast rules only, so a stream of facts
takes them without state; what compares rows (duplicates, rule fixpoints) runs on each micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from harrow.operators.frames import canonical_cells
from harrow.operators.units import standardize
from harrow.operators.validate import parse_values


def standardize_stream(facts: DataFrame, rules: list[dict]) -> DataFrame:
    """A stream of facts with canonical cells, numeric values and standard units.

    Values that aren't numbers become null, since a stream can't be searched for them first.
    """
    return canonical_cells(standardize(parse_values(facts), rules, check=False).data)


def each_batch(facts: DataFrame, operator: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Apply an operator on whole frames to every micro-batch and write each to its own folder, so a repeated batch replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        operator(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return facts.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
