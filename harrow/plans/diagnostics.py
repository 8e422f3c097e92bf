"""What the layers of a run did, as one table.

All counts were observed while the layers were written, so the table costs no job over the facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from harrow.operators.units import Standardized
from harrow.rules.stage import StageResult
from harrow.settings import MATCHED_MESSAGE, NO_CONVERSIONS_MESSAGE, UNMATCHED_MESSAGE

#: ``kind`` is ``layer``, ``message``, ``pass``, ``nulls`` or ``bytes``; ``item`` names a figure or, for the last two, a column.
DIAGNOSTICS = "layer string, kind string, pass_index long, item string, count long, text string"


def _layer(layer: str, figures: dict[str, int | str | None], messages: tuple[str, ...]) -> list[tuple]:
    rows = [(layer, "layer", None, k, None if isinstance(v, str) else v, v if isinstance(v, str) else None) for k, v in figures.items()]
    return rows + [(layer, "message", i, None, None, m) for i, m in enumerate(messages, 1)]


def stage_rows(layer: str, result: StageResult) -> list[tuple]:
    """A rule stage: matched and unmatched rows, messages, its passes, and the state of the rule columns after each."""
    figures = {"rows": result.rows, "matched_count": result.matched, "unmatched_count": result.unmatched, "status": "pass" if result.matched else "warn", "stop_reason": result.stop_reason, "passes_executed": len(result.passes)}
    rows = _layer(layer, figures, result.messages)
    for p in result.passes:
        for item in ("changed_value_count", "matched_count", "audit_rows", "repeated_state_pass"):
            rows.append((layer, "pass", p.pass_index, item, getattr(p, item), None))
        rows.append((layer, "pass", p.pass_index, "stop_reason", None, p.stop_reason))
    for s in result.states:
        rows += [(layer, "nulls", s.pass_index, s.column, s.null_count, None), (layer, "bytes", s.pass_index, s.column, s.byte_length, None)]
    return rows


def standardize_rows(layer: str, result: Standardized, rules: list[dict], rows_after: int | None = None) -> list[tuple]:
    """The unit conversion; with ``rows_after`` also what summing repeated facts left."""
    figures = {
        "rows": result.rows, "matched_count": result.matched, "unmatched_count": result.unmatched, "status": "pass" if result.matched else "warn",
        "applied_rules": len(rules), "rule_sources": "; ".join(dict.fromkeys(r["source_rule_file"] for r in rules if r["source_rule_file"])),
    }
    if rows_after is not None:
        figures |= {"rows_before_aggregation": result.rows, "rows_after_aggregation": rows_after, "collapsed_rows_count": result.rows - rows_after, "aggregated_groups_count": rows_after}
    return _layer(layer, figures, (NO_CONVERSIONS_MESSAGE if not rules else MATCHED_MESSAGE if result.matched else UNMATCHED_MESSAGE,))


def diagnostics_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, DIAGNOSTICS)
