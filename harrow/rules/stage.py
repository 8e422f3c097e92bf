"""Rule files in passes until nothing changes."""

from __future__ import annotations

import warnings
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrow.operators.frames import canonical_cells
from harrow.operators.pairs import join_back, observed
from harrow.rules.apply import Resolved, as_text, audit_rows, resolve_group, rule_hits
from harrow.rules.table import Group, RuleFile, add_referenced_columns, check_rules, check_stage, groups
from harrow.settings import MATCHED_MESSAGE, UNKEYED_COLUMNS, UNMATCHED_MESSAGE, HarmonizeError, MultiPass
from harrow.workspace import Workspace

AUDIT_SCHEMA = (
    "dataset_name string, column_source string, value_source_raw string, value_source_result string, column_target string, value_target_raw string, "
    "value_target_result string, affected_rows long, execution_timestamp_utc string, rule_file_identifier string, execution_stage string, loop long"
)


@dataclass(frozen=True)
class Pass:
    """One line of a stage's pass diagnostics."""

    pass_index: int
    changed_value_count: int
    matched_count: int
    audit_rows: int
    repeated_state_pass: int | None
    stop_reason: str


@dataclass(frozen=True)
class ColumnState:
    """What a rule column holds after a pass, over all rows."""

    pass_index: int
    column: str
    null_count: int
    byte_length: int


@dataclass(frozen=True)
class StageResult:
    data: DataFrame
    audit: DataFrame
    passes: tuple[Pass, ...]
    stop_reason: str
    matched: int
    unmatched: int
    states: tuple[ColumnState, ...] = ()
    messages: tuple[str, ...] = ()
    rows: int = 0

    @property
    def converged(self) -> bool:
        return self.stop_reason == "converged_zero_change"


#: Resolved pairs whose audits one job counts.
AUDITS_AT_ONCE = 50


class CellStates:
    """The distinct cells of all columns that rules name, as they were (``was_i``) and as they are (``now_i``).

    ``moved`` is the step that last changed a combination, so a group that comes again looks only at what has moved since it last did.  Each
    step that changes anything writes the table once; counts, nulls, bytes and a digest of it are observed meanwhile.
    """

    def __init__(self, df: DataFrame, columns: list[str], workspace: Workspace):
        self.columns, self.workspace, self.step = columns, workspace, 0
        self.at = {c: i for i, c in enumerate(columns)}
        cells = {f"was_{i}": as_text(df, c) for i, c in enumerate(columns)}
        counted = df.groupBy(*[c.alias(name) for name, c in cells.items()]).agg(F.count("*").alias("n"), F.count(F.col("footnotes") if "footnotes" in df.columns else F.lit(None)).alias("notes"))
        self._write(counted.withColumns({**{f"now_{i}": F.col(f"was_{i}") for i in self.at.values()}, "moved": F.lit(0)}))

    def _write(self, table: DataFrame) -> None:
        now = [f"now_{i}" for i in self.at.values()]
        was = [f"was_{i}" for i in self.at.values()]
        marked = [F.coalesce(F.col(c), F.lit("\0")) for c in (*was, *now)]
        digests = [F.sum(F.xxhash64(F.lit(k), *marked, *[F.col(c).isNull() for c in (*was, *now)]).cast("decimal(38,0)")) for k in (0, 1)]
        total = lambda c: F.coalesce(F.sum(c), F.lit(0))
        nulls = {f"nulls_{i}": total(F.when(F.col(c).isNull(), F.col("n"))) for i, c in enumerate(now)}
        sizes = {f"bytes_{i}": total(F.octet_length(c).cast("long") * F.col("n")) for i, c in enumerate(now)}
        self.table, self.seen = observed(table, "cells", self.workspace, rows=total("n"), notes=total("notes"), first=digests[0], second=digests[1], **nulls, **sizes)

    @property
    def digest(self) -> tuple:
        """Equal for states in which every combination has become the same."""
        return self.seen["first"], self.seen["second"]

    def column_states(self, index: int) -> list[ColumnState]:
        return [ColumnState(index, c, self.seen[f"nulls_{i}"], self.seen[f"bytes_{i}"]) for c, i in self.at.items()]

    def pairs(self, group: Group, since: int = 0) -> DataFrame:
        """``s, t, n`` of the group's columns in what moved at or after a step."""
        moved = self.table.where(F.col("moved") >= since) if since else self.table
        return moved.groupBy(F.col(f"now_{self.at[group.source]}").alias("s"), F.col(f"now_{self.at[group.target]}").alias("t")).agg(F.sum("n").alias("n"))

    def rewrite(self, group: Group, resolved: Resolved) -> None:
        """Take the new cells of the pairs that a group changes."""
        source, target = f"now_{self.at[group.source]}", f"now_{self.at[group.target]}"
        new = {source: "new_s", target: "new_t"}  # the same column takes the target's
        rewrites = resolved.rewrites().withColumn("hit", F.lit(True))
        met = self.table.join(rewrites, F.col(source).eqNullSafe(F.col("s")) & F.col(target).eqNullSafe(F.col("t")), "left")
        taken = {c: F.when(F.col("hit"), F.col(v)).otherwise(F.col(c)) for c, v in new.items()}
        self._write(met.withColumns({**taken, "moved": F.when(F.col("hit"), F.lit(self.step)).otherwise(F.col("moved"))}).select(*self.table.columns))

    def apply_to(self, df: DataFrame, changed: set[str]) -> DataFrame:
        """The facts with all changes at once; columns that a changing group names become text."""
        if not changed:
            return df
        cells = {f"was_{i}": as_text(df, c) for c, i in self.at.items()}
        moves = reduce(Column.__or__, [~F.col(f"was_{i}").eqNullSafe(F.col(f"now_{i}")) for i in self.at.values()])
        found = self.table.drop("moved", "notes").withColumn("__hit", F.lit(True))
        out = join_back(df, cells, found, self.seen["rows"], moves)
        new = {c: F.when(F.col("__hit"), F.col(f"now_{self.at[c]}")).otherwise(as_text(out, c)) for c in changed}
        return out.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in df.columns])


@dataclass(frozen=True)
class _Audit:
    """What a group did in a pass, to be counted later: its pairs, and all pairs resolved so far."""

    index: int
    file: str
    resolved: Resolved
    pairs: DataFrame
    known: list[DataFrame]


def _count_audits(audits: list[_Audit]) -> list[dict]:
    """The audit rows of some groups, counted by one job over their pairs."""
    found: list[dict] = []
    for at in range(0, len(audits), AUDITS_AT_ONCE):
        some = audits[at : at + AUDITS_AT_ONCE]
        frames = []
        for k, a in enumerate(some):
            known = reduce(DataFrame.unionByName, [p.select(F.col("s").alias("r_s"), F.col("t").alias("r_t"), "rules") for p in a.known])
            known = known.dropDuplicates(["r_s", "r_t"]) if len(a.known) > 1 else known
            met = a.pairs.join(known, F.col("s").eqNullSafe(F.col("r_s")) & F.col("t").eqNullSafe(F.col("r_t")))
            frames.append(rule_hits(met).withColumn("k", F.lit(k)))
        hits: dict[int, dict[int, int]] = {}
        for r in reduce(DataFrame.unionByName, frames).collect():  # a row a rule, group and pass
            hits.setdefault(r["k"], {})[r["o"]] = r["hits"]
        for k, a in enumerate(some):
            found += [row | {"rule_file_identifier": a.file, "loop": a.index} for row in audit_rows(a.resolved.compiled, hits.get(k, {}))]
    return found


def run_stage(
    df: DataFrame, files: list[RuleFile], stage: str, workspace: Workspace, controls: MultiPass = MultiPass(), dataset_name: str = "dataset", timestamp: str | None = None,
    triggers: set[str] | None = None,
) -> StageResult:
    """Apply the rule files in passes: the first matches normalized text, later ones the text as it is.

    A pass without changes or one that repeats the state before it ends the stage; one that repeats an earlier
    state is a cycle, which warns or aborts.  Cells end up canonical, and ``footnotes`` goes if it was and is
    all null.  With ``triggers`` only groups with such a source column are applied.

    The passes work on the distinct cells of the rules' columns.  The facts are read once for these, and once more, by whoever reads the
    result, to take the changes of all passes together.
    """
    check_stage(stage)
    timestamp = timestamp or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    for file in files:
        df = add_referenced_columns(df, file.rules)
        check_rules(file, df)
    todo = [(file, group) for file in files for group in groups(file) if triggers is None or group.source in triggers]
    columns = list(dict.fromkeys(c for _, g in todo for c in (g.source, g.target)))
    cells = CellStates(df, columns, workspace)
    no_notes = "footnotes" not in df.columns or cells.seen["notes"] == 0
    states, column_states = [cells.digest], cells.column_states(0)
    last: dict[tuple[int, bool], int] = {}
    known: dict[tuple[int, bool], list[DataFrame]] = {}
    audits: list[_Audit] = []
    counted: list[tuple[int, int | None, str]] = []
    changed_columns: set[str] = set()
    stop, messages = "continued", []
    for index in range(1, (controls.max_passes if controls.enabled else 1) + 1):
        pass_changed = 0
        for k, (file, group) in enumerate(todo):
            # a mode in which both columns are matched as they are is the same in every pass
            mode = (k, index == 1 and not {group.source, group.target} <= set(UNKEYED_COLUMNS))
            cells.step += 1
            before = cells.pairs(group)
            resolved = resolve_group(cells.pairs(group, last.get(mode, 0)), group, workspace, index == 1)
            last[mode] = cells.step
            known.setdefault(mode, []).append(resolved.pairs)
            if resolved.changed:
                pass_changed += resolved.changed
                changed_columns |= {group.source, group.target}
                audits.append(_Audit(index, file.name, resolved, before, list(known[mode])))
                cells.rewrite(group, resolved)
        repeated = None
        if not controls.enabled:
            stop = "single_pass_completed"
        elif pass_changed == 0:
            stop, repeated = "converged_zero_change", index - 1
        else:
            if cells.digest in states:
                repeated = states.index(cells.digest)
                stop = "converged_zero_change" if repeated == index - 1 else "cycle_detected"
            states.append(cells.digest)
            if stop == "cycle_detected":
                messages.append(f"[{stage} stage] cycle detected at pass {index} (repeats pass {repeated}).")
                if controls.cycle_policy == "abort":
                    raise HarmonizeError(messages[-1])
                warnings.warn(messages[-1], stacklevel=2)
            elif stop == "continued" and index == controls.max_passes:
                stop = "max_passes_reached"
                messages.append(f"[{stage} stage] reached max_passes={controls.max_passes} before convergence.")
                warnings.warn(messages[-1], stacklevel=2)
        column_states += cells.column_states(index)
        counted.append((pass_changed, repeated, stop))
        if stop != "continued":
            break
    audit = _count_audits(audits)
    passes = []
    for index, (pass_changed, repeated, reason) in enumerate(counted, 1):
        own = [a["affected_rows"] for a in audit if a["loop"] == index]
        passes.append(Pass(index, pass_changed, sum(own), len(own), repeated, reason))
    data = canonical_cells(cells.apply_to(df, changed_columns))
    if no_notes and "footnotes" in data.columns and ("footnotes" not in cells.at or cells.seen[f"nulls_{cells.at['footnotes']}"] == cells.seen["rows"]):
        data = data.drop("footnotes")
    names = [f.split()[0] for f in AUDIT_SCHEMA.split(", ")]
    fixed = {"dataset_name": dataset_name, "execution_timestamp_utc": timestamp, "execution_stage": stage}
    table = df.sparkSession.createDataFrame([tuple((a | fixed)[n] for n in names) for a in audit], AUDIT_SCHEMA)
    matched, rows = sum(p.matched_count for p in passes), cells.seen["rows"]
    summary = f"[{stage} stage] multi-pass stop_reason={stop}; passes_executed={len(passes)}; max_passes={controls.max_passes if controls.enabled else 1}; enabled={str(controls.enabled).lower()}."
    told = (MATCHED_MESSAGE if matched else UNMATCHED_MESSAGE, summary, *messages)
    return StageResult(data, table, tuple(passes), stop, matched, max(rows - matched, 0), tuple(column_states), told, rows)
