"""Names, defaults and folders of a harmonization run."""

from __future__ import annotations

import os
import re
import unicodedata
from dataclasses import dataclass, field
from pathlib import Path

# Column names, orders, directives and file names of the data contract.
CANONICAL_COLUMNS = (
    "hemisphere", "continent", "iso_whep", "polity", "commodity", "variable", "unit",
    "year", "value", "notes", "footnotes", "yearbook", "file",
)
BASE_COLUMNS = ("continent", "polity", "unit", "footnotes")
ID_COLUMNS = ("commodity", "variable", "unit", "hemisphere", "continent", "iso_whep", "polity", "footnotes")
AUDIT_COLUMNS = ("continent", "polity", "commodity", "variable", "unit", "yearbook", "file")
LIST_COLUMNS = (
    "hemisphere", "continent", "iso_whep", "polity", "commodity", "variable", "unit",
    "notes", "footnotes", "yearbook", "file",
)
KEY_TEXT_COLUMNS = ("variable", "hemisphere", "continent", "polity")
UNKEYED_COLUMNS = ("year", "value", "yearbook", "file")
CONCATENATED_COLUMNS = ("notes",)
HEADER_ALIASES = {"country": "polity"}
UNKNOWN_COMMODITY = "(unknown_commodity)"
BLANK_LABEL = "(blank)"
ISO_PREFIX = "iso-"
COMMODITY_START = 6
ANY, EXACT, REPLACE = "#ANY#", "#EXACT#", "#REPLACE#"
NA_KEY, NA_VALUE = "..NA_MATCH_KEY..", "..NA_INTERNAL.."
FALLBACK_COMMODITY = "all"
RULE_COLUMNS = ("column_source", "value_source_raw", "value_source", "column_target", "value_target_raw", "value_target")
CONVERSION_COLUMNS = ("commodity_key", "unit_source", "unit_target", "unit_factor", "unit_offset")
CONVERSION_ALIASES = {
    "commodity": "commodity_key", "source_unit": "unit_source", "target_unit": "unit_target",
    "multiplier": "unit_factor", "addend": "unit_offset", "from_unit": "unit_source",
    "to_unit": "unit_target", "factor": "unit_factor", "offset": "unit_offset",
}
EXCLUDED_SHEETS = ("master_unit",)
STAGES = ("clean", "harmonize")
# The columns of summaries and logs, and what they are sorted by.
CATALOG = ("rule_file_identifier", "column_source", "value_source_raw", "value_source", "column_target", "value_target_raw", "value_target")
STAGE_SUMMARY = ("loop", "affected_rows", *CATALOG)
STAGE_ORDER = ("loop", "rule_file_identifier", "column_source", "column_target", "value_source_raw", "value_source", "value_target_raw", "value_target", "affected_rows")
UNMATCHED_KEY = ("rule_file_identifier", "column_source", "value_source_raw", "column_target", "value_target_raw")
STANDARDIZE_CATALOG = ("rule_file_identifier", "commodity_key", "unit_source", "unit_target", "unit_factor", "unit_offset", "source_unit_raw", "detected_prefix", "unit_factor_effective")
STANDARDIZE_SUMMARY = ("affected_rows", *STANDARDIZE_CATALOG)
STANDARDIZE_ORDER = ("rule_file_identifier", "commodity_key", "unit_source", "unit_target", "unit_factor", "unit_factor_effective", "unit_offset", "affected_rows")
ROOT_MARKERS = ("pyproject.toml", ".git")
LAYERS = ("raw", "clean", "normalize", "harmonize")
MATCHED_MESSAGE = "Rules applied successfully"
UNMATCHED_MESSAGE = "No rows matched available rules"
NO_CONVERSIONS_MESSAGE = "no numeric standardization rules found"


class HarmonizeError(ValueError):
    """Input, rules or configuration that a run can't go on with."""


def dataset_name(name: str) -> str:
    """A name in snake case: without accents, lower case, and everything between letters and digits as one underscore."""
    plain = "".join(c for c in unicodedata.normalize("NFD", name) if not unicodedata.combining(c)).lower()
    return re.sub(r"\s+", "_", re.sub(r"[^a-z0-9 ]", " ", plain).strip())


def project_root(start: str | Path | None = None) -> Path:
    """The folder that ``HARROW_ROOT`` names, or the nearest one above ``start`` with a project file or repository, or ``start`` itself."""
    forced = os.environ.get("HARROW_ROOT")
    if forced:
        return Path(forced).expanduser().resolve()
    origin = Path(start if start is not None else Path.cwd()).resolve()
    origin = origin if origin.is_dir() else origin.parent
    return next((p for p in (origin, *origin.parents) if any((p / marker).exists() for marker in ROOT_MARKERS)), origin)


@dataclass(frozen=True)
class MultiPass:
    """How often a rule stage is repeated, and what a cycle does: ``warn`` or ``abort``."""

    enabled: bool = True
    max_passes: int = 10
    cycle_policy: str = "warn"

    def __post_init__(self) -> None:
        if self.max_passes < 1 or self.cycle_policy not in ("warn", "abort"):
            raise HarmonizeError("max_passes must be positive and cycle_policy warn or abort")


@dataclass(frozen=True)
class Settings:
    """Folders and options of a run; every path is under ``root``."""

    root: str = "."
    required: tuple[str, ...] = BASE_COLUMNS
    audit_columns: tuple[str, ...] = AUDIT_COLUMNS
    list_columns: tuple[str, ...] = LIST_COLUMNS
    multi_pass: dict[str, MultiPass] = field(default_factory=dict)
    current_year: int | None = None
    checkpoints: bool = False
    overwrite: bool = True
    drop_nulls: bool = True
    one_file: bool = True

    def path(self, *parts: str) -> Path:
        return Path(self.root, *parts)

    @property
    def raw(self) -> Path:
        return self.path("data", "input", "raw")

    def rules(self, stage: str) -> Path:
        return self.path("data", "input", stage)

    @property
    def audit(self) -> Path:
        return self.path("data", "postpro")

    @property
    def processed(self) -> Path:
        return self.path("data", "output", "processed")

    @property
    def lists(self) -> Path:
        return self.path("data", "output", "lists")

    @property
    def checkpoint_folder(self) -> Path:
        return self.path("data", ".checkpoints")

    def passes(self, stage: str) -> MultiPass:
        return self.multi_pass.get(stage, MultiPass())

    def create_folders(self) -> list[Path]:
        """Make all folders of a run and return them."""
        found = [
            self.raw, *(self.rules(s) for s in ("clean", "standardize", "harmonize")),
            *(self.audit / d for d in ("logs", "duplicates", "diagnostics", "templates")), self.processed, self.lists,
        ]
        for folder in found:
            folder.mkdir(parents=True, exist_ok=True)
        return found

    @classmethod
    def from_environment(cls, root: str = ".") -> Settings:
        """Options from ``HARROW_CHECKPOINTS``, ``HARROW_OVERWRITE``, ``HARROW_DROP_NULLS``, ``HARROW_ONE_FILE`` and ``HARROW_YEAR``."""
        on = lambda name, default: os.environ.get(name, default).strip().lower() in ("1", "true", "yes", "on")
        year = os.environ.get("HARROW_YEAR")
        return cls(root=root, checkpoints=on("HARROW_CHECKPOINTS", "0"), overwrite=on("HARROW_OVERWRITE", "1"), drop_nulls=on("HARROW_DROP_NULLS", "1"), one_file=on("HARROW_ONE_FILE", "1"), current_year=int(year) if year else None)
