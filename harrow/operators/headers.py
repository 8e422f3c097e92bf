"""Column names: normalization, canonical renames, year columns.  These work on schemas, never on rows."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrow.functions import text
from harrow.settings import CANONICAL_COLUMNS, HEADER_ALIASES, HarmonizeError

# The patterns of year headers.
_YEAR = re.compile(r"^\d{4}(-\d{4})?$")


@lru_cache(1 << 14)
def normalize_header(name: str | None) -> str | None:
    """One header as its matching key; a null stays null."""
    if name is None:
        return None
    out = re.sub(r"\s*([/-])\s*", r"\1", re.sub(r"\s+", " ", name.strip()))
    out = "".join(c for c in unicodedata.normalize("NFD", out) if not unicodedata.combining(c)).lower()
    return re.sub(r"_{2,}", "_", re.sub(r"[^a-z0-9\-/]+", "_", out)).strip("_")


#: White space as Python strips it from names; the class of Java's patterns lacks the separators U+001C to U+001F.
_SPACE = r"[\x1c-\x1f\s]"


def header_key(c: Column) -> Column:
    """:func:`normalize_header` over a column of names."""
    out = F.regexp_replace(c, rf"(?U)^{_SPACE}+|{_SPACE}+$", "")
    out = F.regexp_replace(F.regexp_replace(out, rf"(?U){_SPACE}+", " "), rf"(?U){_SPACE}*([/-]){_SPACE}*", "$1")
    out = F.regexp_replace(F.regexp_replace(text.fold(out), "[^a-z0-9\\-/]+", "_"), "_{2,}", "_")
    return F.btrim(out, F.lit("_"))


def header_collisions(names: list[str], where: str = "") -> list[str]:
    """A message for each key that several headers normalize to."""
    by_key: dict[str, list[str]] = {}
    for name in names:
        by_key.setdefault(normalize_header(name) or "", []).append(name)
    return [f"headers {', '.join(repr(n) for n in found)} normalize to the same name '{key}'{where and f' in {where}'}" for key, found in by_key.items() if len(found) > 1]


def canonical_renames(names: list[str], canonical: tuple[str, ...] = CANONICAL_COLUMNS, aliases: dict[str, str] | None = None) -> dict[str, str]:
    """Which headers take a canonical name: those with its key, then aliases whose target nothing else has."""
    aliases = HEADER_ALIASES if aliases is None else aliases
    first: dict[str, str] = {}
    for name in names:
        first.setdefault(normalize_header(name), name)
    renames: dict[str, str] = {}
    for target in dict.fromkeys(canonical):
        raw = first.get(normalize_header(target) or None)
        if target not in names and raw is not None:
            renames[raw] = target
    held = {*names, *renames.values()}
    for source, target in aliases.items():
        raw = first.get(normalize_header(source) or None)
        if target in canonical and target not in held and raw is not None and raw not in renames:
            renames[raw] = target
            held.add(target)
    return {a: b for a, b in renames.items() if a != b}


@lru_cache(1 << 14)
def clean_year(name: str) -> str:
    """A year header without a spreadsheet's ``.0``; crop years become their first year, and ranges of them a range."""
    name = re.sub(r"\.0$", "", name)
    name = re.sub(r"^(\d{4})-\d{2}$", r"\1", name)
    return re.sub(r"^(\d{4})-\d{2}/(\d{4})-\d{2}$", r"\1-\2", name)


def clean_year_names(names: list[str]) -> list[str]:
    cleaned = [clean_year(n) for n in names]
    twice = [n for n, k in Counter(cleaned).items() if k > 1]
    if twice:
        raise HarmonizeError(f"year headers collide after cleaning: {twice} (from {names})")
    return cleaned


def year_columns(names: list[str]) -> list[str]:
    """The names that look like a year or a range of years."""
    known = set(CANONICAL_COLUMNS) - {"year", "value"}
    return [n for n in names if n not in known and _YEAR.search(n)]


def with_canonical_names(df: DataFrame) -> DataFrame:
    """``df`` with canonical names and clean year headers; names that collide raise an error."""
    collisions = header_collisions(df.columns)
    if collisions:
        raise HarmonizeError("; ".join(collisions))
    df = df.withColumnsRenamed(canonical_renames(df.columns))
    return df.toDF(*clean_year_names(df.columns))
