"""Folders of workbooks as long facts, through a data source of its own.

The driver lists files and their sheets.  A partition holds one large sheet or some small ones; its task opens each file in the
store where it lies, parses the sheet row by row, reads the needed columns only, and hands on Arrow batches of long rows.
"""

from __future__ import annotations

import zipfile
import zlib
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack
from dataclasses import dataclass, field
from functools import partial
from itertools import groupby, islice
from operator import itemgetter
from pathlib import Path
from xml.etree import ElementTree

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from harrow.functions import text
from harrow.operators.headers import canonical_renames, clean_year, clean_year_names, header_collisions, normalize_header, year_columns
from harrow.operators.reshape import file_metadata
from harrow.settings import BASE_COLUMNS, COMMODITY_START, ID_COLUMNS, KEY_TEXT_COLUMNS, UNKNOWN_COMMODITY, HarmonizeError
from harrow.sources.xlsx import Workbook, read_workbook, sheet_table

LONG = (
    "hemisphere string, continent string, iso_whep string, polity string, commodity string, variable string, unit string, year string, value string, notes string, "
    "footnotes string, yearbook string, file string, _path string, _year_no int, _sheet_no int, _row_no int, _error string"
)
COLUMNS = [f.split()[0] for f in LONG.split(", ")]
#: Bytes of sheet text in a partition, and rows in an Arrow batch.
PARTITION_BYTES, BATCH_ROWS = 8 << 20, 10_000
#: Files beyond which the driver opens large ones only; the bytes of sheet text that one of a file stands for then, partitions over which
#: such a folder is spread, and the sheet text up to which these grow for it.
MANY_FILES, TEXT_BYTES, MANY_PARTITIONS, GROWN_BYTES = 200, 20, 500, 32 << 20


def found_files(spark: SparkSession, folder: str) -> DataFrame:
    """``file_metadata`` of all ``.xlsx`` files below a folder; empty if there are none."""
    if "://" not in folder and not Path(folder).is_dir():
        raise HarmonizeError(f"folder does not exist: {folder}")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.xlsx").load(folder)
    return file_metadata(files.select(F.regexp_replace("path", r"^file:/+", "/").alias("file_path")))


def discover(spark: SparkSession, folder: str) -> DataFrame:
    """:func:`found_files` in order of their paths."""
    return found_files(spark, folder).orderBy("file_path")


def _unreadable(path: str, why: Exception) -> str:
    return f"failed to read file '{path.rpartition('/')[2]}': {why}"


def _sheets(book: Workbook) -> list[tuple[str, int]]:
    """The sheets of a workbook with the bytes of their text."""
    return [(s, book.size(s)) for s in book.sheets]


def _record(**values: object) -> list:
    """A long row with these columns set."""
    return [values.get(c) for c in COLUMNS]


def _error(path: str, message: str) -> tuple:
    return tuple(_record(_path=path, _error=message))


def sheet_records(path: str, name: str, sheet_no: int, sheet: str, rows: Callable[..., Iterator[list[str | None]]], base: tuple[str, ...]) -> Iterator[tuple]:
    """The long rows of one sheet, in the order of ``COLUMNS``, and its errors as rows with ``_error``.

    ``rows`` gives the sheet's rows and takes a function that tells from the first which columns are needed.
    """
    parts = name.split("_")
    yearbook = text.yearbook_of(parts)
    commodity = text.normalize_value((text.commodity_of(parts, COMMODITY_START) or "").strip() or UNKNOWN_COMMODITY)
    renames: dict[str, str] = {}
    names: list[str] = []

    def needed(first: list[str | None]) -> set[int]:
        header = [h or f"column_{i}" for i, h in enumerate(first, 1)]
        renames.update(canonical_renames(header, tuple(dict.fromkeys([*base, *ID_COLUMNS]))))
        names.extend(renames.get(h, h) for h in header)
        return {i for i, (h, n) in enumerate(zip(header, names)) if n in base or n in ID_COLUMNS or year_columns([clean_year(n)])}

    body = rows(needed)
    first = next(body, None)
    if first is None:
        return
    collisions = header_collisions([h or f"column_{i}" for i, h in enumerate(first, 1)], f"sheet '{sheet}' of file '{name}'")
    if collisions:
        yield from (_error(path, m) for m in collisions)
        return
    missing = [c for c in base if c not in names]
    if missing:
        yield _error(path, f"sheet '{sheet}' is missing required base columns in file '{name}': {', '.join(missing)}")
    at = {c: i for i, c in enumerate(names)}
    of = lambda r, i: r[i] if i < len(r) else None
    folded = {*KEY_TEXT_COLUMNS, "footnotes"}
    fields = [(at[c], COLUMNS.index(c), c in folded) for c in ID_COLUMNS if c in at and c not in ("commodity", "variable") and c in COLUMNS]
    filled = [at[c] for c in base if c in at]
    row = _record(commodity=commodity, variable=text.normalize_value(sheet) if "variable" in folded else sheet, yearbook=yearbook, file=name, _path=path, _sheet_no=sheet_no)
    year_at, value_at, year_no_at, row_no_at = (COLUMNS.index(c) for c in ("year", "value", "_year_no", "_row_no"))
    years: list[tuple[int, str]] | None = None
    for k, r in enumerate(body):
        if not any((of(r, i) or "").strip() for i in filled):
            continue
        if years is None:
            if yearbook is None:
                raise HarmonizeError(f"file '{name}' has no yearbook in its name")
            cleaned = clean_year_names(names)
            years = [(cleaned.index(y), y) for y in year_columns(cleaned)]
            if not years:
                raise HarmonizeError(f"sheet '{sheet}' of file '{name}' has no year columns")
        for i, to, fold in fields:
            cell = of(r, i)
            row[to] = text.normalize_value(cell) if fold and cell is not None else cell
        row[row_no_at] = k
        for n, (i, year) in enumerate(years):
            row[year_at], row[value_at], row[year_no_at] = year, of(r, i), n
            yield tuple(row)


@dataclass
class SheetPartition(InputPartition):
    """The sheets of a task, each as ``(path, number, name)``, whole files, and errors that were found while listing, as ``(path, message)``."""

    sheets: list[tuple[str, int, str]] = field(default_factory=list)
    errors: list[tuple[str, str]] = field(default_factory=list)
    files: list[str] = field(default_factory=list)


class WorkbookReader(DataSourceReader):
    """One partition for each sheet of ``partition_bytes`` or more of text, and for runs of smaller ones.

    In a folder of many files small ones stay whole and are opened by their tasks, and partitions grow with the folder up to a limit.
    """

    def __init__(self, folder: str, base: tuple[str, ...], partition_bytes: int):
        self.folder, self.base, self.partition_bytes = folder, base, partition_bytes

    def partitions(self) -> list[SheetPartition]:
        system, root = fs.FileSystem.from_uri(self.folder)
        found = system.get_file_info(fs.FileSelector(root, recursive=True))
        files = {f.path: f.size for f in found if f.type == fs.FileType.File and f.path.endswith(".xlsx")}
        paths, most, many = sorted(files), self.partition_bytes, len(files) > MANY_FILES
        if many:
            most = max(most, min(GROWN_BYTES, sum(files.values()) * TEXT_BYTES // MANY_PARTITIONS))
        small = {p for p in paths if many and files[p] * TEXT_BYTES < most}
        parts, held = [SheetPartition()], 0

        def room(size: int) -> SheetPartition:
            nonlocal held
            if held and held + size > most:
                parts.append(SheetPartition())
                held = 0
            held += size
            return parts[-1]

        def listed(path: str) -> tuple[list[tuple[str, int]], str | None]:
            if path in small:
                return [], None
            try:
                with system.open_input_file(path) as f:
                    return _sheets(Workbook(f)), None
            except Exception as e:  # a damaged file is reported, like any other finding
                return [], _unreadable(path, e)

        with ThreadPoolExecutor(16) as pool:
            for path, (sheets, error) in zip(paths, pool.map(listed, paths)):
                if error:
                    parts[-1].errors.append((path, error))
                if path in small:
                    room(files[path] * TEXT_BYTES).files.append(path)
                for number, (sheet, size) in enumerate(sheets):
                    room(size).sheets.append((path, number, sheet))
        return parts

    def read(self, partition: SheetPartition) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(self.folder)
        schema = pa.schema([(c, pa.int32() if c.endswith("_no") else pa.string()) for c in COLUMNS])

        def sheets_of(book: Workbook, path: str, sheets: Iterable[tuple[int, str]]) -> Iterator[tuple]:
            name = path.rpartition("/")[2]
            for number, sheet in sheets:
                if not sheet.isascii():
                    yield _error(path, f"non-ascii sheet name detected: {sheet}")
                try:
                    yield from sheet_records(path, name, number, sheet, partial(book.rows, sheet), self.base)
                except (ElementTree.ParseError, zipfile.BadZipFile, zlib.error, EOFError) as e:
                    yield _error(path, f"failed to read sheet '{sheet}' in file '{name}': {e}")

        def records() -> Iterator[tuple]:
            yield from (_error(*e) for e in partition.errors)
            for path, sheets in groupby(partition.sheets, key=itemgetter(0)):
                with system.open_input_file(path) as f:
                    yield from sheets_of(Workbook(f), path, [s[1:] for s in sheets])
            for path in partition.files:
                with ExitStack() as stack:
                    try:
                        book = Workbook(stack.enter_context(system.open_input_file(path)))
                        names = [s for s, _ in _sheets(book)]
                    except Exception as e:
                        yield _error(path, _unreadable(path, e))
                        continue
                    yield from sheets_of(book, path, enumerate(names))

        rows = records()
        while batch := list(islice(rows, BATCH_ROWS)):
            yield pa.RecordBatch.from_arrays([pa.array(values, f.type) for values, f in zip(zip(*batch), schema)], schema=schema)


class WorkbookSource(DataSource):
    """``spark.read.format("harrow_workbooks").load(folder)``, with ``base`` columns separated by commas."""

    @classmethod
    def name(cls) -> str:
        return "harrow_workbooks"

    def schema(self) -> str:
        return LONG

    def reader(self, schema) -> WorkbookReader:
        base = tuple(self.options.get("base", ",".join(BASE_COLUMNS)).split(","))
        return WorkbookReader(as_uri(self.options["path"]), base, int(self.options.get("partition_bytes", PARTITION_BYTES)))


def as_uri(path: str) -> str:
    return path if "://" in path or path.startswith("file:") else Path(path).resolve().as_uri()


def read_long(spark: SparkSession, folder: str, base: tuple[str, ...] = BASE_COLUMNS, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """The long rows of all workbooks below a folder, all as text, with their places ``_path, _year_no, _sheet_no, _row_no``.

    Unreadable files, header collisions and missing base columns come as rows that have ``_error``
    alone; files without a yearbook or year columns stop the run.  Null values are kept.  The folder may lie in any store that
    pyarrow reads by its address.
    """
    spark.dataSource.register(WorkbookSource)
    return spark.read.format(WorkbookSource.name()).option("base", ",".join(base)).option("partition_bytes", partition_bytes).load(folder)


def read_sheet_wide(spark: SparkSession, data: bytes, sheet: str) -> DataFrame:
    """One sheet of a workbook in memory as a wide frame of text columns with canonical names."""
    header, body = sheet_table(read_workbook(data)[sheet])
    renames = canonical_renames(header)
    names = [renames.get(h, normalize_header(h) or h) for h in header]
    return spark.createDataFrame([tuple(r) for r in body], ", ".join(f"`{n}` string" for n in names))
