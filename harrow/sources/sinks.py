"""Layers as TSV and lists as workbooks, written by tasks to shared storage."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter
from pathlib import Path

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import DoubleType, FloatType

from harrow.functions import numbers, text
from harrow.operators.lists import ListSheets, layer_of
from harrow.settings import HarmonizeError
from harrow.sources.workbooks import as_uri
from harrow.sources.xlsx import workbook_bytes, write_workbook


def rendered(df: DataFrame) -> DataFrame:
    """``df`` with floating-point columns as fixed-notation text."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({c: numbers.format_double(F.col(f"`{c}`").cast("double")) for c in doubles}) if doubles else df


def _quoted(value: str) -> str:
    return '"' + value.replace('"', '""') + '"' if value == "" or any(c in value for c in '\t\n\r"') else value


def _field(c: Column) -> Column:
    """A cell as it stands in a line: quoted only where needed, ``""`` for an empty text and nothing for a null."""
    quoted = F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(c.isNull(), "").when((c == "") | c.rlike('[\t\n\r"]'), quoted).otherwise(c)


def tsv_lines(df: DataFrame) -> DataFrame:
    """``line``: every row as a line, without its end."""
    return rendered(df).select(F.concat_ws("\t", *[_field(F.col(f"`{c}`").cast("string")) for c in df.columns]).alias("line"))


@dataclass
class PartWritten(WriterCommitMessage):
    partition: int
    file: str
    rows: int


class LinesWriter(DataSourceArrowWriter):
    """Tasks write parts beside the target; the commit publishes those of successful tasks in order of partitions, under one header."""

    def __init__(self, target: str, header: str, one_file: bool, parts: str | None = None):
        self.target, self.header, self.one_file = target, header, one_file
        self.parts = parts or f"{target}.parts-{uuid.uuid4().hex[:12]}"
        # here and not in the tasks: one that is still running would bring the folder of a failed write back
        system, _, folder = self._system()
        system.create_dir(folder, recursive=True)

    def _system(self):
        system, target = fs.FileSystem.from_uri(self.target)
        return system, target, fs.FileSystem.from_uri(self.parts)[1]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> PartWritten:
        system, _, parts = self._system()
        context = TaskContext.get()
        number = context.partitionId() if context else 0
        # a repeated or speculative attempt writes a file of its own
        name, rows = f"part-{number:06d}-{uuid.uuid4().hex[:12]}.tsv", 0
        with system.open_output_stream(f"{parts}/{name}", compression=None) as out:
            for batch in iterator:
                lines = batch.column(0).to_pylist()
                if lines:
                    out.write(("\n".join(lines) + "\n").encode())
                    rows += len(lines)
        return PartWritten(number, name, rows)

    def commit(self, messages: list[PartWritten | None]) -> None:
        system, target, parts = self._system()
        system.create_dir(parts, recursive=True)
        done = sorted((m for m in messages if m is not None and m.rows), key=lambda m: m.partition)
        if self.one_file:
            whole = f"{parts}/whole"
            with system.open_output_stream(whole, compression=None) as out:
                out.write(self.header.encode())
                for m in done:
                    with system.open_input_stream(f"{parts}/{m.file}", compression=None) as part:
                        while block := part.read(8 << 20):
                            out.write(block)
            self._clear(system, target)
            system.move(whole, target)
        else:
            kept = {m.file: f"part-{i:06d}.tsv" for i, m in enumerate(done, 1)}
            for found in system.get_file_info(fs.FileSelector(parts)):
                if found.base_name not in kept:
                    system.delete_file(found.path)
            for old, new in kept.items():
                system.move(f"{parts}/{old}", f"{parts}/{new}")
            with system.open_output_stream(f"{parts}/part-000000-header.tsv", compression=None) as out:
                out.write(self.header.encode())
            self._clear(system, target)
            system.move(parts, target)
            return
        system.delete_dir(parts)

    def abort(self, messages: list[PartWritten | None]) -> None:
        system, _, parts = self._system()
        for attempt in range(5):  # tasks that are still running may add a file meanwhile
            try:
                if system.get_file_info(parts).type != fs.FileType.NotFound:
                    system.delete_dir(parts)
                return
            except OSError:
                if attempt == 4:
                    raise
                time.sleep(0.2)

    @staticmethod
    def _clear(system, target: str) -> None:
        kind = system.get_file_info(target).type
        if kind == fs.FileType.Directory:
            system.delete_dir(target)
        elif kind == fs.FileType.File:
            system.delete_file(target)


class LinesSink(DataSource):
    """``df.write.format("harrow_lines")`` of one text column, with the options ``path``, ``header`` and ``one_file``."""

    @classmethod
    def name(cls) -> str:
        return "harrow_lines"

    def schema(self) -> str:
        return "line string"

    def writer(self, schema, overwrite: bool) -> LinesWriter:
        return LinesWriter(self.options["path"], self.options["header"], self.options.get("one_file", "true") == "true")


def _exists(where: str) -> bool:
    system, path = fs.FileSystem.from_uri(where)
    return system.get_file_info(path).type != fs.FileType.NotFound


def write_tsv(df: DataFrame, path: Path | str, overwrite: bool = True, one_file: bool = True) -> Path | str:
    """Tab-separated text with a header; quotes only where needed, ``""`` for an empty text and nothing for a null.

    As one file, or with ``one_file=False`` as a folder of parts whose names give their order, the header being the first: the parts one
    after the other are the file.  Tasks write to the store of ``path`` (anything that pyarrow reads by its address) and rows
    keep the order of ``df``.
    """
    target = as_uri(str(path))
    if _exists(target) and not overwrite:
        raise HarmonizeError(f"file already exists and overwrite is disabled: {path}")
    df.sparkSession.dataSource.register(LinesSink)
    header = "\t".join(map(_quoted, df.columns)) + "\n"
    tsv_lines(df).write.format(LinesSink.name()).options(path=target, header=header, one_file=str(one_file).lower()).mode("append").save()
    return path


def export_layers(objects: dict[str, DataFrame], folder: Path, overwrite: bool = True, one_file: bool = True) -> dict[str, Path]:
    """Each object whose name ends in a layer as ``<name>.tsv``."""
    named = {n: df for n, df in sorted(objects.items()) if layer_of(n)}
    if not named:
        raise HarmonizeError("no layer to export")
    folder.mkdir(parents=True, exist_ok=True)
    return {n: write_tsv(df, folder / f"{text.file_stem(n)}.tsv", overwrite, one_file) for n, df in named.items()}


def write_list_workbook(sheets: dict[str, list[str]], path: Path, overwrite: bool = True) -> Path:
    """One column of values a sheet, without a header."""
    if path.exists() and not overwrite:
        raise HarmonizeError(f"file already exists and overwrite is disabled: {path}")
    path.write_bytes(workbook_bytes({n: [[v] for v in values] for n, values in sheets.items()}))
    return path


def write_list_workbooks(lists: ListSheets, paths: dict[str, str]) -> None:
    """A workbook for each column of some lists, written by the task that has the column's values in order.

    ``paths`` gives each column's address in shared storage.  A list must fit a worksheet, so a workbook holds at most 1,048,576 values for
    each layer; rows are streamed from the sorted partition into it.
    """
    lists.check_sizes()
    names = {c: list(lists.sheets(c)) for c in paths}

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((c, s, v) for b in batches for c, s, v in zip(*(b.column(i).to_pylist() for i in range(3))))
        for column, own in groupby(rows, itemgetter(0)):
            by_sheet = groupby(own, itemgetter(1))
            pending = next(by_sheet)

            def values(sheet: str) -> Iterator[list[str]]:
                nonlocal pending
                if pending is not None and pending[0] == sheet:
                    yield from ([v] for _, _, v in pending[1])
                    pending = next(by_sheet, None)

            system, target = fs.FileSystem.from_uri(paths[column])
            part = f"{target}.{uuid.uuid4().hex[:12]}"
            with system.open_output_stream(part, compression=None) as out:
                write_workbook(out, {s: values(s) for s in names[column]})
            system.move(part, target)
            yield pa.RecordBatch.from_arrays([pa.array([column])], names=["column_name"])

    ordered = lists.rows.where(F.col("column_name").isin(*paths)).repartition(max(len(paths), 1), "column_name").sortWithinPartitions("column_name", "sheet_no", "place")
    written = {r[0] for r in ordered.select("column_name", "sheet", "value").mapInArrow(write, "column_name string").collect()}
    for column in sorted(set(paths) - written):  # without a value anywhere
        system, target = fs.FileSystem.from_uri(paths[column])
        with system.open_output_stream(target, compression=None) as out:
            write_workbook(out, {s: [] for s in names[column]})
