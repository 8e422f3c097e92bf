"""Spreadsheet workbooks as text, read and written with the standard library alone."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterable, Iterator
from datetime import datetime, timedelta
from functools import cached_property, lru_cache
from typing import IO
from xml.etree import ElementTree
from xml.parsers import expat
from xml.sax.saxutils import escape

from harrow.settings import HarmonizeError

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_ROW, _C, _V, _T = (f"{_MAIN[1:]}{x}" for x in ("row", "c", "v", "t"))
_EPOCH = (1980, 1, 1, 0, 0, 0)


@lru_cache(1 << 14)
def _letters_column(letters: str) -> int:
    n = 0
    for c in re.match(r"[A-Za-z]*", letters)[0].upper():
        n = n * 26 + ord(c) - 64
    return n - 1


def _column(reference: str) -> int:
    return _letters_column(reference.rstrip("0123456789"))


def number_text(raw: str) -> str:
    """A stored number as the shortest text that reads back as it, without a trailing ``.0``."""
    x = float(raw)
    shown = str(int(x)) if x.is_integer() and abs(x) < 1e15 else repr(x)
    return shown.removesuffix(".0")


def _text(node: ElementTree.Element) -> str:
    return "".join(t.text or "" for t in node.iter(f"{_MAIN}t"))


# The number formats of spreadsheets that show a date or a time of day, and days from which serial numbers count.
_DATE_FORMATS = frozenset((*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)))
_EPOCHS = {False: datetime(1899, 12, 30), True: datetime(1904, 1, 1)}


def is_date_format(code: str) -> bool:
    """Whether a custom number format shows days or times: one of their letters outside quotes, escapes and brackets."""
    bare = re.sub(r'"[^"]*"|\\.|_.|\*.|\[(?![hms]+\])[^\]]*\]', "", code.lower())
    return bool(re.search("[dmyhs]", bare)) and bare != "general"


def date_text(raw: str, from_1904: bool = False) -> str:
    """A serial number of a date-styled cell as ``YYYY-MM-DD HH:MM:SS``; one that no calendar has stays a number."""
    serial = float(raw)
    if not from_1904 and 0 <= serial < 60:
        serial += 1  # the calendar of spreadsheets has a 29 February 1900
    try:
        moment = _EPOCHS[from_1904] + timedelta(seconds=round(serial * 86400))
    except (OverflowError, ValueError):
        return number_text(raw)
    return moment.strftime("%Y-%m-%d %H:%M:%S") if moment.year >= 1000 else number_text(raw)


class Workbook:
    """A workbook opened from bytes or a seekable file; sheets are parsed row by row as they are read."""

    def __init__(self, source: bytes | IO[bytes]):
        try:
            self.zip = zipfile.ZipFile(io.BytesIO(source) if isinstance(source, bytes) else source)
        except (zipfile.BadZipFile, ValueError):  # the second where a file is too short to look back in
            raise HarmonizeError("not an .xlsx workbook (.xls files can't be read)") from None
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(self.zip.read("xl/_rels/workbook.xml.rels"))}
        book = ElementTree.fromstring(self.zip.read("xl/workbook.xml"))
        self.from_1904 = any(x.get("date1904") in ("1", "true") for x in book.iter(f"{_MAIN}workbookPr"))
        #: Sheet names in order, with the part that holds each.
        self.sheets: dict[str, str] = {}
        for sheet in book.iter(f"{_MAIN}sheet"):
            target = targets[sheet.get(f"{_REL}id")].lstrip("/")
            self.sheets[sheet.get("name")] = target if target.startswith("xl/") else f"xl/{target}"

    def size(self, sheet: str) -> int:
        """The bytes of a sheet's text before compression."""
        return self.zip.getinfo(self.sheets[sheet]).file_size

    def _part(self, name: str) -> ElementTree.Element | None:
        return ElementTree.fromstring(self.zip.read(name)) if name in self.zip.namelist() else None

    @cached_property
    def shared(self) -> list[str]:
        part = self._part("xl/sharedStrings.xml")
        return [] if part is None else [_text(x) for x in part.iter(f"{_MAIN}si")]

    @cached_property
    def date_styles(self) -> frozenset[int]:
        """The cell styles whose number format shows dates."""
        part = self._part("xl/styles.xml")
        if part is None:
            return frozenset()
        custom = {int(f.get("numFmtId")): is_date_format(f.get("formatCode", "")) for f in part.iter(f"{_MAIN}numFmt")}
        formats = [int(x.get("numFmtId", "0")) for found in part.iter(f"{_MAIN}cellXfs") for x in found.iter(f"{_MAIN}xf")]
        return frozenset(i for i, f in enumerate(formats) if custom.get(f, f in _DATE_FORMATS))

    def _value(self, kind: str, style: int, raw: str | None) -> str | None:
        if raw is None or kind == "inlineStr":
            return raw
        if kind == "s":
            return self.shared[int(raw)]
        if kind == "b":
            return "true" if raw == "1" else "false"
        if kind in ("str", "d", "e"):
            return raw
        return date_text(raw, self.from_1904) if style in self.date_styles else number_text(raw)

    def rows(self, sheet: str, wanted: Callable[[list[str | None]], set[int]] | None = None) -> Iterator[list[str | None]]:
        """The rows of a sheet as text; an empty cell is null.

        ``wanted`` is asked, with the first row, which columns are needed; the cells of others are left null unread.
        """
        reader = _RowReader(self._value, wanted)
        with self.zip.open(self.sheets[sheet]) as part:
            while block := part.read(1 << 16):
                yield from reader.feed(block)
            yield from reader.feed(b"", last=True)


class _RowReader:
    """Rows of a sheet from its XML, block by block; nothing is built of cells that aren't needed."""

    def __init__(self, value: Callable[[str, int, str | None], str | None], wanted: Callable[[list[str | None]], set[int]] | None):
        self.value, self.wanted, self.needed = value, wanted, None
        self.done: list[list[str | None]] = []
        self.cells: dict[int, str | None] = {}
        self.seen, self.first, self.read = 0, True, False
        self.parser = expat.ParserCreate(namespace_separator="}")
        self.parser.buffer_text = True
        self.parser.StartElementHandler, self.parser.EndElementHandler = self.start, self.end

    def feed(self, block: bytes, last: bool = False) -> list[list[str | None]]:
        try:
            self.parser.Parse(block, last)
        except expat.ExpatError as e:
            raise ElementTree.ParseError(str(e)) from None
        found, self.done = self.done, []
        return found

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        if tag == _C:
            at = _column(attributes["r"]) if attributes.get("r") else self.seen
            self.seen += 1
            self.read = self.needed is None or at in self.needed
            if self.read:
                self.at, self.kind, self.style = at, attributes.get("t", "n"), int(attributes.get("s", "0"))
                self.text: list[str] = []
                self.inside = _T if self.kind == "inlineStr" else _V
        elif self.read and tag == self.inside:
            self.parser.CharacterDataHandler = self.text.append

    def end(self, tag: str) -> None:
        if not self.read and tag != _ROW:
            return
        if tag == _C:
            self.cells[self.at] = self.value(self.kind, self.style, "".join(self.text) or None)
            self.read = False
        elif tag == _ROW:
            found = [self.cells.get(i) or None for i in range(max(self.cells, default=-1) + 1)]
            if self.first and self.wanted is not None:
                self.needed = self.wanted(found)
            self.cells, self.seen, self.first = {}, 0, False
            self.done.append(found)
        elif tag == self.inside:
            self.parser.CharacterDataHandler = None


def read_workbook(data: bytes) -> dict[str, list[list[str | None]]]:
    """All sheets in workbook order as rows of text cells; an empty cell is null."""
    book = Workbook(data)
    return {sheet: list(book.rows(sheet)) for sheet in book.sheets}


def sheet_table(rows: list[list[str | None]]) -> tuple[list[str], list[list[str | None]]]:
    """A sheet's header and its rows, all as long as the header; columns without a name are numbered."""
    if not rows:
        return [], []
    width = max(len(r) for r in rows)
    header = [(rows[0][i] if i < len(rows[0]) else None) or f"column_{i + 1}" for i in range(width)]
    return header, [[r[i] if i < len(r) else None for i in range(width)] for r in rows[1:]]


@lru_cache(1 << 14)
def _letters(i: int) -> str:
    out = ""
    while i >= 0:
        i, k = divmod(i, 26)
        out, i = chr(65 + k) + out, i - 1
    return out


def _row_xml(n: int, row: list[str | None | datetime]) -> str:
    """A row of text cells; a moment becomes a number in the style of dates."""
    cells = []
    for i, v in enumerate(row):
        if isinstance(v, datetime):
            cells.append(f'<c r="{_letters(i)}{n}" s="1"><v>{(v - _EPOCHS[False]).total_seconds() / 86400!r}</v></c>')
        elif isinstance(v, float):
            cells.append(f'<c r="{_letters(i)}{n}"><v>{v!r}</v></c>')
        elif v is not None:
            cells.append(f'<c r="{_letters(i)}{n}" t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>')
    return f'<row r="{n}">' + "".join(cells) + "</row>"


def write_workbook(out: IO[bytes], sheets: dict[str, Iterable[list[str | None | float | datetime]]]) -> None:
    """Write the sheets to ``out`` row by row; text cells, numbers and moments.  Equal sheets give equal bytes."""
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006"
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    ids = range(1, len(sheets) + 1)
    parts = {
        "[Content_Types].xml": f'<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="{kind}.styles+xml"/>'
        + "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kind}.worksheet+xml"/>' for i in ids) + "</Types>",
        "_rels/.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{_MAIN[1:-1]}" xmlns:r="{office}"><sheets>'
        + "".join(f'<sheet name="{escape(n, {chr(34): "&quot;"})}" sheetId="{i}" r:id="rId{i}"/>' for i, n in zip(ids, sheets)) + "</sheets></workbook>",
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{package}/relationships">'
        + "".join(f'<Relationship Id="rId{i}" Type="{office}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in ids)
        + f'<Relationship Id="rId{len(sheets) + 1}" Type="{office}/styles" Target="styles.xml"/></Relationships>',
        "xl/styles.xml": f'<styleSheet xmlns="{_MAIN[1:-1]}"><fonts count="1"><font/></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs>'
        '<cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="22" applyNumberFormat="1"/></cellXfs></styleSheet>',
    }
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in parts.items():
            z.writestr(zipfile.ZipInfo(name, _EPOCH), head + content, zipfile.ZIP_DEFLATED)
        for i, rows in zip(ids, sheets.values()):
            info = zipfile.ZipInfo(f"xl/worksheets/sheet{i}.xml", _EPOCH)
            info.compress_type = zipfile.ZIP_DEFLATED
            with z.open(info, "w", force_zip64=True) as part:
                part.write(f'{head}<worksheet xmlns="{_MAIN[1:-1]}"><sheetData>'.encode())
                for n, row in enumerate(rows, 1):
                    part.write(_row_xml(n, row).encode())
                part.write(b"</sheetData></worksheet>")


def workbook_bytes(sheets: dict[str, list[list[str | None]]]) -> bytes:
    """A workbook in memory."""
    out = io.BytesIO()
    write_workbook(out, sheets)
    return out.getvalue()
