"""Sheets of .xlsx workbooks: reading their rows and writing them."""

from __future__ import annotations

import datetime
import io
import posixpath
import re
import zipfile
from collections.abc import Iterable, Iterator, Mapping, Sequence
from decimal import Decimal
from itertools import chain
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

# Fixed values of the file format.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
SHARED = "xl/sharedStrings.xml"
STYLES = "xl/styles.xml"
WORKBOOK = "xl/workbook.xml"
DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}


def _column_index(reference: str) -> int:
    index = 0
    for letter in re.match(r"[A-Z]+", reference).group():
        index = index * 26 + ord(letter) - ord("A") + 1
    return index - 1


def _decoded(text: str) -> str:
    """Text with the format's escapes of characters that XML can't hold."""
    return re.sub("_x([0-9A-Fa-f]{4})_", lambda m: chr(int(m[1], 16)), text) if "_x" in text else text


def _text(node) -> str:
    """The text of a cell or shared string: its own and that of its runs, but not how it is pronounced."""
    own = [t.text or "" for t in node.findall(f"{MAIN}t")]
    return _decoded("".join(own + [t.text or "" for run in node.findall(f"{MAIN}r") for t in run.findall(f"{MAIN}t")]))


class _Book:
    """Where the sheets are, the shared strings, and which styles show dates."""

    def __init__(self, book: zipfile.ZipFile):
        names = set(book.namelist())
        root = ElementTree.fromstring(book.read(WORKBOOK)) if WORKBOOK in names else None
        self.sheets = self._sheets(book, root, names)
        properties = None if root is None else root.find(f"{MAIN}workbookPr")
        old = properties is not None and properties.get("date1904") in ("1", "true")
        self.start = datetime.datetime(1904, 1, 1) if old else datetime.datetime(1899, 12, 30)
        self.shared = [_text(s) for s in ElementTree.fromstring(book.read(SHARED)).iter(f"{MAIN}si")] if SHARED in names else []
        self.dates = self._date_styles(ElementTree.fromstring(book.read(STYLES))) if STYLES in names else set()

    @staticmethod
    def _sheets(book: zipfile.ZipFile, root, names: set[str]) -> dict[str, str]:
        """Names and parts of the sheets, in the workbook's order."""
        links = "xl/_rels/workbook.xml.rels"
        sheets = [] if root is None else root.findall(f"{MAIN}sheets/{MAIN}sheet")
        targets = {}
        if links in names:
            for link in ElementTree.fromstring(book.read(links)):
                targets[link.get("Id")] = posixpath.normpath(posixpath.join("/xl", link.get("Target"))).lstrip("/")
        found = {s.get("name"): targets.get(s.get(f"{RELATION}id")) for s in sheets}
        return {name: part for name, part in found.items() if part} or {"Sheet1": "xl/worksheets/sheet1.xml"}

    @staticmethod
    def _date_styles(root) -> set[int]:
        custom = {int(f.get("numFmtId")): f.get("formatCode") or "" for f in root.iter(f"{MAIN}numFmt")}
        shown = {k for k, code in custom.items() if re.search("[ymdhs]", re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", code.lower()))}
        styles = root.find(f"{MAIN}cellXfs")
        kinds = [int(x.get("numFmtId", 0)) for x in (styles if styles is not None else ())]
        return {i for i, kind in enumerate(kinds) if kind in shown or (kind in DATE_FORMATS and kind not in custom)}

    def value(self, cell):
        kind = cell.get("t", "n")
        if kind == "inlineStr":
            inline = cell.find(f"{MAIN}is")
            return None if inline is None else _text(inline)
        raw = cell.findtext(f"{MAIN}v")
        if raw is None or kind == "e":
            return None
        if kind == "s":
            return self.shared[int(raw)]
        if kind == "b":
            return raw == "1"
        if kind in ("str", "d"):
            return _decoded(raw)
        if int(cell.get("s", 0)) in self.dates:
            days = float(raw)
            # Numbers of days are doubles; their last bits are worth some hundred microseconds.
            moment = self.start + datetime.timedelta(milliseconds=round(days * 86_400_000))
            return moment if moment.time() != datetime.time() else moment.date()
        return int(raw) if re.fullmatch(r"-?[0-9]+", raw) else float(raw)


def sheet_names(file: io.IOBase) -> list[str]:
    """Names of a workbook's sheets; only its directory and short parts are read."""
    with zipfile.ZipFile(file) as archive:
        return list(_Book(archive).sheets)


def cell_rows(file: io.IOBase, sheet: str | None = None) -> Iterator[tuple[dict[int, str], dict]]:
    """(header by place, cells by place) of every row below the header of a sheet, the first one if none is named.

    Cells styled as dates become dates (or datetimes, with a time of day), error cells are missing values, and a cell that
    does not say where it stands follows the one before it. The sheet is parsed as it is read; only shared strings are held.
    """
    with zipfile.ZipFile(file) as archive:
        book = _Book(archive)
        if sheet is not None and sheet not in book.sheets:
            raise ValueError(f"no sheet {sheet!r}, but {list(book.sheets)}")
        header: dict[int, str] | None = None
        with archive.open(next(iter(book.sheets.values())) if sheet is None else book.sheets[sheet]) as part:
            for _, row in ElementTree.iterparse(part):
                if row.tag != f"{MAIN}row":
                    continue
                cells, at = {}, -1
                for cell in row.findall(f"{MAIN}c"):
                    at = _column_index(cell.get("r")) if cell.get("r") else at + 1
                    cells[at] = book.value(cell)
                if header is None:
                    header = {i: str(name) for i, name in cells.items() if name is not None}
                else:
                    yield header, cells
                row.clear()


def header_of(file: io.IOBase, sheet: str | None = None) -> list[str]:
    """The names in a sheet's first row, also if nothing follows it."""
    with zipfile.ZipFile(file) as archive:
        book = _Book(archive)
        with archive.open(next(iter(book.sheets.values())) if sheet is None else book.sheets[sheet]) as part:
            for _, row in ElementTree.iterparse(part):
                if row.tag == f"{MAIN}row":
                    return [str(v) for v in map(book.value, row.findall(f"{MAIN}c")) if v is not None]
    return []


def sheet_rows(content: bytes) -> Iterator[dict]:
    """Rows of the workbook's first sheet as dicts keyed by its header row, see :func:`cell_rows`."""
    for header, cells in cell_rows(io.BytesIO(content)):
        yield {name: cells.get(i) for i, name in header.items()}


# Fixed parts of a workbook: what each part is, and one style each for numbers, dates and moments.
_KINDS = "application/vnd.openxmlformats-officedocument.spreadsheetml"
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_XML = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
_STYLES = (
    f'{_XML}<styleSheet xmlns="{MAIN[1:-1]}"><numFmts count="1"><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd hh:mm:ss.000"/></numFmts>'
    '<fonts count="1"><font/></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs>'
    '<cellXfs count="3"><xf numFmtId="0"/><xf numFmtId="14" applyNumberFormat="1"/><xf numFmtId="164" applyNumberFormat="1"/></cellXfs></styleSheet>'
)
_DATE_STYLE, _MOMENT_STYLE = 1, 2
_START = datetime.datetime(1899, 12, 30)
_NOT_XML = re.compile("_x(?=[0-9A-Fa-f]{4}_)|[\x00-\x08\x0b-\x1f\ufffe\uffff]")
MOST_ROWS = 1_048_575  # of a sheet, below its header


def _escaped(text: str) -> str:
    return escape(_NOT_XML.sub(lambda m: "_x005F_x" if m[0] == "_x" else f"_x{ord(m[0]):04X}_", text))


def _cell(value) -> str:
    if value is None or (isinstance(value, float) and value != value):
        return "<c/>"
    if isinstance(value, bool):
        return f'<c t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float, Decimal)):
        return f"<c><v>{value!r}</v></c>" if not isinstance(value, Decimal) else f"<c><v>{value}</v></c>"
    if isinstance(value, datetime.datetime):
        since = value.replace(tzinfo=None) - _START
        return f'<c s="{_MOMENT_STYLE}"><v>{since.days + (since.seconds + since.microseconds / 1e6) / 86_400!r}</v></c>'
    if isinstance(value, datetime.date):
        return f'<c s="{_DATE_STYLE}"><v>{(value - _START.date()).days}</v></c>'
    return f'<c t="inlineStr"><is><t xml:space="preserve">{_escaped(str(value))}</t></is></c>'


def write_workbook(file, names: Sequence[str], sheets: Mapping[str, Iterable[Sequence]]) -> None:
    """Write sheets of rows, each below a header of ``names``. A missing value is an empty cell, an infinite number its text."""
    sheets = dict(sheets) or {"Sheet1": ()}
    for name in sheets:
        if not name or len(name) > 31 or re.search(r"[\[\]:*?/\\]", name):
            raise ValueError(f"no name for a sheet: {name!r}")
    places = range(1, len(sheets) + 1)
    kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{_KINDS}.worksheet+xml"/>' for i in places)
    listed = "".join(f'<sheet name={quoteattr(name)} sheetId="{i}" r:id="rId{i}"/>' for i, name in zip(places, sheets, strict=True))
    links = "".join(f'<Relationship Id="rId{i}" Type="{_OFFICE}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in places)
    parts = {
        "[Content_Types].xml": f'<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        f'<Override PartName="/xl/workbook.xml" ContentType="{_KINDS}.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="{_KINDS}.styles+xml"/>{kinds}</Types>',
        "_rels/.rels": f'<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" Type="{_OFFICE}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        WORKBOOK: f'<workbook xmlns="{MAIN[1:-1]}" xmlns:r="{_OFFICE}"><sheets>{listed}</sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_PACKAGE}/relationships">{links}'
        f'<Relationship Id="rId0" Type="{_OFFICE}/styles" Target="styles.xml"/></Relationships>',
    }
    with zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in parts.items():
            archive.writestr(name, _XML + text)
        archive.writestr(STYLES, _STYLES)
        for i, rows in zip(places, sheets.values(), strict=True):
            with archive.open(f"xl/worksheets/sheet{i}.xml", "w") as part:
                part.write(f'{_XML}<worksheet xmlns="{MAIN[1:-1]}"><sheetData>'.encode())
                for row in chain([names], rows):
                    part.write(f"<row>{''.join(map(_cell, row))}</row>".encode())
                part.write(b"</sheetData></worksheet>")
