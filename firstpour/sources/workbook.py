"""Reading one sheet of an XLSX workbook as rows of text, streaming over the sheet's XML."""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree

# XML namespaces of the workbook format.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
DOC_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
PKG_REL = "{http://schemas.openxmlformats.org/package/2006/relationships}"

# Number-format ids that mean a date or time.
DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])


ROW, CELL, VALUE, INLINE, TEXT, RUN = (MAIN + tag for tag in ("row", "c", "v", "is", "t", "r"))


# Positions of the column letters met so far. A plain dictionary: this module is shipped to tasks by
# value, which a cached function would not allow.
_positions: dict[str, int] = {}


def _column_index(reference: str) -> int:
    """Position of the column in a cell reference such as ``AB12``."""
    letters = reference.rstrip("0123456789")
    if letters not in _positions:
        index = 0
        for letter in letters.upper():
            index = index * 26 + ord(letter) - ord("A") + 1
        _positions[letters] = index - 1
    return _positions[letters]


def _rich_text(element: ElementTree.Element) -> str:
    """Text of plain or rich strings; phonetic hints are not part of the value."""
    parts = []
    for child in element:
        if child.tag == TEXT:
            parts.append(child.text or "")
        elif child.tag == RUN:
            parts.extend(t.text or "" for t in child.iter(TEXT))
    return "".join(parts)


def _is_date_code(code: str) -> bool:
    bare = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.|_.|\*.', "", code.split(";")[0])
    return re.search(r"[dmyhs]", bare, re.IGNORECASE) is not None and "general" not in bare.lower()


def _number_text(text: str) -> str:
    """Whole numbers without a decimal point, others in their shortest exact form."""
    if re.fullmatch(r"[+-]?\d+", text):
        return str(int(text))
    number = float(text)
    return str(int(number)) if number.is_integer() else repr(number)


def _date_text(text: str, base: datetime) -> str:
    serial = float(text)
    days = int(serial // 1)
    clock = timedelta(milliseconds=round((serial - days) * 86_400_000))
    if 0 <= serial < 1:
        return (base + clock).time().isoformat()
    if base.year == 1899 and days < 60:
        days += 1  # the format counts a 29 February 1900
    moment = base + timedelta(days=days) + clock
    return moment.date().isoformat() if moment.time() == datetime.min.time() else moment.isoformat(" ")


class Workbook:
    """The parts of a workbook needed to read cells: sheets, shared strings, date styles."""

    def __init__(self, content: bytes) -> None:
        self.archive = zipfile.ZipFile(io.BytesIO(content))
        names = set(self.archive.namelist())
        book = ElementTree.fromstring(self.archive.read("xl/workbook.xml"))
        links = ElementTree.fromstring(self.archive.read("xl/_rels/workbook.xml.rels"))
        targets = {r.get("Id"): r.get("Target", "") for r in links.iter(f"{PKG_REL}Relationship")}
        self.sheets = {
            s.get("name"): posixpath.normpath(posixpath.join("/xl", targets[s.get(f"{DOC_REL}id")]))[1:]
            for s in book.iter(f"{MAIN}sheet")
        }
        properties = book.find(f"{MAIN}workbookPr")
        from_1904 = properties is not None and properties.get("date1904") in ("1", "true")
        self.base = datetime(1904, 1, 1) if from_1904 else datetime(1899, 12, 30)
        self.strings = self._shared_strings() if "xl/sharedStrings.xml" in names else []
        self.date_styles = self._date_styles() if "xl/styles.xml" in names else set()

    def _shared_strings(self) -> list[str]:
        found = []
        with self.archive.open("xl/sharedStrings.xml") as part:
            for _, element in ElementTree.iterparse(part):
                if element.tag == f"{MAIN}si":
                    found.append(_rich_text(element))
                    element.clear()
        return found

    def _date_styles(self) -> set[int]:
        styles = ElementTree.fromstring(self.archive.read("xl/styles.xml"))
        custom = {
            int(f.get("numFmtId")) for f in styles.iter(f"{MAIN}numFmt") if _is_date_code(f.get("formatCode", ""))
        }
        cells = styles.find(f"{MAIN}cellXfs")
        formats = [] if cells is None else [int(x.get("numFmtId", 0)) for x in cells]
        return {i for i, f in enumerate(formats) if f in DATE_FORMATS or f in custom}

    def _cell_text(self, cell: ElementTree.Element) -> str | None:
        kind, text = cell.get("t", "n"), None
        for child in cell:
            if child.tag == VALUE:
                text = child.text
            elif child.tag == INLINE and kind == "inlineStr":
                return _rich_text(child) or None
        if not text or kind == "e":
            return None
        if kind == "s":
            return self.strings[int(text)] or None
        if kind == "n":
            if int(cell.get("s", 0)) not in self.date_styles:
                return _number_text(text)
            try:
                return _date_text(text, self.base)
            except OverflowError:
                return _number_text(text)  # no such date
        if kind == "b":
            return "True" if text.strip() in ("1", "true") else "False"
        if kind == "d":
            moment = datetime.fromisoformat(text)
            return moment.date().isoformat() if moment.time() == datetime.min.time() else moment.isoformat(" ")
        return text

    def _row_elements(self, sheet: str) -> Iterator[tuple[int, ElementTree.Element]]:
        """Rows one at a time; the content of a row is dropped once it has been used."""
        if sheet not in self.sheets:
            raise ValueError(f"no sheet named {sheet!r}")
        number = 0
        with self.archive.open(self.sheets[sheet]) as part:
            for _, element in ElementTree.iterparse(part):
                if element.tag == ROW:
                    number = int(element.get("r", number + 1))
                    yield number, element
                    element.clear()

    def rows(self, sheet: str) -> Iterator[tuple[int, list[str | None]]]:
        """``(row number, cells)`` of the rows present, without blank cells at the end."""
        for number, element in self._row_elements(sheet):
            cells: list[str | None] = []
            for cell in element:
                if cell.tag != CELL:
                    continue
                reference = cell.get("r")
                if reference:
                    gap = _column_index(reference) - len(cells)
                    if gap > 0:
                        cells.extend([None] * gap)
                cells.append(self._cell_text(cell))
            while cells and cells[-1] is None:
                cells.pop()
            yield number, cells

    def width(self, sheet: str, skip: int) -> int:
        """Columns used below the skipped rows. Looks at each row from its end, as far as needed."""
        width = 0
        for number, element in self._row_elements(sheet):
            if number <= skip:
                continue
            cells = [cell for cell in element if cell.tag == CELL]
            for place in range(len(cells) - 1, -1, -1):
                cell = cells[place]
                reference = cell.get("r")
                column = _column_index(reference) if reference else place
                if column < width:
                    break
                if self._cell_text(cell) is not None:
                    width = column + 1
                    break
        return width


def header_names(cells: list[str | None], width: int) -> list[str]:
    """Column names: blank ones are numbered by position, repeated ones get a counter. Names that
    differ only in case count as repeated, as Spark does not tell them apart."""
    names: list[str] = []
    taken: set[str] = set()
    for i in range(max(width, len(cells))):
        base = (cells[i] if i < len(cells) else None) or f"Unnamed: {i}"
        name, n = base, 0
        while name.lower() in taken:
            n += 1
            name = f"{base}.{n}"
        taken.add(name.lower())
        names.append(name)
    return names


def table_rows(content: bytes | Workbook, sheet: str, skip: int) -> Iterator[tuple[int, list[str | None]]]:
    """Header row, then data rows. Blank rows between data rows come out empty; those after the
    last do not come out."""
    next_row = skip + 1
    book = content if isinstance(content, Workbook) else Workbook(content)
    for number, cells in book.rows(sheet):
        if number <= skip or not any(c is not None for c in cells):
            continue
        while next_row < number:
            yield next_row, []
            next_row += 1
        yield number, cells
        next_row = number + 1


def sheet_header(content: bytes, sheet: str, skip: int) -> list[str]:
    """Names of all columns, as many as the widest row has."""
    book = Workbook(content)
    number, header = next(table_rows(book, sheet, skip), (0, []))
    return header_names(header if number == skip + 1 else [], book.width(sheet, skip))
