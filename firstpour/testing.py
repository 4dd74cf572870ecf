"""Builds small XLSX workbooks, as input for the sheet scan."""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape

# The fixed parts of a workbook file.
CONTENT_TYPES = (
    '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
    '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
    '<Default Extension="xml" ContentType="application/xml"/></Types>'
)
MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
STYLES = (
    f'<styleSheet xmlns="{MAIN}"><numFmts count="1"><numFmt numFmtId="164" formatCode="yyyy-mm-dd hh:mm"/>'
    '</numFmts><cellXfs count="3"><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/></cellXfs></styleSheet>'
)


def letters(index: int) -> str:
    name = ""
    index += 1
    while index:
        index, rest = divmod(index - 1, 26)
        name = chr(ord("A") + rest) + name
    return name


class Date(float):
    """A date serial shown with the built-in date format."""


class Moment(float):
    """A date serial shown with a custom date and time format."""


class Shared(str):
    """Text kept in the shared-string table."""


class Error(str):
    """An error value such as ``#DIV/0!``."""


def _cell(reference: str, value, strings: list[str]) -> str:
    if isinstance(value, bool):
        return f'<c r="{reference}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, Error):
        return f'<c r="{reference}" t="e"><v>{escape(value)}</v></c>'
    if isinstance(value, Shared):
        strings.append(value)
        return f'<c r="{reference}" t="s"><v>{len(strings) - 1}</v></c>'
    if isinstance(value, Date):
        return f'<c r="{reference}" s="1"><v>{float(value)!r}</v></c>'
    if isinstance(value, Moment):
        return f'<c r="{reference}" s="2"><v>{float(value)!r}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{reference}"><v>{value!r}</v></c>'
    return f'<c r="{reference}" t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>'


def workbook(sheets: dict[str, dict[int, list]]) -> bytes:
    """A workbook of sheets; each sheet maps a row number to its cells, ``None`` left out."""
    strings: list[str] = []
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for i, rows in enumerate(sheets.values(), 1):
            body = "".join(
                f'<row r="{number}">'
                + "".join(
                    _cell(f"{letters(j)}{number}", v, strings) for j, v in enumerate(cells) if v is not None
                )
                + "</row>"
                for number, cells in sorted(rows.items())
            )
            archive.writestr(
                f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="{MAIN}"><sheetData>{body}</sheetData></worksheet>'
            )
        names = "".join(
            f'<sheet name="{escape(n)}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1)
        )
        archive.writestr(
            "xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{REL}"><sheets>{names}</sheets></workbook>'
        )
        links = "".join(
            f'<Relationship Id="rId{i}" Type="{REL}/worksheet" Target="worksheets/sheet{i}.xml"/>'
            for i in range(1, len(sheets) + 1)
        )
        archive.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>',
        )
        items = "".join(f"<si><t>{escape(s)}</t></si>" for s in strings)
        archive.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}">{items}</sst>')
        archive.writestr("xl/styles.xml", STYLES)
        archive.writestr("[Content_Types].xml", CONTENT_TYPES)
    return out.getvalue()
