"""A small writer of xlsx workbooks: texts, numbers and days, for exports to other programs and for tests."""

from __future__ import annotations

import io
import zipfile
from datetime import datetime
from xml.sax.saxutils import escape, quoteattr

_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_KIND = "application/vnd.openxmlformats-officedocument.spreadsheetml"


def _letters(i: int) -> str:
    out = ""
    while i >= 0:
        i, out = i // 26 - 1, chr(65 + i % 26) + out
    return out


def workbook(sheets: dict[str, list], time_column: str = "Timestamp", shared: bool = True) -> bytes:
    """The bytes of a workbook. Rows are lists of texts, numbers, times and nulls; numbers below a cell with ``time_column`` are times.

    Texts are kept once in a shared table, or with ``shared`` off in their cells.
    """
    texts: dict[str, int] = {}

    def cell(ref: str, v, timed: bool) -> str:
        if isinstance(v, datetime):
            v, timed = (v - datetime(1899, 12, 30)).total_seconds() / 86400, True
        if v is None or v == "":
            return ""
        if isinstance(v, (int, float)):
            return f'<c r="{ref}"{" s=" + quoteattr("1") if timed else ""}><v>{v!r}</v></c>'
        if not shared:
            return f'<c r="{ref}" t="inlineStr"><is><t>{escape(v)}</t></is></c>'
        return f'<c r="{ref}" t="s"><v>{texts.setdefault(v, len(texts))}</v></c>'

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for n, rows in enumerate(sheets.values(), 1):
            times: set[int] = set()
            with z.open(f"xl/worksheets/sheet{n}.xml", "w") as f:
                f.write(f'<worksheet xmlns="{_MAIN}"><sheetData>'.encode())
                for i, row in enumerate(rows, 1):
                    f.write(f'<row r="{i}">{"".join(cell(f"{_letters(j)}{i}", v, j in times) for j, v in enumerate(row))}</row>'.encode())
                    times |= {j for j, v in enumerate(row) if v == time_column}
                f.write(b"</sheetData></worksheet>")
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{_MAIN}">{"".join(f"<si><t>{escape(t)}</t></si>" for t in texts)}</sst>')
        z.writestr("xl/styles.xml", f'<styleSheet xmlns="{_MAIN}"><fonts count="1"><font/></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="22" applyNumberFormat="1"/></cellXfs></styleSheet>')
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN}" xmlns:r="{_OFFICE}"><sheets>{"".join(f"<sheet name={quoteattr(s)} sheetId={quoteattr(str(n))} r:id={quoteattr(f"r{n}")}/>" for n, s in enumerate(sheets, 1))}</sheets></workbook>')
        parts = [*[(f"r{n}", "worksheet", f"worksheets/sheet{n}.xml") for n in range(1, len(sheets) + 1)], ("s", "styles", "styles.xml"), ("t", "sharedStrings", "sharedStrings.xml")]
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_PACKAGE}/relationships">{"".join(f"<Relationship Id={quoteattr(i)} Type={quoteattr(f"{_OFFICE}/{k}")} Target={quoteattr(t)}/>" for i, k, t in parts)}</Relationships>')
        z.writestr("_rels/.rels", f'<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="r" Type="{_OFFICE}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        kinds = [("xl/workbook.xml", "sheet.main"), ("xl/styles.xml", "styles"), ("xl/sharedStrings.xml", "sharedStrings"), *[(f"xl/worksheets/sheet{n}.xml", "worksheet") for n in range(1, len(sheets) + 1)]]
        z.writestr("[Content_Types].xml", f'<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>{"".join(f"<Override PartName={quoteattr("/" + p)} ContentType={quoteattr(f"{_KIND}.{k}+xml")}/>" for p, k in kinds)}</Types>')
    return out.getvalue()
