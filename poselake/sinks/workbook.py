"""Workbooks (.xlsx) without other packages: sheets of small tables, plain or with marked rows."""

from __future__ import annotations

import zipfile
from collections.abc import Callable, Mapping
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame

#: Rows of a sheet, its heading included.
MOST_ROWS = 1_048_576
#: Styles by name; the fills of the first three rows of a ranking, and of controls.
STYLES = {"plain": 0, "heading": 1, "top": 2, "reference": 3}
_NS = "http://schemas.openxmlformats.org"
_MAIN = f"{_NS}/spreadsheetml/2006/main"
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'


def write_workbook(path: str, sheets: Mapping[str, DataFrame], style: Callable[[dict], str] | None = None, most: int = MOST_ROWS - 1) -> None:
    """A file with one sheet for each table, in the order of its rows; the heading is frozen, columns are as wide as their texts (60 at most).

    ``style`` names the style of a row (see :func:`ranking_style`). Rows are streamed through the driver, a partition at a
    time; a table with more rows than ``most`` is an error, as a sheet can't hold it.
    """
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as book:
        for i, (name, df) in enumerate(sheets.items(), 1):
            body, widths = [], [len(c) for c in df.columns]
            for n, row in enumerate(df.limit(most + 1).toLocalIterator(), 2):
                if n - 1 > most:
                    raise ValueError(f"sheet {name!r} holds {most} rows at most")
                look = STYLES[style(row.asDict())] if style else 0
                widths = [max(w, len(_text(v))) for w, v in zip(widths, row)]
                body.append(_row(n, row, look))
            columns = "".join(f'<col min="{k}" max="{k}" width="{min(w, 58) + 2}" customWidth="1"/>' for k, w in enumerate(widths, 1))
            frozen = '<sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" activePane="bottomLeft" state="frozen"/></sheetView></sheetViews>'
            book.writestr(f"xl/worksheets/sheet{i}.xml", f'{_HEAD}<worksheet xmlns="{_MAIN}">{frozen}<cols>{columns}</cols><sheetData>{_row(1, df.columns, STYLES["heading"])}{"".join(body)}</sheetData></worksheet>')
        names = list(sheets)
        listed = "".join(f'<sheet name="{escape(n[:31], {chr(34): "&quot;"})}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(names, 1))
        book.writestr("xl/workbook.xml", f'{_HEAD}<workbook xmlns="{_MAIN}" xmlns:r="{_NS}/officeDocument/2006/relationships"><sheets>{listed}</sheets></workbook>')
        kinds = [(f"rId{i}", "worksheet", f"worksheets/sheet{i}.xml") for i in range(1, len(names) + 1)] + [("rIdS", "styles", "styles.xml")]
        book.writestr("xl/_rels/workbook.xml.rels", _relations(kinds))
        book.writestr("_rels/.rels", _relations([("rId1", "officeDocument", "xl/workbook.xml")]))
        fill = lambda rgb: f'<fill><patternFill patternType="solid"><fgColor rgb="FF{rgb}"/></patternFill></fill>'
        looks = "".join(f'<xf numFmtId="0" fontId="{font}" fillId="{at}" borderId="0"/>' for font, at in ((0, 0), (1, 0), (0, 2), (0, 3)))
        book.writestr("xl/styles.xml", f'{_HEAD}<styleSheet xmlns="{_MAIN}"><fonts count="2"><font/><font><b/></font></fonts><fills count="4"><fill><patternFill patternType="none"/></fill><fill><patternFill patternType="gray125"/></fill>{fill("C6EFCE")}{fill("FFEB9C")}</fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="4">{looks}</cellXfs></styleSheet>')
        types = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(1, len(names) + 1))
        types += "".join(f'<Override PartName="/xl/{p}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.{k}+xml"/>' for p, k in (("workbook", "sheet.main"), ("styles", "styles")))
        book.writestr("[Content_Types].xml", f'{_HEAD}<Types xmlns="{_NS}/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>{types}</Types>')


def ranking_style(rank: str = "rank", top: int = 10, reference: str = "is_reference") -> Callable[[dict], str]:
    """Controls are ``reference``, rows with a rank up to ``top`` are ``top``."""
    return lambda row: "reference" if row.get(reference) else "top" if row.get(rank) is not None and row[rank] <= top else "plain"


def read_workbook(path: str, sheet: int = 1) -> list[list[str | None]]:
    """Rows of one sheet (from 1) as texts, missing cells null."""
    from xml.etree import ElementTree

    with zipfile.ZipFile(path) as book:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = ["".join(t.text or "" for t in item.iter(f"{{{_MAIN}}}t")) for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))]
        rows = []
        for row in ElementTree.fromstring(book.read(f"xl/worksheets/sheet{sheet}.xml")).iter(f"{{{_MAIN}}}row"):
            cells: dict[int, str | None] = {}
            for cell in row.iter(f"{{{_MAIN}}}c"):
                value, inline = cell.find(f"{{{_MAIN}}}v"), cell.find(f"{{{_MAIN}}}is")
                text = "".join(t.text or "" for t in inline.iter(f"{{{_MAIN}}}t")) if inline is not None else value.text if value is not None else None
                cells[_column(cell.get("r", ""), len(cells))] = shared[int(text)] if cell.get("t") == "s" and text is not None else text
            rows.append([cells.get(i) for i in range(max(cells, default=-1) + 1)])
    return rows


def _column(reference: str, default: int) -> int:
    letters = "".join(c for c in reference if c.isalpha())
    n = 0
    for c in letters:
        n = n * 26 + ord(c.upper()) - 64
    return n - 1 if letters else default


def _letters(i: int) -> str:
    out = ""
    while i:
        i, rest = divmod(i - 1, 26)
        out = chr(65 + rest) + out
    return out


def _text(value: object) -> str:
    return "" if value is None else str(value)


def _row(n: int, values, look: int) -> str:
    cells = []
    for i, v in enumerate(values, 1):
        at = f'r="{_letters(i)}{n}" s="{look}"'
        if isinstance(v, bool) or v is None:
            cells.append(f"<c {at}/>" if v is None else f'<c {at} t="b"><v>{int(v)}</v></c>')
        elif isinstance(v, (int, float)) and v == v and abs(v) != float("inf"):
            cells.append(f"<c {at}><v>{v!r}</v></c>")
        else:
            text = "".join(c for c in _text(v) if c >= " " or c in "\t\n")[:32767]
            cells.append(f'<c {at} t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>')
    return f'<row r="{n}">{"".join(cells)}</row>'


def _relations(kinds) -> str:
    rows = "".join(f'<Relationship Id="{i}" Type="{_NS}/officeDocument/2006/relationships/{k}" Target="{t}"/>' for i, k, t in kinds)
    return f'{_HEAD}<Relationships xmlns="{_NS}/package/2006/relationships">{rows}</Relationships>'
