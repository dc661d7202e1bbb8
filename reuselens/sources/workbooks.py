"""Spreadsheet workbooks (xlsx): sheets as tables of text, and groups of rows as sheets.

A workbook is one zipped file, whose format holds at most 2^20 rows a sheet; a
task streams one file's sheets, and files are read side by side. Cells come as
text, as those of other text formats: numbers as they are written, days as
``yyyy-MM-dd`` (with the time where there is one), truth as True or False;
empty cells are null.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
import zipfile
from collections.abc import Iterator
from io import BytesIO
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows a sheet of the format holds at most, header included.
MOST_ROWS = 1 << 20
_ROWS = "path string, sheet_no int, sheet string, row long, cells array<string>"
# Numbers of the format's own day and time styles, and its name spaces.
_DAY_STYLES = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _text(element: ElementTree.Element) -> str:
    """The text of a string: its runs, without the readings beside them."""
    return "".join(t.text or "" for part in element if part.tag in (f"{_MAIN}t", f"{_MAIN}r") for t in ([part] if part.tag == f"{_MAIN}t" else part.iter(f"{_MAIN}t")))


def _day_styles(book: zipfile.ZipFile) -> list[bool]:
    """For each cell style whether it shows days or times."""
    if "xl/styles.xml" not in book.namelist():
        return []
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    own = {int(f.get("numFmtId")): re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", f.get("formatCode", "")) for f in root.iter(f"{_MAIN}numFmt")}
    cells = root.find(f"{_MAIN}cellXfs")
    kinds = [int(x.get("numFmtId", 0)) for x in cells] if cells is not None else []
    return [k in _DAY_STYLES if k not in own else bool(re.search("[ymdhs]", own[k].lower())) for k in kinds]


def _day(number: float, since_1904: bool) -> str:
    at = dt.datetime(1904, 1, 1) if since_1904 else dt.datetime(1899, 12, 30)
    found = at + dt.timedelta(seconds=round(number * 86_400))
    return str(found.date()) if found.time() == dt.time() else str(found)


def _place(reference: str) -> int:
    n = 0
    for c in reference:
        if not c.isalpha():
            break
        n = 26 * n + ord(c.upper()) - 64
    return n - 1


def sheets_of(content: bytes) -> Iterator[tuple[int, str, Iterator[tuple[int, list[str | None]]]]]:
    """``(number, name, rows)`` of a workbook; rows are their place in the sheet, from 0, and their cells, read as they are asked for."""
    book = zipfile.ZipFile(BytesIO(content))
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    strings = [_text(s) for s in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in book.namelist() else []
    days = _day_styles(book)
    since_1904 = any(p.get("date1904") in ("1", "true") for p in root.iter(f"{_MAIN}workbookPr"))

    def value(cell: ElementTree.Element) -> str | None:
        kind, held = cell.get("t", "n"), cell.find(f"{_MAIN}v")
        if kind == "inlineStr":
            inner = cell.find(f"{_MAIN}is")
            return _text(inner) if inner is not None else None
        if held is None or held.text is None:
            return None
        if kind == "s":
            return strings[int(held.text)]
        if kind == "b":
            return "True" if held.text == "1" else "False"
        style = int(cell.get("s", 0))
        return _day(float(held.text), since_1904) if kind == "n" and style < len(days) and days[style] else held.text

    def rows(name: str) -> Iterator[tuple[int, list[str | None]]]:
        at = -1
        with book.open(name) as stream:
            for _, row in ElementTree.iterparse(stream):
                if row.tag != f"{_MAIN}row":
                    continue
                at = int(row.get("r", at + 2)) - 1
                cells: list[str | None] = []
                for cell in row.iter(f"{_MAIN}c"):
                    place = _place(cell.get("r", "")) if cell.get("r") else len(cells)
                    cells += [None] * (place + 1 - len(cells))
                    cells[place] = value(cell) or None
                row.clear()
                if any(c is not None for c in cells):
                    yield at, cells

    for k, sheet in enumerate(root.iter(f"{_MAIN}sheet")):
        target = targets[sheet.get(_LINK)]
        yield k, sheet.get("name"), rows(target.lstrip("/") if target.startswith("/") else f"xl/{target}")


def workbook_rows(spark: SparkSession, path: str) -> DataFrame:
    """``(path, sheet_no, sheet, row, cells)``: all rows with a cell of all sheets of all workbooks at ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["path", "sheet_no", "sheet", "row", "cells"]
        kinds = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.list_(pa.string())]
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held: list[tuple] = []
                for number, sheet, rows in sheets_of(content):
                    for at, cells in rows:
                        held.append((name, number, sheet, at, cells))
                        if len(held) >= 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
                            held = []
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, _ROWS)


def read_sheet(spark: SparkSession, path: str, sheet: str | int | None = None) -> DataFrame:
    """One sheet of a workbook as a table of trimmed text, by name or number; the first with two rows or more where none is named.

    The first row is the header; columns without a name fall out, and a name
    that comes again gets its place.
    """
    rows = workbook_rows(spark, path)
    firsts = rows.groupBy("sheet_no", "sheet").agg(F.count("*").alias("n"), F.min_by("cells", "row").alias("head"), F.min("row").alias("at")).orderBy("sheet_no").collect()  # a row a sheet
    if sheet is None:
        found = [f for f in firsts if f["n"] >= 2]
    else:
        found = [f for f in firsts if f["sheet" if isinstance(sheet, str) else "sheet_no"] == sheet]
    if not found:
        raise ValueError("no such sheet" if sheet is not None else "no sheet with rows")
    first, columns, used = found[0], [], set()
    for k, name in enumerate(first["head"]):
        name = (name or "").strip()
        if name:
            name = f"{name}_{k}" if name in used else name
            used.add(name)
            columns.append(F.trim(F.get("cells", F.lit(k))).alias(name))
    return rows.where((F.col("sheet_no") == first["sheet_no"]) & (F.col("row") > first["at"])).select(*columns)


def sheet_urls(spark: SparkSession, path: str, column: str) -> DataFrame:
    """``(sheet, url)``: cells that begin with ``http`` in the column of this name, of every sheet that has it in its first row."""
    rows = workbook_rows(spark, path)
    own = Window.partitionBy("path", "sheet_no")  # the format bounds a sheet
    head = F.min_by("cells", "row").over(own)
    place = F.array_position(F.col("head"), column).cast("int")
    placed = rows.withColumns({"head": head, "first": F.min("row").over(own)}).where("row > first").select("sheet", F.trim(F.get("cells", place - 1)).alias("url"), place.alias("p"))
    return placed.where("p > 0").where(F.startswith("url", F.lit("http"))).select("sheet", "url")


_TYPES = '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>{}</Types>'
_SHEET_TYPE = '<Override PartName="/xl/worksheets/sheet{}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
_RELATIONS = '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{}</Relationships>'
_RELATION = '<Relationship Id="{}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/{}" Target="{}"/>'
_BOOK = '<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>{}</sheets></workbook>'
_STYLES = '<?xml version="1.0" encoding="UTF-8"?><styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><fonts count="1"><font/></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="3"><xf numFmtId="0"/><xf numFmtId="14" applyNumberFormat="1"/><xf numFmtId="22" applyNumberFormat="1"/></cellXfs></styleSheet>'


def _cell(v: object) -> str:
    if v is None:
        return "<c/>"
    if isinstance(v, bool):
        return f'<c t="b"><v>{int(v)}</v></c>'
    if isinstance(v, dt.datetime):
        return f'<c s="2"><v>{(v - dt.datetime(1899, 12, 30)) / dt.timedelta(days=1)!r}</v></c>'
    if isinstance(v, dt.date):
        return f'<c s="1"><v>{(v - dt.date(1899, 12, 30)).days}</v></c>'
    if isinstance(v, (int, float)) and v == v and abs(v) != float("inf"):
        return f"<c><v>{v!r}</v></c>"
    clean = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]", "", str(v))
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(clean)}</t></is></c>'


class _Sink:
    """Bytes on their way to a file of the shared file system, a megabyte at a time."""

    def __init__(self, stream) -> None:
        self.stream, self.held = stream, bytearray()

    def write(self, data: bytes) -> int:
        self.held += data
        if len(self.held) >= 1 << 20:
            self.flush()
        return len(data)

    def flush(self) -> None:
        if self.held:
            self.stream.write(self.held)
            self.held = bytearray()

    def close(self) -> None:
        self.flush()
        self.stream.close()


def write_workbook(df: DataFrame, path: str, group: str, order: list[str]) -> None:
    """One sheet for each value of ``group``, in order of it, with the other columns in ``order`` of rows; the file appears whole or not at all.

    The format bounds what is written: a group of more than ``MOST_ROWS`` less
    one rows is refused. Rows stream through the driver one partition at a
    time into the zipped file. Characters the format can't hold are left out;
    sheets are named by their value, cut at 31 characters.
    """
    spark, columns = df.sparkSession, [c for c in df.columns if c != group]
    sizes = df.groupBy(group).agg(F.count("*").alias("n")).orderBy(group).limit(1001).collect()
    if any(r["n"] >= MOST_ROWS for r in sizes) or len(sizes) > 1000:
        raise ValueError("more rows or sheets than a workbook holds")
    names: list[str] = []
    for r in sizes:
        name = re.sub(r"[\[\]:*?/\\]", "_", str("" if r[0] is None else r[0]))[:31] or "-"
        names.append(name if name not in names else f"{name[:26]}_{len(names)}")
    api = spark._jvm.org.apache.hadoop.fs
    final = api.Path(path)
    draft = api.Path(final.getParent(), f".{uuid.uuid4().hex}")
    fs = final.getFileSystem(spark._jsc.hadoopConfiguration())
    sink = _Sink(fs.create(draft, False))
    try:
        with zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as book:
            for k, r in enumerate(sizes, 1):
                rows = df.where(F.col(group).eqNullSafe(F.lit(r[0]))).orderBy(*order).select(*columns)
                with book.open(f"xl/worksheets/sheet{k}.xml", "w", force_zip64=True) as out:
                    out.write(b'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>')
                    out.write(f"<row>{''.join(map(_cell, columns))}</row>".encode())
                    for row in rows.toLocalIterator():
                        out.write(f"<row>{''.join(map(_cell, row))}</row>".encode())
                    out.write(b"</sheetData></worksheet>")
            quoted = [escape(n, {'"': "&quot;"}) for n in names]
            book.writestr("[Content_Types].xml", _TYPES.format("".join(_SHEET_TYPE.format(k) for k in range(1, len(names) + 1))))
            book.writestr("_rels/.rels", _RELATIONS.format(_RELATION.format("rId1", "officeDocument", "xl/workbook.xml")))
            book.writestr("xl/workbook.xml", _BOOK.format("".join(f'<sheet name="{n}" sheetId="{k}" r:id="rId{k}"/>' for k, n in enumerate(quoted, 1))))
            links = [_RELATION.format(f"rId{k}", "worksheet", f"worksheets/sheet{k}.xml") for k in range(1, len(names) + 1)]
            book.writestr("xl/_rels/workbook.xml.rels", _RELATIONS.format("".join([*links, _RELATION.format("rIdS", "styles", "styles.xml")])))
            book.writestr("xl/styles.xml", _STYLES)
        sink.close()
        fs.delete(final, False)
        if not fs.rename(draft, final):
            raise OSError(f"{path} could not be written")
    finally:
        fs.delete(draft, False)
