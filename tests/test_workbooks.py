"""Workbooks written and read back, and ones made by hand as other programs make them."""

import datetime as dt
import zipfile

import pytest
from pyspark.sql import functions as F

from reuselens.sources import workbooks as B
from reuselens.sources.tables import read_table, read_upload

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def _made(path, sheets, strings=(), styles="", book=""):
    """A workbook with shared strings, from the sheets' own text."""
    with zipfile.ZipFile(path, "w") as z:
        names = "".join(f'<sheet name="{n}" sheetId="{k}" r:id="r{k}"/>' for k, (n, _) in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'<workbook {MAIN} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">{book}<sheets>{names}</sheets></workbook>')
        links = "".join(f'<Relationship Id="r{k}" Type="t" Target="/xl/worksheets/s{k}.xml"/>' for k in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>')
        for k, (_, rows) in enumerate(sheets, 1):
            z.writestr(f"xl/worksheets/s{k}.xml", f"<worksheet {MAIN}><sheetData>{rows}</sheetData></worksheet>")
        if strings:
            z.writestr("xl/sharedStrings.xml", f"<sst {MAIN}>{''.join(strings)}</sst>")
        if styles:
            z.writestr("xl/styles.xml", f"<styleSheet {MAIN}>{styles}</styleSheet>")


def test_sheets_as_others_make_them(spark, tmp_path):
    strings = ["<si><t>name</t></si>", "<si><r><t>two</t></r><r><t xml:space='preserve'> runs</t></r><rPh><t>reading</t></rPh></si>", "<si><t>day</t></si>"]
    styles = '<numFmts><numFmt numFmtId="170" formatCode="yyyy&quot;年&quot;m"/><numFmt numFmtId="171" formatCode="0.0&quot;d&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs>'
    first = '<row r="1"><c r="A1" t="s"><v>0</v></c></row>'
    second = (
        '<row r="2"><c r="B2" t="s"><v>0</v></c><c r="D2" t="s"><v>2</v></c><c r="E2" t="s"><v>0</v></c></row>'
        '<row r="4"><c r="B4" t="s"><v>1</v></c><c r="D4" s="1"><v>46000</v></c><c r="E4" s="3"><v>1.5</v></c></row>'
        '<row r="5"><c r="D5" s="2"><v>46000.25</v></c></row><row r="6"><c r="B6" s="1"/></row>'
        '<row r="7"><c r="B7" t="b"><v>1</v></c><c r="D7" t="str"><f>A1</f><v> x </v></c><c r="AB7"><v>9</v></c></row>'
    )
    path = tmp_path / "a.xlsx"
    _made(path, [("cover", first), ("data", second)], strings, styles)
    found = read_table(spark, f"file://{path}")
    assert found.columns == ["name", "day", "name_4"]
    assert [tuple(r) for r in found.collect()] == [("two runs", "2025-12-09", "1.5"), (None, "2025-12-09 06:00:00", None), ("True", "x", None)]
    assert read_upload(spark, f"file://{path}").columns == found.columns
    assert B.read_sheet(spark, f"file://{path}", "cover").count() == 0 and B.read_sheet(spark, f"file://{path}", 1).count() == 3
    with pytest.raises(ValueError):
        B.read_sheet(spark, f"file://{path}", "no such")
    with pytest.raises(ValueError):
        _made(tmp_path / "b.xlsx", [("only", first)], strings)
        B.read_sheet(spark, f"file://{tmp_path}/b.xlsx")
    (tmp_path / "c.xlsx").write_bytes(b"no workbook")
    with pytest.raises(Exception):
        B.read_sheet(spark, f"file://{tmp_path}/c.xlsx")


def test_days_since_1904(spark, tmp_path):
    _made(tmp_path / "a.xlsx", [("s", '<row><c t="inlineStr"><is><t>d</t></is></c></row><row><c s="1"><v>0</v></c></row>')], (), '<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs>', '<workbookPr date1904="1"/>')
    assert [r.d for r in B.read_sheet(spark, f"file://{tmp_path}/a.xlsx").collect()] == ["1904-01-01"]


def test_urls_of_every_sheet_with_the_column(spark, tmp_path):
    cell = lambda *v: "<row>" + "".join("<c/>" if x is None else f'<c t="inlineStr"><is><t>{x}</t></is></c>' for x in v) + "</row>"
    sheets = [("a", cell("n", "url") + cell("1", " http://x/1") + cell("2", None) + cell("3", "ftp://x")), ("b", cell("n") + cell("http://no")), ("c", cell("url") + cell("https://x/2"))]
    _made(tmp_path / "u.xlsx", sheets)
    assert sorted(map(tuple, B.sheet_urls(spark, f"file://{tmp_path}/u.xlsx", "url").collect())) == [("a", "http://x/1"), ("c", "https://x/2")]


def test_round_trip(spark, tmp_path):
    rows = [
        ("大盘抽样", 1, "a <&> \"b\" 'c'", 0.1, dt.date(2026, 3, 1), dt.datetime(2026, 3, 1, 10, 30), True), ("大盘抽样", 2, " two  spaces\x07 ", -5.0, None, None, False),
        ("x/y", 3, None, None, dt.date(1950, 1, 1), dt.datetime(2000, 1, 1), None), (None, 4, "", 1e300, None, None, True),
    ]
    df = spark.createDataFrame(rows, "g string, id long, t string, x double, d date, ts timestamp, b boolean")
    path = f"file://{tmp_path}/out.xlsx"
    B.write_workbook(df, path, "g", ["id"])
    B.write_workbook(df, path, "g", ["id"])  # replaces the file
    sheets = {r.sheet for r in B.workbook_rows(spark, path).collect()}
    assert sheets == {"-", "大盘抽样", "x_y"}
    first = [tuple(r) for r in B.read_sheet(spark, path, "大盘抽样").collect()]
    assert first == [("1", "a <&> \"b\" 'c'", "0.1", "2026-03-01", "2026-03-01 10:30:00", "True"), ("2", "two  spaces", "-5.0", None, None, "False")]
    assert [tuple(r) for r in B.read_sheet(spark, path, "x_y").collect()] == [("3", None, None, "1950-01-01", "2000-01-01", None)]
    assert [tuple(r) for r in B.read_sheet(spark, path).select("id", "x", "b").collect()] == [("4", "1e+300", "True")]
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["out.xlsx"]


def test_too_long_for_a_sheet(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(B, "MOST_ROWS", 10)
    df = spark.range(12).select(F.lit("g").alias("g"), "id")
    with pytest.raises(ValueError):
        B.write_workbook(df, f"file://{tmp_path}/x.xlsx", "g", ["id"])
    assert not list(tmp_path.iterdir())
    big = spark.range(5000).select(F.lit("g").alias("g"), "id")
    monkeypatch.undo()
    B.write_workbook(big, f"file://{tmp_path}/x.xlsx", "g", ["id"])
    assert [int(r.id) for r in B.read_sheet(spark, f"file://{tmp_path}/x.xlsx").collect()] == list(range(5000))
