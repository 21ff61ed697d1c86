"""Worksheets as a data source, and the memory that reading them takes."""

import io
import tracemalloc
import zipfile

import pytest
from pyspark.sql import functions as F

from sakuin.sources import sheet_source, workbooks

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def book(sheets: dict[str, list[tuple[int, dict[int, str]]]], shared: list[str] = ()) -> bytes:
    """Cells are inline; a number n stands for shared string n."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        names = list(sheets)
        z.writestr("xl/workbook.xml", f'<workbook {MAIN} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>' + "".join(f'<sheet name="{n}" sheetId="{k}" r:id="r{k}"/>' for k, n in enumerate(names)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="r{k}" Target="worksheets/{k}.xml"/>' for k in range(len(names))) + "</Relationships>")
        if shared:
            z.writestr("xl/sharedStrings.xml", f"<sst {MAIN}>" + "".join(f"<si><t>{s}</t></si>" for s in shared) + "</sst>")
        for k, n in enumerate(names):
            cell = lambda r, c, v: f'<c r="{chr(64 + c)}{r}" t="s"><v>{v}</v></c>' if isinstance(v, int) else f'<c r="{chr(64 + c)}{r}" t="inlineStr"><is><t>{v}</t></is></c>'
            with z.open(f"xl/worksheets/{k}.xml", "w") as part:
                part.write(f"<worksheet {MAIN}><sheetData>".encode())
                for r, cells in sheets[n]:
                    part.write((f'<row r="{r}">' + "".join(cell(r, c, v) for c, v in cells.items()) + "</row>").encode())
                part.write(b"</sheetData></worksheet>")
    return out.getvalue()


def archive(files: dict[bytes, bytes]) -> bytes:
    """An archive whose names are bytes without the UTF-8 flag."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for k, data in enumerate(files.values()):
            z.writestr(f"{k:04d}.xlsx", data)
    raw = out.getvalue()
    for k, name in enumerate(files):
        old = f"{k:04d}.xlsx".encode()
        assert len(name) == len(old)
        raw = raw.replace(old, name)
    return raw


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    two = book({"医科": [(1, {1: "a", 3: 0}), (60, {2: "b", 3: 1})], "歯科": [(2, {1: "c"})]}, ["共", "有"])
    one = book({"薬局": [(5, {27 - 26: "d"})]})
    inner = archive({"四.xlsx".encode("shift_jis").rjust(9, b"x"): two, "表.xlsx".encode("shift_jis").rjust(9, b"y"): one})
    rows = [("https://x/a%20b.xlsx?v=1".replace("?v=1", ""), bytearray(two)), ("https://x/l.zip", bytearray(inner)), ("plain.xlsm", bytearray(one))]
    path = f"{tmp_path_factory.mktemp('sheets')}/files"
    sheet_source.write_files(spark.createDataFrame(rows, "document_url string, content binary"), path)
    return path


def test_sheets_of_files_and_archives(spark, folder):
    got = {(r["document_url"], r["workbook"], r["sheet"], r["row_number"], tuple(sorted(r["cells"].items()))) for r in sheet_source.read_sheets(spark, folder).collect()}
    two = [("医科", 1, ((1, "a"), (3, "共"))), ("医科", 60, ((2, "b"), (3, "有"))), ("歯科", 2, ((1, "c"),))]
    want = {("https://x/a%20b.xlsx", "a b.xlsx", *r) for r in two} | {("https://x/l.zip", "xx四.xlsx", *r) for r in two}
    want |= {("https://x/l.zip", "yy表.xlsx", "薬局", 5, ((1, "d"),)), ("plain.xlsm", "plain.xlsm", "薬局", 5, ((1, "d"),))}
    assert got == want
    as_table = spark.createDataFrame([(u, bytearray(c), "s") for u, c in [("plain.xlsm", book({"薬局": [(5, {1: "d"})]}))]], "document_url string, content binary, sha256 string")
    assert [tuple(r) for r in workbooks.worksheet_rows(workbooks.workbooks(as_table)).collect()] == [("plain.xlsm", "plain.xlsm", "薬局", 5, {1: "d"})]


def test_what_is_not_asked_for_is_not_opened(spark, folder):
    def planned(*filters, **options):
        reader = sheet_source.SheetReader({"path": folder, **options})
        left = list(reader.pushFilters(list(filters)))
        return reader, left, reader.partitions()

    eq, le = sheet_source.EqualTo, sheet_source.LessThanOrEqual
    assert len(planned()[2]) == 5  # two sheets, two workbooks of an archive, one sheet
    reader, left, parts = planned(eq(("sheet",), "歯科"), le(("row_number",), 50))
    assert not left and sorted((p.workbook, p.sheet) for p in parts) == [("a b.xlsx", "歯科"), ("xx四.xlsx", None), ("yy表.xlsx", None)]
    assert [len(b) for p in parts for b in reader.read(p)] == [1, 1]
    assert [p.document_url for p in planned(eq(("document_url",), "plain.xlsm"))[2]] == ["plain.xlsm"]
    assert not planned(eq(("workbook",), "none"))[2]
    rows = sheet_source.read_sheets(spark, folder, [1, 3]).where("sheet = '医科' and row_number < 60")
    assert {tuple(sorted(r["cells"].items())) for r in rows.collect()} == {((1, "a"), (3, "共"))}
    assert "PushedFilters" in rows._jdf.queryExecution().toString() or rows.count() == 2
    exact = sheet_source.read_sheets(spark, folder).where("row_number = 60")
    assert exact.count() == 2
    assert sheet_source.read_sheets(spark, folder, [2]).where(F.size("cells") > 0).count() == 2


def test_bad_files_are_errors(spark, tmp_path, monkeypatch):
    for k, (name, data) in enumerate({"old.xls": b"x", "empty.zip": archive({}), "broken.xlsx": archive({})}.items()):
        place = tmp_path / str(k)
        place.mkdir()
        (place / name).write_bytes(data)
        with pytest.raises(ValueError):
            sheet_source.SheetReader({"path": str(place)}).partitions()
    monkeypatch.setattr(workbooks, "XML_BYTES", 50)
    (tmp_path / "b.xlsx").write_bytes(book({"s": [(1, {1: "x" * 100})]}))
    with pytest.raises(ValueError, match="larger"):
        workbooks.Book(io.BytesIO((tmp_path / "b.xlsx").read_bytes()))


def test_memory_of_a_large_sheet_and_of_many_books():
    """A sheet of 60 MB of XML is read within 24 MB, batch by batch."""
    text = "施設基準" * 20
    data = book({"大": [(r, {c: f"{text}{r}" for c in (1, 2, 3)}) for r in range(1, 73_000)]})
    assert zipfile.ZipFile(io.BytesIO(data)).getinfo("xl/worksheets/0.xml").file_size > 60_000_000
    tracemalloc.start()
    source = workbooks.Book(io.BytesIO(data))
    rows, most = 0, 0
    for batch in workbooks.batches(("u", "w", "大", n, c) for n, c in source.rows("大")):
        rows, most = rows + batch.num_rows, max(most, batch.nbytes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 72_999 and most <= 1.3 * workbooks.BATCH_BYTES
    assert peak < 24_000_000


def test_many_books_in_one_archive_and_one_table(spark, tmp_path):
    small = book({"s": [(1, {1: "v"})]})
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for k in range(1000):
            z.writestr(f"{k}.xlsx", small)
    table = spark.createDataFrame([("https://x/l.zip", bytearray(out.getvalue()), "s")], "document_url string, content binary, sha256 string")
    assert workbooks.worksheet_rows(workbooks.workbooks(table)).select("workbook").distinct().count() == 1000
