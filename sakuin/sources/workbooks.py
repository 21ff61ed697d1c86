"""Workbooks and archives of workbooks as rows of sparse cells."""

from __future__ import annotations

import io
import posixpath
import zipfile
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sakuin.functions.links import path_of

DOCUMENT_BYTES = 100 << 20
ENTRY_BYTES = 60 << 20
XML_BYTES = 512 << 20
BOOKS = "document_url string, sha256 string, workbook string, content binary"
ROWS = "document_url string, workbook string, sheet string, row_number int, cells map<int,string>"
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def within(files: DataFrame, size: Column, name: str, limit: int = DOCUMENT_BYTES) -> DataFrame:
    """Files of a known size; one beyond the limit is an error that names it."""
    error = F.raise_error(F.concat(F.coalesce(name, F.lit("a file")), F.lit(f" is larger than {limit} bytes")))
    return files.where(F.when(size > limit, error.cast("boolean")).otherwise(size.isNotNull()))


def documents(files: DataFrame, limit: int = DOCUMENT_BYTES) -> DataFrame:
    """(document_url, content, sha256) of binary files (path, length, content); one beyond the limit is an error."""
    return within(files, F.col("length"), "path", limit).select(F.col("path").alias("document_url"), "content", F.sha2("content", 256).alias("sha256"))


def _checked(info: zipfile.ZipInfo, limit: int) -> None:
    if info.file_size > limit:
        raise ValueError(f"{info.filename} is larger than {limit} bytes")


def _books(name: str, content: bytes):
    if name.lower().endswith((".xlsx", ".xlsm")):
        yield name, content
        return
    if not name.lower().endswith(".zip"):
        raise ValueError(f"unsupported format: {name}")
    with io.BytesIO(content) as source:
        for book, inner in entries(name, source):
            yield book, entry(source, inner)


def _archive(source) -> zipfile.ZipFile:
    """Names without the UTF-8 flag are Shift_JIS."""
    return zipfile.ZipFile(source, metadata_encoding="shift_jis")


def entries(name: str, source) -> list[tuple[str, str]]:
    """(file name, entry) of the workbooks in an archive, from its directory alone. An unsafe, old or oversized entry is an error, and so
    is an archive without workbooks."""
    found = []
    for info in _archive(source).infolist():
        inner = info.filename.replace("\\", "/")
        if info.is_dir() or inner.startswith("__MACOSX/"):
            continue
        if inner.startswith("/") or ".." in inner.split("/"):
            raise ValueError(f"unsafe name in {name}: {inner}")
        if inner.lower().endswith(".xls"):
            raise ValueError(f"unsupported format in {name}: {inner}")
        if inner.lower().endswith((".xlsx", ".xlsm")):
            _checked(info, ENTRY_BYTES)
            found.append((posixpath.basename(inner), info.filename))
    if not found:
        raise ValueError(f"no workbook in {name}")
    return found


def entry(source, inner: str) -> bytes:
    return _archive(source).read(inner)


def workbooks(docs: DataFrame) -> DataFrame:
    """One row per workbook of (document_url, content, sha256): the document itself or each entry of an archive, one at a time."""
    kinds = [pa.string(), pa.string(), pa.string(), pa.binary()]

    def expand(batches):
        for batch in batches:
            for url, sha, name, content in zip(*batch.columns, strict=True):
                for book, data in _books(name.as_py(), content.as_py()):
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((url.as_py(), sha.as_py(), book, data), kinds, strict=True)], names=["document_url", "sha256", "workbook", "content"])

    name = F.try_url_decode(F.element_at(F.split(F.when(F.col("document_url").contains("://"), path_of(F.col("document_url"))).otherwise(F.col("document_url")), "/"), -1))
    return docs.select("document_url", "sha256", name.alias("name"), "content").mapInArrow(expand, BOOKS)


def column_number(reference: str) -> int:
    number = 0
    for c in reference:
        if not c.isalpha():
            break
        number = number * 26 + ord(c.upper()) - 64
    return number


class Book:
    """A workbook of which only the parts that are asked for are read. source: a binary file that can seek."""

    def __init__(self, source):
        self._zip = zipfile.ZipFile(source)
        names = set(self._zip.namelist())
        if "xl/workbook.xml" not in names or "xl/_rels/workbook.xml.rels" not in names:
            raise ValueError("not a workbook: its parts are missing")
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.parse(self._part("xl/_rels/workbook.xml.rels")).getroot()}
        self._parts, self._shared = {}, None
        for sheet in ElementTree.parse(self._part("xl/workbook.xml")).getroot().iter(f"{_MAIN}sheet"):
            target = targets.get(sheet.get(_REL))
            path = posixpath.normpath(target.lstrip("/") if target and target.startswith("/") else f"xl/{target}")
            if target is None or path not in names:
                raise ValueError(f"sheet {sheet.get('name')} is missing")
            self._parts[sheet.get("name")] = path
        self._has_shared = "xl/sharedStrings.xml" in names

    def sheets(self) -> list[str]:
        """Names of the sheets in the workbook's order."""
        return list(self._parts)

    def _part(self, name: str):
        info = self._zip.getinfo(name)
        _checked(info, XML_BYTES)
        return self._zip.open(info)

    def _strings(self) -> list[str]:
        if self._shared is None:
            self._shared = []
            for item in _elements(self._part("xl/sharedStrings.xml"), f"{_MAIN}si") if self._has_shared else ():
                self._shared.append("".join(t.text or "" for t in item.iter(f"{_MAIN}t")))
        return self._shared

    def rows(self, sheet: str, columns: frozenset[int] | None = None, last: int | None = None):
        """(row number, {column: text}) of a sheet, without empty cells and rows, as they are read: only columns of a choice, up to a row."""
        number = 0
        for row in _elements(self._part(self._parts[sheet]), f"{_MAIN}row"):
            number = int(row.get("r") or number + 1)
            if last is not None and number > last:
                return
            cells, column = {}, 0
            for cell in row.iter(f"{_MAIN}c"):
                column = column_number(cell.get("r") or "") or column + 1
                if columns is not None and column not in columns:
                    continue
                kind, value = cell.get("t"), cell.find(f"{_MAIN}v")
                text = "".join(t.text or "" for t in cell.iter(f"{_MAIN}t")) if kind == "inlineStr" else (value.text or "" if value is not None else "")
                if kind == "s" and text:
                    text = self._strings()[int(text)] if int(text) < len(self._strings()) else ""
                elif kind == "b":
                    text = "TRUE" if text == "1" else "FALSE"
                if text:
                    cells[column] = text
            if cells:
                yield number, cells


def _elements(stream, tag: str):
    """Elements of a tag one by one; what has been seen leaves memory."""
    path = []
    for event, element in ElementTree.iterparse(stream, ("start", "end")):
        if event == "start":
            path.append(element)
            continue
        path.pop()
        if element.tag == tag:
            yield element
            if path:
                path[-1].remove(element)


BATCH_BYTES = 4 << 20  # of text in a batch of rows
_CELLS = pa.map_(pa.int32(), pa.string())


def batches(found, limit: int = BATCH_BYTES):
    """Record batches of (document_url, workbook, sheet, row number, cells), each of about so many bytes of text at most."""
    held, size = [], 0
    for row in found:
        held.append(row)
        size += 64 + sum(len(v) * 3 + 8 for v in row[4].values())
        if size >= limit:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _batch(held: list) -> pa.RecordBatch:
    urls, books, sheets, numbers, cells = zip(*held, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(urls, pa.string()), pa.array(books, pa.string()), pa.array(sheets, pa.string()), pa.array(numbers, pa.int32()), pa.array([list(c.items()) for c in cells], _CELLS)], names=["document_url", "workbook", "sheet", "row_number", "cells"])


def worksheet_rows(books: DataFrame, columns: list[int] | None = None) -> DataFrame:
    """Sparse rows of all sheets; empty cells and rows are left out. A worker holds some workbooks' bytes (Spark's batch of 64 MiB, or one
    workbook if that is larger), one's shared strings and one batch of rows."""
    wanted = None if columns is None else frozenset(columns)

    def read(frames):
        for frame in frames:
            for url, name, content in zip(*frame.columns, strict=True):
                book = Book(io.BytesIO(content.as_py()))
                yield from batches((url.as_py(), name.as_py(), sheet, n, c) for sheet in book.sheets() for n, c in book.rows(sheet, wanted))

    return books.select("document_url", "workbook", "content").mapInArrow(read, ROWS)
