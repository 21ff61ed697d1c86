"""Worksheets as a Spark data source over a folder of workbooks and archives.

    spark.read.format("sakuin_sheets").option("columns", "1,3").load(folder).where("sheet = '一覧' and row_number <= 50")

A partition is one sheet of a workbook file, or one workbook of an archive, for the OPENED largest files, of which planning reads
directories and sheet lists; other files are only listed and dealt to partitions bounded in bytes and number, whose tasks open them. Predicates on document, workbook, sheet and row number are pushed down: what they exclude isn't opened, and reading a sheet
ends at the last row asked for. Cells outside the chosen columns aren't decoded. Rows leave in batches bounded in bytes.
"""

from __future__ import annotations

import io
import uuid
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

from sakuin.sources import workbooks

FORMAT = "sakuin_sheets"
FILES = "document_url string, content binary"
_KEYS = ("document_url", "workbook", "sheet")
OPENED = 64  # files that planning opens
DEALT, DEALT_BYTES = 512, 16 << 20  # files of a partition that its task opens, and their bytes
_FOLDER = "files-"  # a task's files


def _store(uri: str):
    from pyarrow.fs import FileSystem

    if uri.startswith("file:/") and not uri.startswith("file://"):  # as Spark writes local paths
        uri = uri.removeprefix("file:")
    return FileSystem.from_uri(uri)


@dataclass
class _Part(InputPartition):
    path: str
    document_url: str
    workbook: str
    entry: str | None  # of an archive
    sheet: str | None  # None: all


@dataclass
class _Files(InputPartition):
    files: list[tuple[str, str]]  # (path, document_url)


class SheetReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        columns = options.get("columns")
        self.columns = None if columns is None else frozenset(int(c) for c in columns.split(",") if c.strip())
        self.limit = int(options.get("batchBytes", workbooks.BATCH_BYTES))
        self.wanted, self.last = {k: None for k in _KEYS}, None

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in self.wanted and isinstance(f, (EqualTo, In)):
                values = set(f.value) if isinstance(f, In) else {f.value}
                self.wanted[name] = values if self.wanted[name] is None else self.wanted[name] & values
            elif name == "row_number" and isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                last = f.value - isinstance(f, LessThan)
                self.last = last if self.last is None else min(self.last, last)
                if isinstance(f, EqualTo):
                    yield f  # ends the reading, but rows before it are left to Spark
            else:
                yield f

    def _asked(self, **values) -> bool:
        return all(self.wanted[k] is None or v in self.wanted[k] for k, v in values.items())

    def partitions(self):
        store, files = _store(self.path)[0], self._listed()
        opened = sorted(sorted(files, key=lambda f: -f[2])[:OPENED])
        out = [p for path, url, _ in opened for p in self._parts(store, path, url)]
        taken, held, size = {f[0] for f in opened}, [], 0
        for path, url, n in files:
            if path in taken:
                continue
            if held and (len(held) >= DEALT or size + n > DEALT_BYTES):
                out.append(_Files(held))
                held, size = [], 0
            held.append((path, url))
            size += n
        return out + ([_Files(held)] if held else [])

    def _listed(self) -> list[tuple[str, str, int]]:
        """(path, document_url, bytes) of the files asked for, in order of paths. Of files of one name that tasks wrote, the newest counts."""
        from pyarrow.fs import FileSelector, FileType

        store, root = _store(self.path)
        found = {}
        for file in store.get_file_info(FileSelector(root, recursive=True)):
            inner = file.path.removeprefix(root).strip("/").split("/")
            if file.type != FileType.File or any(name.startswith((".", "_")) for name in inner):
                continue
            if file.size > workbooks.DOCUMENT_BYTES:
                raise ValueError(f"{file.path} is larger than {workbooks.DOCUMENT_BYTES} bytes")
            url = unquote(file.base_name)
            if self._asked(document_url=url):
                name = (*inner[:-2], inner[-1]) if len(inner) > 1 and inner[-2].startswith(_FOLDER) else tuple(inner)
                at = (file.mtime_ns or 0, file.path)
                if name not in found or found[name][0] < at:
                    found[name] = (at, (file.path, url, file.size))
        return sorted(file for _, file in found.values())

    def _parts(self, store, path: str, url: str) -> list[_Part]:
        name = url.rpartition("/")[2]
        name = unquote(name) if "://" in url else name
        with store.open_input_file(path) as source:
            if name.lower().endswith(".zip"):
                parts = [_Part(path, url, book, entry, None) for book, entry in workbooks.entries(name, source)]
            elif name.lower().endswith((".xlsx", ".xlsm")):
                parts = [_Part(path, url, name, None, sheet) for sheet in workbooks.Book(source).sheets()]
            else:
                raise ValueError(f"unsupported format: {name}")
        return [p for p in parts if self._asked(workbook=p.workbook) and (p.sheet is None or self._asked(sheet=p.sheet))]

    def read(self, partition: _Part | _Files):
        store, _ = _store(self.path)
        parts = (p for path, url in partition.files for p in self._parts(store, path, url)) if isinstance(partition, _Files) else [partition]
        yield from workbooks.batches((row for p in parts for row in self._rows(store, p)), self.limit)

    def _rows(self, store, part: _Part):
        with store.open_input_file(part.path) as source:
            book = workbooks.Book(source if part.entry is None else io.BytesIO(workbooks.entry(source, part.entry)))
            for sheet in [part.sheet] if part.sheet is not None else [s for s in book.sheets() if self._asked(sheet=s)]:
                for number, cells in book.rows(sheet, self.columns, self.last):
                    yield part.document_url, part.workbook, sheet, number, cells


def _move(store, old: str, new: str) -> None:
    try:
        store.move(old, new)
    except (OSError, NotImplementedError):  # object stores move files only
        from pyarrow.fs import FileSelector

        store.create_dir(new)
        for file in store.get_file_info(FileSelector(old)):
            store.move(file.path, f"{new}/{file.base_name}")
        store.delete_dir(old)


@dataclass
class _Written(WriterCommitMessage):
    folder: str


class FileWriter(DataSourceArrowWriter):
    """Rows of (document_url, content) as files that are named by their addresses. A task writes a hidden folder; the driver names the folders
    of the tasks that succeeded, one a task, so retries leave no other content. An address written again replaces the older file for readers."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator) -> WriterCommitMessage:
        store, root = _store(self.path)
        folder = uuid.uuid4().hex
        store.create_dir(f"{root}/.{folder}")
        for batch in iterator:
            for url, content in zip(batch.column(batch.schema.get_field_index("document_url")), batch.column(batch.schema.get_field_index("content")), strict=True):
                with store.open_output_stream(f"{root}/.{folder}/{quote(url.as_py(), safe='')}", compression=None) as out:
                    out.write(content.as_py() or b"")
        return _Written(folder)

    def commit(self, messages) -> None:
        store, root = _store(self.path)
        for m in messages:
            if m:
                _move(store, f"{root}/.{m.folder}", f"{root}/{_FOLDER}{m.folder}")

    def abort(self, messages) -> None:
        store, root = _store(self.path)
        for m in messages:
            if m:
                store.delete_dir(f"{root}/.{m.folder}")


class SheetSource(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return workbooks.ROWS

    def reader(self, schema):
        return SheetReader(self.options)

    def writer(self, schema, overwrite):
        return FileWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SheetSource)


def write_files(files: DataFrame, path: str) -> None:
    """Documents (document_url, content) as files below path. The store is one that the driver and all executors share."""
    register(files.sparkSession)
    files.select("document_url", "content").write.format(FORMAT).mode("append").save(path)


def read_sheets(spark: SparkSession, path: str, columns: list[int] | None = None) -> DataFrame:
    """Rows of all sheets of the documents below path (see worksheet_rows); filter them by document, workbook, sheet and row number."""
    register(spark)
    reader = spark.read.format(FORMAT)
    return (reader if columns is None else reader.option("columns", ",".join(map(str, columns)))).load(path)
