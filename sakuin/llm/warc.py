"""WARC archives as a Spark data source: gzip members per record, header-first reading, payloads skipped unless wanted."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, StringStartsWith, WriterCommitMessage
from pyspark.sql.types import StructType

from sakuin.llm.shared import durable, shared_dir

FORMAT = "sakuin_warc"
WRITE_SCHEMA = "page_id long, url string, html string, payload_bytes long, sha1 string, refers_to long"
READ_SCHEMA = "record_type string, page_id long, target_uri string, payload_bytes long, payload_digest string, refers_to long, payload binary"
HEAD = 16_384  # compressed bytes read for a record's headers
FILE_BYTES = 128 << 20  # a writing task starts another file beyond this size, so that one file stays one fair partition


def _store(uri: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else f"file://{uri}")


_ESCAPED = {c: f"%{ord(c):02X}" for c in "% \t\r\n"}


def _line(url: str) -> list[str]:
    """The headers of an address. One that a header line can't hold as it is gets escaped, and a header says so."""
    if url.strip(" \t") == url and "\r" not in url and "\n" not in url:
        return [f"WARC-Target-URI: {url}"]
    return [f"WARC-Target-URI: {''.join(_ESCAPED.get(c, c) for c in url)}", "X-Target-URI-Escaped: 1"]


def member(record: bytes, level: int = 1) -> bytes:
    """One gzip member whose extra field `sl` tells its compressed and plain length, so that readers can step over it. Both take
    32 bits, which a row's text, below 2 GiB in Spark, can't exceed."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    size = 10 + 2 + 12 + len(body) + 8
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, size & 0xFFFFFFFF, len(record) & 0xFFFFFFFF) + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def record(page_id: int | None, url: str | None, html: str | None, payload_bytes: int, sha1: str, refers_to: int | None) -> bytes:
    """A response with its payload, or a revisit that refers to another page's response."""
    kind = "response" if refers_to is None else "revisit"
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    head += _line(url) if url is not None else []
    head += [f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha1)).decode()}", f"X-Payload-Length: {payload_bytes}"]
    head += [f"X-Page-ID: {page_id}"] if page_id is not None else []
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is None:
        body = (html or "").encode()
        block += f"Content-Length: {len(body)}\r\n\r\n".encode() + body
    else:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page-ID: {refers_to}"]
        block += b"\r\n"
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Written(WriterCommitMessage):
    def __init__(self, names: list[str]):
        self.names = names


class WarcWriter(DataSourceArrowWriter):
    """Tasks write hidden files; the driver renames those of the successful tasks, so retries leave no double records."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, path = _store(self.path)
        store.create_dir(path)
        names, out = [], None
        for batch in iterator:
            for row in zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("page_id", "url", "html", "payload_bytes", "sha1", "refers_to")], strict=True):
                if out is None:
                    names.append(f"{uuid.uuid4().hex}.warc.gz")
                    out = store.open_output_stream(f"{path}/.{names[-1]}", compression=None)
                out.write(member(record(*row)))
                if out.tell() > FILE_BYTES:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return _Written(names)

    def commit(self, messages) -> None:
        store, path = _store(self.path)
        store.create_dir(path)
        for name in (x for m in messages if m for x in m.names):
            store.move(f"{path}/.{name}", f"{path}/{name}")
        store.open_output_stream(f"{path}/_SUCCESS").close()

    def abort(self, messages) -> None:
        store, path = _store(self.path)
        for name in (x for m in messages if m for x in m.names):
            store.delete_file(f"{path}/.{name}")


def _verify(payload: bytes, headers: dict[str, str], path: str) -> None:
    """A payload without the SHA-1 that its record states is an error."""
    stated = headers.get("warc-payload-digest", "")
    if stated.startswith("sha1:") and stated != f"sha1:{base64.b32encode(hashlib.sha1(payload).digest()).decode()}":
        raise ValueError(f"{path}: payload of {headers.get('warc-record-id')} differs from its digest")


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


#: Column of the data source: header that a predicate on it is checked against.
_HEADERS = {"record_type": "warc-type", "target_uri": "warc-target-uri", "payload_digest": "warc-payload-digest"}


class WarcReader(DataSourceReader):
    """One partition per archive file. Predicates on record type and on headers are checked on the headers alone."""

    def __init__(self, path: str, schema: StructType):
        self.path, self.columns, self.tests = path, schema.fieldNames(), []

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in _HEADERS and isinstance(f, (EqualTo, In, StringStartsWith)):
                self.tests.append((column, "starts" if isinstance(f, StringStartsWith) else "in", f.value if not isinstance(f, EqualTo) else (f.value,)))
            else:
                yield f

    def partitions(self):
        from pyarrow.fs import FileSelector

        store, path = _store(self.path)
        return [_File(f.path) for f in sorted(store.get_file_info(FileSelector(path, recursive=True)), key=lambda f: f.path) if f.path.endswith(".warc.gz") and not f.base_name.startswith(".")]

    def _wanted(self, headers: dict[str, str]) -> bool:
        for column, how, value in self.tests:
            found = headers.get(_HEADERS[column])
            if column == "payload_digest" and found:
                found = found.removeprefix("sha1:")
            if found is None or not (found.startswith(value) if how == "starts" else found in value):
                return False
        return True

    def read(self, partition: _File):
        store, _ = _store(self.path)
        names = self.columns
        with store.open_input_file(partition.path) as source:
            at, end = 0, source.size()
            while at < end:
                source.seek(at)
                head = source.read(HEAD)
                inflate = zlib.decompressobj(31)
                plain = inflate.decompress(head)
                while b"\r\n\r\n" not in plain and not inflate.eof and (more := source.read(HEAD)):
                    plain += inflate.decompress(more)
                lines, _, rest = plain.partition(b"\r\n\r\n")
                headers = {k.strip().lower(): v.strip(" \t") for k, _, v in (x.partition(":") for x in lines.decode("utf-8", "replace").split("\r\n")[1:])}
                if "x-target-uri-escaped" in headers:
                    headers["warc-target-uri"] = unquote(headers["warc-target-uri"])
                wanted = self._wanted(headers)
                payload = None
                known = head[3] & 4 and head[12:14] == b"sl"
                if not known or (wanted and "payload" in names):
                    while not inflate.eof and (more := source.read(1 << 20)):
                        rest += inflate.decompress(more)
                    at = source.tell() - len(inflate.unused_data)
                    if headers.get("warc-type") == "response":
                        payload = rest[: int(headers["content-length"])].partition(b"\r\n\r\n")[2]
                        _verify(payload, headers, partition.path)
                else:
                    at += struct.unpack_from("<I", head, 16)[0]
                if wanted:
                    number = lambda k, h=headers: int(h[k]) if k in h else None
                    row = {
                        "record_type": headers.get("warc-type"), "page_id": number("x-page-id"), "target_uri": headers.get("warc-target-uri"), "payload_bytes": number("x-payload-length"),
                        "payload_digest": headers.get("warc-payload-digest", "").removeprefix("sha1:") or None, "refers_to": number("x-refers-to-page-id"), "payload": payload,
                    }
                    yield tuple(row[c] for c in names)


class WarcSource(DataSource):
    """`spark.read.format("sakuin_warc").load(folder)`; give a schema without `payload` to leave payloads undecoded."""

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return READ_SCHEMA

    def reader(self, schema):
        return WarcReader(self.options["path"], schema)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def deduplicated(pages: DataFrame, least: int = 0) -> DataFrame:
    """What each page's record holds. Of pages with equal payloads of at least `least` bytes, the largest page_id keeps
    the payload (every row with it, where it repeats) and the others refer to it. Null html is an empty payload. A null
    page_id never keeps a payload that a numbered page has; among null ones alone, all keep theirs. An empty table gives none, and
    columns other than page_id, url and html are left out, whatever their names.

    Only ids and digests are grouped. What they decide is joined to the pages by id, so copies of one payload meet in no one
    task, and where the revisits are few Spark broadcasts them and html isn't shuffled at all.
    """
    body = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), "url", body.alias("html"), F.octet_length(body).cast("long").alias("payload_bytes"), F.sha1(body.cast("binary")).alias("sha1"))
    digests = durable(rows.where(F.col("payload_bytes") >= least).groupBy("sha1", "page_id").agg(F.count("*").alias("n")), "digests")
    keepers = durable(digests.groupBy("sha1").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").select("sha1", "refers_to"), "keepers")
    revisits = durable(digests.drop("n").join(keepers, "sha1").where(~F.col("page_id").eqNullSafe(F.col("refers_to"))), "revisits").select(F.col("page_id").alias("id"), F.col("sha1").alias("digest"), "refers_to")
    decided = rows.join(revisits, F.col("page_id").eqNullSafe(F.col("id")) & (F.col("sha1") == F.col("digest")), "left")
    return decided.select("page_id", "url", F.when(F.col("refers_to").isNull(), F.col("html")).alias("html"), "payload_bytes", "sha1", "refers_to")


def write_archives(pages: DataFrame, path: str, least: int = 0) -> None:
    """Archive pages (page_id, url, html) below path. An empty table writes no archive; other columns are left out."""
    register(pages.sparkSession)
    deduplicated(pages, least).write.format(FORMAT).mode("append").save(path)


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    schema = READ_SCHEMA if payload else READ_SCHEMA.removesuffix(", payload binary")
    return spark.read.format(FORMAT).schema(schema).load(path)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses are read with their payloads, which must have the digests stated; revisits by their headers alone."""
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    responses = read_archives(spark, path).where("record_type = 'response'").withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    revisits = read_archives(spark, path, payload=False).where("record_type = 'revisit'")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.select(columns).unionByName(revisits.select(columns))
