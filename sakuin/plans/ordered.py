"""Tables in one order over all their files, with an index of the files' first and last keys.

Rows are dealt by ranges of the keys and sorted within them, so no task sorts everything: file after file, the rows are in order. The index
is one small file; a range of keys opens the files that overlap it and no others, and a reader that wants the order streams files one
after another without sorting.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sakuin.plans.files import Folder

ROWS = 1 << 20  # of a file, about


class OrderedTable:
    """A table below a folder, in order of a key column (then of others). Keys are compared as Spark compares them; a null key comes first.

    A version is written in full and becomes visible by one rename of its index, so readers see the old or the new one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self._folder = spark, path.rstrip("/"), Folder(spark, path)

    def write(self, rows: DataFrame, key: str, *then: str, files: int | None = None) -> None:
        """files: how many there are to be; by default as many as Spark makes of the table's size."""
        name = f"rows-{uuid.uuid4().hex}"
        by = [F.asc_nulls_first(key), *then]
        ranged = rows.repartitionByRange(files, *by) if files else rows.repartitionByRange(*by)
        ranged.sortWithinPartitions(*by).write.option("maxRecordsPerFile", ROWS).parquet(f"{self.path}/{name}")
        kind = rows.schema[key].dataType
        written = self.spark.read.schema(StructType().add(key, kind)).parquet(f"{self.path}/{name}")
        file = F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file")
        found = written.select(key, file).groupBy("file").agg(F.count("*").alias("n"), F.count(key).alias("known"), F.to_json(F.struct(F.min(key).alias("k"))).alias("first"), F.to_json(F.struct(F.max(key).alias("k"))).alias("last"))
        listed = sorted((r.asDict() for r in found.collect()), key=lambda r: r["file"])  # one line a file; names of files are in order of ranges
        before = self._index()
        self._folder.replace("index.json", json.dumps({"folder": name, "key": key, "schema": rows.schema.jsonValue(), "files": listed}) + "\n")
        if before:
            self._folder.remove(before["folder"])

    def _index(self) -> dict | None:
        return json.loads(self._folder.read("index.json")) if self._folder.exists("index.json") else None

    def files(self, low=None, high=None) -> list[str]:
        """Files in order that may hold keys from low to high, both included; None is no bound (and then null keys count)."""
        index = self._index()
        if index is None:
            raise ValueError(f"{self.path} has no table")
        if not index["files"]:
            return []
        kind = StructType().add("k", StructType.fromJson(index["schema"])[index["key"]].dataType)
        ends = self.spark.createDataFrame([(x["file"], x["first"], x["last"], x["known"]) for x in index["files"]], "file string, first string, last string, known long")
        ends = ends.select("file", "known", F.from_json("first", kind)["k"].alias("first"), F.from_json("last", kind)["k"].alias("last"))  # as many rows as files
        bounded = F.lit(low is None and high is None) | (F.col("known") > 0)
        good = bounded & (F.lit(True) if low is None else F.col("last") >= F.lit(low)) & (F.lit(True) if high is None else F.col("first") <= F.lit(high))
        return [f"{self.path}/{index['folder']}/{r[0]}" for r in ends.where(good).orderBy("file").select("file").collect()]

    def _read(self, files: list[str], low, high) -> DataFrame:
        index = self._index()
        schema, key = StructType.fromJson(index["schema"]), F.col(index["key"])
        rows = self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)
        rows = rows if low is None else rows.where(key >= F.lit(low))
        return rows if high is None else rows.where(key <= F.lit(high))

    def between(self, low=None, high=None) -> DataFrame:
        """Rows with keys from low to high, both included."""
        return self._read(self.files(low, high), low, high)

    def before(self, low) -> int:
        """How many rows lie before a key: the index's numbers, and the files that may hold it."""
        index, some = self._index(), self.files(low, low)
        first = self.files(None, low)
        counted = {f"{self.path}/{index['folder']}/{x['file']}": x["n"] for x in index["files"]}
        nulls = sum(x["n"] for x in index["files"] if not x["known"])
        partly = self._read(some, None, None).where(F.coalesce(F.col(index["key"]) < F.lit(low), F.lit(True))).count() if some else 0
        return nulls + sum(counted[f] for f in first if f not in some) + partly

    def in_order(self, low=None, high=None) -> Iterator[Row]:
        """The same rows in order: a file at a time, streamed, without a sort."""
        for file in self.files(low, high):
            yield from self._read([file], low, high).coalesce(1).toLocalIterator()
