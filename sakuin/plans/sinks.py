"""Publishing a register: partitioned tables, JSON shards, one commit for all of it."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sakuin.functions.codes import PREFIX
from sakuin.plans.files import Folder


def with_prefix(rows: DataFrame) -> DataFrame:
    return rows.withColumn("prefix", F.substring("code", 1, PREFIX))


def write_partitioned(rows: DataFrame, path: str) -> None:
    """One folder per prefix, so that a lookup by code reads one of them. AQE splits a large prefix over several tasks."""
    with_prefix(rows).hint("rebalance", "prefix").write.mode("overwrite").partitionBy("prefix").parquet(path)


def shard_json(facilities: DataFrame, filings: DataFrame, sources: DataFrame) -> DataFrame:
    """(prefix, value): the JSON of each shard. facilities: code, name, address, category, as_of; filings: code, ord, standard_id,
    acceptance_number, effective_from; sources: code, source_id, document_url. Meant for shards of register size."""
    listed = filings.groupBy("code").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", F.array("standard_id", "acceptance_number", F.date_format("effective_from", "yyyy-MM-dd")).alias("row")))), lambda s: s["row"]).alias("standards"))
    known = sources.groupBy("code").agg(F.array_sort(F.collect_set("source_id")).alias("sourceIds"), F.array_sort(F.collect_set("document_url")).alias("sourceDocuments"))
    rows = with_prefix(facilities).join(listed, "code", "left").join(known, "code", "left")
    entry = F.struct("code", F.struct("name", "address", "category", "sourceIds", "sourceDocuments", "standards"))
    shards = rows.groupBy("prefix").agg(_dated("as_of").alias("asOf"), F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("facilities"))
    return shards.select("prefix", F.to_json(F.struct(F.lit(1).alias("schemaVersion"), "asOf", "prefix", "facilities"), {"ignoreNullFields": "false"}).alias("value"))


def _dated(c: str):
    """The latest date of a shard; one without any is an error that names it."""
    return F.coalesce(F.date_format(F.max(c), "yyyy-MM-dd"), F.raise_error(F.concat(F.lit("a shard without a date: "), F.first("prefix"))).cast("string"))


_PLAIN = {"ignoreNullFields": "false"}


def change_shard_json(facilities: DataFrame, events: DataFrame, base_as_of) -> DataFrame:
    """(prefix, value): the JSON of each shard of the change layer. facilities: code, name, address, category; events: those of
    change_event. A shard is as new as its latest event."""
    names = {"id": "id", "action": "action", "publishedAt": "published_at", "standardId": "standard_id", "abbreviation": "abbreviation", "name": "standard_name", "acceptanceNumber": "acceptance_number", "effectiveFrom": "effective_from", "documentUrl": "url", "sourceId": "source_id", "sourcePageUrl": "source_page_url", "page": "page"}
    fields = [(F.date_format(c, "yyyy-MM-dd") if c in ("published_at", "effective_from") else F.col(c)).alias(n) for n, c in names.items()]
    order = [F.col("published_at"), F.when(F.col("action") == "remove", 0).otherwise(1).alias("turn"), F.col("id")]
    listed = events.groupBy("code").agg(F.transform(F.array_sort(F.collect_list(F.struct(*order, F.struct(*fields).alias("e")))), lambda s: s["e"]).alias("events"), F.max("published_at").alias("latest"))
    rows = with_prefix(facilities.join(listed, "code"))
    entry = F.struct("code", F.struct("name", "address", "category", "events"))
    shards = rows.groupBy("prefix").agg(_dated("latest").alias("latestAsOf"), F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("facilities"))
    base = F.date_format(F.lit(base_as_of).cast("date"), "yyyy-MM-dd").alias("baseAsOf")
    return shards.select("prefix", F.to_json(F.struct(F.lit(1).alias("schemaVersion"), base, "latestAsOf", "prefix", "facilities"), _PLAIN).alias("value"))


def catalog_json(catalog: DataFrame) -> DataFrame:
    """(part, value): the dictionary as JSON, a part for each two first digits of the keys."""
    entry = F.struct("standard_id", F.struct("abbreviation", F.col("standard_name").alias("name")))
    parts = catalog.groupBy(F.substring("standard_id", 1, 2).alias("part")).agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("standards"))
    return parts.select("part", F.to_json(F.struct(F.lit(1).alias("schemaVersion"), "standards"), _PLAIN).alias("value"))


def search_json(index: DataFrame) -> DataFrame:
    """(prefix, value): the search index as JSON tuples in order of codes, a part for each prefix."""
    row = F.array("code", "name", "address", "category")
    parts = with_prefix(index).groupBy("prefix").agg(F.transform(F.array_sort(F.collect_list(F.struct("code", row.alias("row")))), lambda s: s["row"]).alias("facilities"))
    return parts.select("prefix", F.to_json(F.struct(F.lit(1).alias("schemaVersion"), "prefix", F.size("facilities").alias("facilityCount"), "facilities"), _PLAIN).alias("value"))


def write_json(shards: DataFrame, path: str) -> None:
    """A folder of JSON text per prefix or part."""
    shards.write.mode("overwrite").partitionBy(shards.columns[0]).text(path)


def one_json(df: DataFrame) -> str:
    """Compact JSON of a one-row summary, with a newline."""
    row = df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j")).first()
    return json.dumps(json.loads(row["j"]), ensure_ascii=False, separators=(",", ":")) + "\n"


#: Tables that lookups by code read; the others are small or read in full.
PARTITIONED = ("facility", "filing", "source", "change_facility", "change_event")
#: Tables that searches read by part.
PARTED = ("name_list", "change_name_list")


#: A table, or a function that makes it from tables written before.
Table = DataFrame | Callable[[Callable[[str], DataFrame]], DataFrame]


class Conflict(RuntimeError):
    """Another publication came first, and this one can't stand on it."""


class Publication:
    """Versions of two layers below one folder, in a log of numbered files; readers take the highest number.

    A version's tables are written in full to folders of their own. Then the publication commits: it makes the log file with the number
    after the newest one, without overwriting, so of two publications that saw the same number one wins. The other looks at what has come:

    * a snapshot ends the changes to the one before, so it stands on any newer version, unless that has a snapshot of a later date;
    * changes stand on any newer version with the snapshot that they were made for. On another snapshot they are made anew if the caller
      says how (`rebase`), and refused otherwise.

    A publication that fails or is refused leaves the log, and so all readers, as they were. Folders stay while one of the newest `keep` versions
    names them: a reader that began before a publication can end. The folder must lie inside `root`, and not be it. The store must
    refuse to rename over a file that exists, as HDFS and local disks do.
    """

    def __init__(self, spark: SparkSession, path: str, root: str, keep: int = 3):
        path, root = path.rstrip("/"), root.rstrip("/")
        if ".." in path.split("/") or not path.startswith(root + "/"):
            raise ValueError(f"{path} is not inside {root}")
        self.spark, self.path, self.keep, self._folder = spark, path, max(1, keep), Folder(spark, path)

    def current(self) -> dict[str, str]:
        """Folder of each layer that is published."""
        return layers(self.spark, self.path)

    def newest(self) -> tuple[int, dict]:
        """Number and content of the newest version; 0 before the first."""
        return _newest(self._folder)

    def _write(self, tables: dict[str, Table], layer: str, partitioned: tuple[str, ...]) -> tuple[str, Callable[[str], DataFrame]]:
        folder, schemas = f"{layer}-{uuid.uuid4().hex}", {}
        read = lambda name: self.spark.read.schema(StructType.fromJson(schemas[name])).parquet(f"{self.path}/{folder}/{name}")
        try:
            for name, df in tables.items():
                df = df if isinstance(df, DataFrame) else df(read)
                schemas[name] = (with_prefix(df) if name in partitioned else df).schema.jsonValue()
                if name in partitioned:
                    write_partitioned(df, f"{self.path}/{folder}/{name}")
                elif name in PARTED:
                    df.hint("rebalance", "part").sortWithinPartitions("part", "run").write.partitionBy("part").parquet(f"{self.path}/{folder}/{name}")
                else:
                    df.write.parquet(f"{self.path}/{folder}/{name}")
            self._folder.create(f"{folder}/{_SCHEMAS}", json.dumps(schemas))
        except BaseException:
            self._folder.remove(folder)
            raise
        return folder, read

    def publish(self, tables: dict[str, Table], layer: str = "snapshot", partitioned: tuple[str, ...] = PARTITIONED, base: str | None = None, rebase: Callable[[dict[str, str]], dict[str, Table]] | None = None, as_of: str | Callable[[], str | None] | None = None, gates: Callable[[Callable[[str], DataFrame]], object] | None = None) -> dict[str, str]:
        """Write all tables as a new version of the layer (snapshot or changes) and make it current.

        Tables are written in their order. One may be a function of `read`, which gives tables written before it by name, so that what follows from
        a table is made from its files and no table is computed twice. base: folder of the snapshot that changes were made for (see current; by default the one that is current now). rebase: from the
        folders of a newer version, the change tables for its snapshot. as_of: date of a snapshot, or what tells it once
        all is written; one of a later date is not replaced. gates: called with `read` when all tables are written; what it raises ends the publication.
        """
        seen = self.newest()[1]
        based = (base or "").rpartition("/")[2] or seen.get("snapshot")
        folder, read = self._write(tables, layer, partitioned)
        try:
            if gates:
                gates(read)
            as_of = as_of() if callable(as_of) else as_of
            while True:
                number, now = self.newest()
                if layer == "changes":
                    if now.get("snapshot") != based:
                        if rebase is None or "snapshot" not in now:
                            raise Conflict(f"the changes were made for {based}, and {now.get('snapshot')} has come")
                        self._folder.remove(folder)
                        based, (folder, read) = now["snapshot"], self._write(rebase(_folders(self.path, now)), layer, partitioned)
                        if gates:
                            gates(read)
                        continue
                    content = {**now, "changes": folder}
                else:
                    if as_of and (now.get("as_of") or "") > as_of:
                        raise Conflict(f"a snapshot of {now['as_of']} has come, this one is of {as_of}")
                    content = {"snapshot": folder, "as_of": as_of}
                if self._folder.create(_log(number + 1), json.dumps(content) + "\n"):
                    break
        except BaseException:
            self._folder.remove(folder)
            raise
        self._retire(number + 1)
        return _folders(self.path, content)

    def _retire(self, number: int) -> None:
        """Remove folders that only versions older than the newest `keep` name, then those versions."""
        log = {int(n.removesuffix(".json")): json.loads(self._folder.read(f"versions/{n}")) for n in self._folder.names("versions")}
        kept = {v for k, x in log.items() if k > number - self.keep for n, v in x.items() if n != "as_of"}
        for k, x in sorted(log.items()):
            if k <= number - self.keep:
                for folder in {v for n, v in x.items() if n != "as_of"} - kept:
                    self._folder.remove(folder)
                self._folder.remove(_log(k))


_SCHEMAS = "schemas.json"


def stored(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of a published version, empty ones and keys of folders with the types that they were written with."""
    return spark.read.schema(StructType.fromJson(json.loads(Folder(spark, folder).read(_SCHEMAS))[name])).parquet(f"{folder}/{name}")


def tables_of(spark: SparkSession, folder: str) -> list[str]:
    return list(json.loads(Folder(spark, folder).read(_SCHEMAS)))


def _log(number: int) -> str:
    return f"versions/{number:020d}.json"


def _newest(folder: Folder) -> tuple[int, dict]:
    names = folder.names("versions")
    return (int(names[-1].removesuffix(".json")), json.loads(folder.read(f"versions/{names[-1]}"))) if names else (0, {})


def _folders(path: str, version: dict) -> dict[str, str]:
    return {k: f"{path}/{v}" for k, v in version.items() if k != "as_of"}


def layers(spark: SparkSession, path: str) -> dict[str, str]:
    """Folder of each layer published below path; none before the first publication."""
    return _folders(path, _newest(Folder(spark, path))[1])
