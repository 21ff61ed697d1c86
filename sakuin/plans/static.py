"""A register as static JSON files: the layout that web clients fetch, written from tables and read back as the same tables.

    manifest.json  catalog.json  search.json  facilities/<prefix>.json
    changes/manifest.json  changes/search.json  changes/facilities/<prefix>.json

The field names are fixed values of the public format. Shards are files of their own, so a lookup opens one; dictionary and search
index are one file each, written in order of their keys by many tasks and joined as streams.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sakuin.functions import codes, text
from sakuin.operators.tables import kept
from sakuin.plans import sinks
from sakuin.plans.client import LAYERS, OPTIONAL, Register
from sakuin.plans.files import Folder

VERSION = 1
# Fields of the public format.
_FACILITY = "name string, address string, category string, sourceIds array<string>, sourceDocuments array<string>, standards array<array<string>>"
_EVENT = "id string, action string, standardId string, standard struct<abbreviation:string, name:string>, acceptanceNumber string, effectiveFrom string, publishedAt string, sourceId string, sourcePageUrl string, documentUrl string, documentSha256 string, page int, extractionMethod string"


def _struct(fields: str) -> str:
    """A struct type of fields that are written as a schema."""
    out, depth, parts = "", 0, []
    for c in fields + ",":
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            parts.append(out.strip().replace(" ", ": ", 1))
            out = ""
        else:
            out += c
    return f"struct<{', '.join(parts)}>"


SHARD = f"schemaVersion int, asOf string, prefix string, facilities map<string, {_struct(_FACILITY)}>"
CHANGE_SHARD = f"schemaVersion int, baseAsOf string, latestAsOf string, prefix string, facilities map<string, {_struct(f'name string, address string, category string, events array<{_struct(_EVENT)}>')}>"
CATALOG = "schemaVersion int, standards map<string, struct<abbreviation: string, name: string>>"
SEARCH = "schemaVersion int, facilities array<array<string>>"
MANIFEST = "schemaVersion int, generatedAt string, asOf string, shardPrefixLength int, facilityCount long, standardCount long, sources array<struct<id: string, bureauName: string, pageUrl: string, asOf: string, facilityCount: long, documents: array<struct<url: string, sha256: string>>>>"
CHANGE_MANIFEST = "schemaVersion int, generatedAt string, baseAsOf string, latestAsOf string, facilityCount long, eventCount long, sources array<struct<id: string, bureauName: string, pageUrls: array<string>, documents: array<struct<url: string, sha256: string, publishedAt: string, action: string>>>>"
_ALL = {"ignoreNullFields": "false"}


def _day(c) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def change_shards(facilities: DataFrame, events: DataFrame, base_as_of: str) -> DataFrame:
    """(prefix, value): the JSON of each shard of the change layer, with every fact of an event. facilities: code, name, address,
    category; events: those of change_event, with document_sha256 if it is there."""
    sha = F.col("document_sha256") if "document_sha256" in events.columns else F.lit(None).cast("string")
    fields = [
        F.col("id"), F.col("action"), F.col("standard_id").alias("standardId"), F.struct("abbreviation", F.col("standard_name").alias("name")).alias("standard"),
        F.col("acceptance_number").alias("acceptanceNumber"), _day("effective_from").alias("effectiveFrom"), _day("published_at").alias("publishedAt"), F.col("source_id").alias("sourceId"),
        F.col("source_page_url").alias("sourcePageUrl"), F.col("url").alias("documentUrl"), sha.alias("documentSha256"), F.col("page"), F.col("extraction_method").alias("extractionMethod"),
    ]
    order = [F.col("published_at"), F.when(F.col("action") == "remove", 0).otherwise(1).alias("turn"), F.col("id")]
    listed = events.groupBy("code").agg(F.transform(F.array_sort(F.collect_list(F.struct(*order, F.struct(*fields).alias("e")))), lambda s: s["e"]).alias("events"), F.max("published_at").alias("latest"))
    rows = sinks.with_prefix(facilities.join(listed, "code"))
    entry = F.struct("code", F.struct("name", "address", "category", "events"))
    shards = rows.groupBy("prefix").agg(_day(F.max("latest")).alias("latestAsOf"), F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("facilities"))
    return shards.select("prefix", F.to_json(F.struct(F.lit(VERSION).alias("schemaVersion"), F.lit(base_as_of).alias("baseAsOf"), "latestAsOf", "prefix", "facilities"), _ALL).alias("value"))


def manifest_json(total: DataFrame, sources: DataFrame, bureaus: DataFrame, generated_at: str) -> str:
    """The manifest of a snapshot. total: facility_count, standard_count, as_of; sources: source_id, as_of, facility_count, documents;
    bureaus: source_id, bureau_name, page_url. One entry a source."""
    one = F.struct("source_id", F.struct(F.col("source_id").alias("id"), F.col("bureau_name").alias("bureauName"), F.col("page_url").alias("pageUrl"), _day("as_of").alias("asOf"), F.col("facility_count").alias("facilityCount"), "documents").alias("s"))
    listed = sources.join(bureaus.select("source_id", "bureau_name", "page_url"), "source_id", "left").agg(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["s"]).alias("sources"))
    row = total.crossJoin(listed).select(F.lit(VERSION).alias("schemaVersion"), F.lit(generated_at).alias("generatedAt"), _day("as_of").alias("asOf"), F.lit(codes.PREFIX).alias("shardPrefixLength"), F.col("facility_count").alias("facilityCount"), F.col("standard_count").alias("standardCount"), "sources")  # one row each
    return sinks.one_json(row)


def change_manifest_json(total: DataFrame, documents: DataFrame, base_as_of: str, generated_at: str) -> str:
    """The manifest of a change layer. total: facility_count, event_count, latest_as_of; documents: source_id, bureau_name, page_url, url,
    sha256, published_at, action."""
    document = F.struct("url", "sha256", _day("published_at").alias("publishedAt"), "action")
    sources = documents.groupBy("source_id").agg(F.min("bureau_name").alias("bureauName"), F.array_sort(F.collect_set("page_url")).alias("pageUrls"), F.array_sort(F.collect_set(document)).alias("documents"))
    one = F.struct(F.col("source_id").alias("id"), "bureauName", "pageUrls", "documents")
    row = total.crossJoin(sources.agg(F.array_sort(F.collect_list(one)).alias("sources")))  # one row each
    return sinks.one_json(row.select(F.lit(VERSION).alias("schemaVersion"), F.lit(generated_at).alias("generatedAt"), F.lit(base_as_of).alias("baseAsOf"), _day("latest_as_of").alias("latestAsOf"), F.col("facility_count").alias("facilityCount"), F.col("event_count").alias("eventCount"), "sources"))


def _write_shards(shards: DataFrame, place: Folder, name: str) -> None:
    """One file for each prefix. Tasks write them all; the driver gives them their names."""
    staged = f"{name}-{uuid.uuid4().hex}"
    shards.write.partitionBy("prefix").text(f"{place.path}/{staged}")
    for folder in place.names(staged):
        if folder.startswith("prefix="):
            for file in place.names(f"{staged}/{folder}"):
                place.move(f"{staged}/{folder}/{file}", f"{name}/{folder.removeprefix('prefix=')}.json")
    place.remove(staged)


def _write_ordered(rows: DataFrame, key: str, item: Column, place: Folder, name: str, head: str, tail: str) -> None:
    """One JSON file of all rows in order of a key: tasks write ranges of it, which are joined as streams."""
    staged = f"{name}-{uuid.uuid4().hex}"
    lines = rows.select(key, F.concat(F.lit(","), item).alias("value")).repartitionByRange(key).sortWithinPartitions(key)
    lines.select("value").write.text(f"{place.path}/{staged}")
    place.joined([f"{staged}/{n}" for n in place.names(staged) if n.startswith("part-")], name, head, tail)
    place.remove(staged)


def _search(index: DataFrame, place: Folder, name: str, head: dict) -> None:
    item = F.to_json(F.array("code", "name", "address", "category"))
    start = json.dumps(head, ensure_ascii=False, separators=(",", ":"))
    _write_ordered(index, "code", item, place, name, f'{start[:-1]},"facilities":[', "]}\n")


def swap(parent: Folder, staged: str, name: str) -> None:
    """Put a staged folder in the place of another; if that fails, the old one is back."""
    previous = f"{name}.previous"
    parent.remove(previous)
    had = parent.exists(name)
    if had:
        parent.move(name, previous)
    try:
        parent.move(staged, name)
    except BaseException:
        if had:
            parent.move(previous, name)
        raise
    parent.remove(previous)


def export_snapshot(tables: dict[str, DataFrame], bureaus: DataFrame, path: str, generated_at: str) -> None:
    """Tables of a snapshot (see snapshot_tables) as static files in place of all that was at path, changes to the old one included."""
    parent, _, name = path.rstrip("/").rpartition("/")
    spark, staged = bureaus.sparkSession, f"{name}.new-{uuid.uuid4().hex}"
    parent, place = Folder(spark, parent), Folder(spark, f"{parent}/{staged}")
    try:
        plain = {k: v.drop("prefix") for k, v in tables.items()}
        source = plain["source"].withColumnRenamed("url", "document_url")
        _write_shards(sinks.shard_json(plain["facility"], plain["filing"].withColumnRenamed("pos", "ord"), source), place, "facilities")
        standard = F.concat(F.to_json(F.array("standard_id")).substr(F.lit(2), F.length(F.to_json(F.array("standard_id"))) - 2), F.lit(":"), F.to_json(F.struct("abbreviation", F.col("standard_name").alias("name")), _ALL))
        _write_ordered(plain["catalog"], "standard_id", standard, place, "catalog.json", f'{{"schemaVersion":{VERSION},"standards":{{', "}}\n")
        total = plain["manifest"].first()
        manifest = spark.createDataFrame([total], plain["manifest"].schema)  # counted once
        _search(plain["search_index"], place, "search.json", {"schemaVersion": VERSION, "generatedAt": generated_at, "asOf": str(total["as_of"] or ""), "facilityCount": total["facility_count"]})
        place.replace("manifest.json", manifest_json(manifest, plain["manifest_source"], bureaus, generated_at))
        place.remove(".staged")
        swap(parent, staged, name)
    except BaseException:
        parent.remove(staged)
        raise


def export_changes(tables: dict[str, DataFrame], documents: DataFrame, base_as_of: str, path: str, generated_at: str) -> None:
    """Tables of a change layer (see change_tables) as static files below the snapshot's, in place of older changes."""
    spark, staged = documents.sparkSession, f"changes.new-{uuid.uuid4().hex}"
    parent, place = Folder(spark, path), Folder(spark, f"{path.rstrip('/')}/{staged}")
    try:
        plain = {k: v.drop("prefix") for k, v in tables.items()}
        _write_shards(change_shards(plain["change_facility"], plain["change_event"], base_as_of), place, "facilities")
        total = plain["change_manifest"].first()
        manifest = spark.createDataFrame([total], plain["change_manifest"].schema)  # counted once
        _search(plain["change_search_index"], place, "search.json", {"schemaVersion": VERSION, "generatedAt": generated_at, "baseAsOf": base_as_of, "latestAsOf": str(total["latest_as_of"] or "")})
        place.replace("manifest.json", change_manifest_json(manifest, documents, base_as_of, generated_at))
        place.remove(".staged")
        swap(parent, staged, "changes")
    except BaseException:
        parent.remove(staged)
        raise


def read_json(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """The fields of JSON files, a row a file. A file that isn't such JSON, or of another version of the format, is an error."""
    rows = spark.read.option("pathGlobFilter", "*.json").text(paths, wholetext=True)
    fields = F.inline(F.array(F.from_json("value", schema, {"mode": "FAILFAST"})))  # not a plain column, which each filter would parse anew
    wrong = F.raise_error(F.concat(F.lit("not a file of this format: "), F.input_file_name())).cast("boolean")
    return rows.select(fields).where(F.when(F.coalesce(F.col("schemaVersion") == VERSION, F.lit(False)), True).otherwise(wrong))


def base_date(spark: SparkSession, manifest: str) -> str:
    """The date of the snapshot that a published manifest describes."""
    found = read_json(spark, [manifest], MANIFEST).first()["asOf"]
    if not found:
        raise ValueError(f"{manifest} has no date")
    return found


class StaticRegister(Register):
    """A register read from static files, with the queries of Register. A shard that isn't there is empty, and so is a change layer;
    other files must be there, and none may be corrupt. A code, or a table of codes, opens the shards of its prefixes only. What all
    shards of a layer hold, but for filings, is parsed once, as a table that stands until clear_cache."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self._held, self._place = spark, path.rstrip("/"), {}, Folder(spark, path)

    def clear_cache(self) -> None:
        self._held.clear()

    def _shards(self, layer: str, wanted) -> DataFrame:
        """Parsed shards of all prefixes, of one code or of a table of codes."""
        folder, schema = ("changes/facilities", CHANGE_SHARD) if layer == "changes" else ("facilities", SHARD)
        if isinstance(wanted, str):
            names = [f"{wanted[: codes.PREFIX]}.json"]
            names = [n for n in names if self._place.exists(f"{folder}/{n}")]
        else:
            names = [n for n in self._place.names(folder) if n.endswith(".json")]
            if wanted is not None:
                asked = {r[0] for r in wanted.select(F.substring("code", 1, codes.PREFIX)).distinct().collect()} if names else set()  # at most as many as there are prefixes
                names = [n for n in names if n.removesuffix(".json") in asked]
        if not names:
            return self.spark.createDataFrame([], schema)
        every = wanted is None
        return read_json(self.spark, [f"{self.path}/{folder}"] if every else [f"{self.path}/{folder}/{n}" for n in names], schema)

    def _facilities(self, layer: str, wanted) -> DataFrame:
        """(dated, code, f): a row for each facility of the shards, with its shard's date."""
        dated = "latestAsOf" if layer == "changes" else "asOf"
        return self._shards(layer, wanted).select(F.col(dated).alias("dated"), F.explode("facilities").alias("code", "f"))

    def _facts(self, layer: str, wanted) -> DataFrame:
        """The same without filings, which one view only reads; of all shards, as a table."""
        if wanted is not None:
            return self._facilities(layer, wanted)
        if f"{layer} facts" not in self._held:
            rows = self._facilities(layer, None)
            self._held[f"{layer} facts"] = kept(rows if layer == "changes" else rows.withColumn("f", F.col("f").dropFields("standards")))
        return self._held[f"{layer} facts"]

    def _rows(self, name: str, wanted) -> DataFrame:
        if name == "filing":
            s = self._facilities("snapshot", wanted).select("code", F.posexplode("f.standards").alias("pos", "s"))
            return s.select("code", "pos", F.get("s", F.lit(0)).alias("standard_id"), F.get("s", F.lit(1)).alias("acceptance_number"), F.to_date(F.get("s", F.lit(2))).alias("effective_from"))
        f = self._facts("changes" if name in OPTIONAL else "snapshot", wanted)
        if name == "facility":
            return f.select("code", "f.name", "f.address", "f.category", F.to_date(F.nullif("dated", F.lit(""))).alias("as_of"))
        if name == "source":
            only = F.when(F.size("f.sourceIds") == 1, F.col("f.sourceIds")[0])  # the format doesn't say which document is whose
            return f.select("code", F.explode("f.sourceDocuments").alias("url"), only.alias("source_id"))
        if name == "change_facility":
            return f.select("code", "f.name", "f.address", "f.category", F.to_date(F.nullif("dated", F.lit(""))).alias("latest_as_of"))
        e = f.select("code", F.explode("f.events").alias("e"))
        return e.select("code", "e.id", "e.action", F.to_date("e.publishedAt").alias("published_at"), F.col("e.standardId").alias("standard_id"), "e.standard.abbreviation", F.col("e.standard.name").alias("standard_name"), F.col("e.acceptanceNumber").alias("acceptance_number"), F.to_date("e.effectiveFrom").alias("effective_from"), F.col("e.documentUrl").alias("url"), F.col("e.sourceId").alias("source_id"), F.col("e.sourcePageUrl").alias("source_page_url"), "e.page", F.col("e.extractionMethod").alias("extraction_method"))

    def _shard(self, name: str, code) -> DataFrame:
        return self._rows(name, code).withColumn("prefix", F.substring("code", 1, codes.PREFIX))

    def _index(self, name: str) -> DataFrame:
        row = lambda k: F.get("f", F.lit(k))
        rows = read_json(self.spark, [f"{self.path}/{name}"], SEARCH).select(F.explode("facilities").alias("f"))
        return rows.select(row(0).alias("code"), row(1).alias("name"), row(2).alias("address"), row(3).alias("category"), text.facility_name(row(1)).alias("name_norm"))

    def table(self, name: str) -> DataFrame | None:
        if name in self._held:
            return self._held[name]
        if name == "catalog":
            found = read_json(self.spark, [f"{self.path}/catalog.json"], CATALOG).select(F.explode("standards").alias("standard_id", "s")).select("standard_id", "s.abbreviation", F.col("s.name").alias("standard_name"))
        elif name == "search_index":
            found = self._index("search.json")
        elif name == "change_search_index":
            found = self._index("changes/search.json") if self._place.exists("changes/search.json") else self.spark.createDataFrame([], LAYERS[name])
        elif name == "manifest":
            found = read_json(self.spark, [f"{self.path}/manifest.json"], MANIFEST).select(F.col("facilityCount").alias("facility_count"), F.to_date("asOf").alias("as_of"), F.col("standardCount").alias("standard_count"), "sources")
        elif name == "change_manifest":
            found = read_json(self.spark, [f"{self.path}/changes/manifest.json"], CHANGE_MANIFEST).select(F.col("facilityCount").alias("facility_count"), F.col("eventCount").alias("event_count"), F.to_date("baseAsOf").alias("base_as_of"), F.to_date("latestAsOf").alias("latest_as_of"), "sources") if self._place.exists("changes/manifest.json") else None
        else:
            found = self._rows(name, None)
        self._held[name] = found
        return found

    def _listed(self) -> bool:
        return False

    def source_ids(self, code=None) -> DataFrame:
        ids = self._facts("snapshot", code).select("code", F.explode("f.sourceIds").alias("source_id"))
        return self._only(ids, code).unionByName(self._of("change_event", code).select("code", "source_id")).distinct()
