"""Lookups and searches over a published register and its change layer."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sakuin.functions import codes, links, text
from sakuin.operators import name_index, replay, search
from sakuin.operators.tables import kept
from sakuin.plans.files import Folder
from sakuin.plans.sinks import layers, stored

LAYERS = {
    "facility": "code string, name string, address string, category string, as_of date",
    "filing": "code string, pos int, standard_id string, acceptance_number string, effective_from date",
    "source": "code string, url string, source_id string",
    "catalog": "standard_id string, abbreviation string, standard_name string",
    "search_index": "code string, name string, address string, category string, name_norm string",
    "change_facility": "code string, name string, address string, category string, latest_as_of date",
    "change_event": "code string, id string, action string, published_at date, standard_id string, abbreviation string, standard_name string, acceptance_number string, effective_from date, url string, source_id string, source_page_url string, page int, extraction_method string",
    "change_search_index": "code string, name string, address string, category string, name_norm string",
    "change_name_list": "run string, code string, part int",
    "change_name_length": "part int, run string, n long",
}
OPTIONAL = ("change_facility", "change_event", "change_search_index", "change_manifest", "change_name_list", "change_name_length")


def extract_code(value: str) -> str | None:
    """Ten digits of a facility code in a user's input, or None."""
    digits = "".join(c for c in unicodedata.normalize("NFKC", value) if c in "0123456789")
    return digits if len(digits) == 10 and digits[2] in "134" else None


def normalize_code(value: str) -> str:
    code = extract_code(value)
    if code is None:
        raise ValueError(f"not a facility code: {value}")
    return code


class Register:
    """The layers published below a folder. Before the first publication of changes, their tables count as empty."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self._held = spark, path.rstrip("/"), {}
        self._layers = layers(spark, self.path)

    def table(self, name: str) -> DataFrame | None:
        if name not in self._held:
            folder = self._layers.get("changes" if name in OPTIONAL else "snapshot")
            if folder is None and name in OPTIONAL:
                self._held[name] = self.spark.createDataFrame([], LAYERS[name]) if name in LAYERS else None
            elif folder is None:
                raise ValueError(f"{self.path} has no published register")
            else:
                self._held[name] = stored(self.spark, folder, name)
        return self._held[name]

    def clear_cache(self) -> None:
        """Forget what was read; the next call sees the newest publication."""
        self._held.clear()
        self._layers = layers(self.spark, self.path)

    def _shard(self, name: str, code: str | DataFrame | None) -> DataFrame:
        """Rows that share the prefix of a code or of one of a table of codes, or all; with their prefix. Folders of other prefixes aren't
        read: of a table of codes Spark learns the prefixes when it runs (dynamic partition pruning)."""
        df = self.table(name)
        if isinstance(code, str):
            df = df.where(F.col("prefix") == code[: codes.PREFIX]) if "prefix" in df.columns else df.where(F.col("code").startswith(code[: codes.PREFIX]))
        elif code is not None:
            if "prefix" not in df.columns:
                df = df.withColumn("prefix", F.substring("code", 1, codes.PREFIX))
            asked = code.select(F.substring("code", 1, codes.PREFIX).cast(df.schema["prefix"].dataType).alias("prefix")).distinct()
            df = df.join(asked, "prefix", "left_semi")
        return df.drop("prefix").withColumn("prefix", F.substring("code", 1, codes.PREFIX))

    @staticmethod
    def _only(df: DataFrame, code: str | DataFrame | None) -> DataFrame:
        if code is None:
            return df
        return df.where(F.col("code") == code) if isinstance(code, str) else df.join(code.select("code").distinct(), "code", "left_semi")

    def _of(self, name: str, code: str | DataFrame | None) -> DataFrame:
        return self._only(self._shard(name, code).drop("prefix"), code)

    def manifest(self) -> DataFrame:
        return self.table("manifest")

    def change_manifest(self) -> DataFrame | None:
        return self.table("change_manifest")

    def _dates(self, code: str | DataFrame | None) -> DataFrame:
        """(prefix, snapshot_as_of, as_of): the date of each shard, and the newest of it and its changes."""
        sides = [self._shard(t, code).groupBy("prefix").agg(F.max(c).alias(n)) for t, c, n in (("facility", "as_of", "snapshot_as_of"), ("change_facility", "latest_as_of", "changed"))]
        return sides[0].join(sides[1], "prefix", "full_outer").select("prefix", "snapshot_as_of", F.greatest("snapshot_as_of", "changed").alias("as_of"))

    def facilities(self, code: str | DataFrame | None = None) -> DataFrame:
        """Current facilities, all or one: the change layer over the snapshot. A facility is as new as its shard."""
        both = replay.overlay_facilities(self._of("facility", code), self._of("change_facility", code)).withColumn("prefix", F.substring("code", 1, codes.PREFIX))
        counts = self._of("change_event", code).groupBy("code").agg(F.count("*").alias("recent_change_count"))
        rows = both.join(self._dates(code).drop("snapshot_as_of"), "prefix").drop("prefix").join(counts, "code", "left")
        return rows.withColumns({"recent_change_count": F.coalesce("recent_change_count", F.lit(0).cast("long")), "category_label": text.category_label(F.col("category"))})

    def filings(self, code: str | DataFrame | None = None) -> DataFrame:
        """Current filings, all or one facility's, to be read in order of seq, pos."""
        columns = ["code", "pos", "standard_id", "abbreviation", "standard_name", "acceptance_number", "effective_from"]
        base = replay.decode(self._of("filing", code), self.table("catalog")).select(*columns)
        return replay.replay(base, self._of("change_event", code)).select(*columns, "seq")

    def provenance(self, code: str | DataFrame | None = None) -> DataFrame:
        """(code, url) with kind, publication date, page and extraction method; a snapshot's document is as new as its shard."""
        base = self._shard("source", code).join(self._dates(code).select("prefix", F.col("snapshot_as_of").alias("published_at")), "prefix", "left").drop("prefix")
        base = self._only(base, code)
        found = replay.provenance(base, self._of("change_event", code))
        return found.withColumns({"kind": F.when(F.col("kind") == 1, "change").otherwise("snapshot"), "label": links.label(F.col("url")), "link": links.page_link(F.col("url"), F.col("page"))})

    def source_ids(self, code: str | DataFrame | None = None) -> DataFrame:
        """(code, source_id) of both layers, also of documents that a change overrides."""
        return self._of("source", code).select("code", "source_id").unionByName(self._of("change_event", code).select("code", "source_id")).distinct()

    def get(self, code: str) -> dict | None:
        """One facility with filings (in the order that they came to hold, and in `by_name` of their names), documents and sources, or
        None if neither layer has it."""
        code = normalize_code(code)
        found = self.facilities(code).first()
        if found is None:
            return None
        filings = self.filings(code).orderBy("seq", "pos").drop("code")
        named = search.by_name(self.filings(code), "seq", "pos").select("standard_id").collect()
        documents = self.provenance(code).orderBy("url").drop("code").collect()
        sources = self.source_ids(code).orderBy("source_id").collect()
        return {
            **found.asDict(), "local_code": code[3:], "prefecture_code": code[:2], "standards": [r.asDict() for r in filings.collect()], "by_name": [r[0] for r in named],
            "documents": [r.asDict() for r in documents], "source_ids": [r["source_id"] for r in sources],
        }

    def get_many(self, wanted: DataFrame, column: str = "code") -> DataFrame:
        """A row for each row of a table of codes in whatever form: its columns, the code's ten digits as facility_code (null if it isn't
        one), and name, address, category, as_of and recent_change_count of the facility (null if neither layer has it)."""
        asked = kept(wanted.withColumn("facility_code", codes.extract_code(text.normalize_text(F.col(column)))))
        sound = asked.where(F.col("facility_code").rlike("^[0-9]{2}[134]")).select(F.col("facility_code").alias("code"))
        found = self.facilities(sound).select(F.col("code").alias("facility_code"), "name", "address", "category", "as_of", "recent_change_count")
        clash = [c for c in found.columns[1:] if c.lower() in {x.lower() for x in asked.columns}]
        return asked.drop(*clash).join(found, "facility_code", "left")

    def search_by_name(self, query: str, limit: int = 50) -> tuple[int, list[dict]]:
        """Number of matches and the first `limit`: names that begin with the query first, then in Japanese order."""
        one = self.spark.createDataFrame([(query,)], "q string").select(text.facility_name(F.col("q"))).first()[0]
        if not one:
            return 0, []
        found = self._named(self.spark.createDataFrame([(one,)], "query string")).drop("query").persist()
        try:
            return found.count(), [r.asDict() for r in search.ranked(found, one, limit).drop("name_norm").collect()]
        finally:
            found.unpersist()

    def _named(self, queries: DataFrame) -> DataFrame:
        """Current facilities whose normalised names hold the normalised queries: by the lists of character runs where both layers were
        published with them, else by looking at every name."""
        index, changes = self.table("search_index"), self.table("change_search_index")
        changes = changes.select(*index.columns)
        if self._listed():
            return name_index.overlaid(queries, (self.table("name_list"), self.table("name_length"), index), (self.table("change_name_list"), self.table("change_name_length"), changes))
        every = replay.overlay_index(index, changes)
        return every.join(F.broadcast(queries.where("query <> ''")), F.contains("name_norm", "query"))  # the caller's few queries

    def _listed(self) -> bool:
        places = [self._layers.get("snapshot"), self._layers.get("changes")]
        return all(Folder(self.spark, p).exists(n) for p, n in zip(places, ("name_list", "change_name_list"), strict=True) if p)

    def search_many(self, queries: DataFrame, column: str = "query") -> DataFrame:
        """(query, code, name, address, category) for every facility whose name holds a query of a table, in whatever spelling; equal
        spellings of a query are one row each, and one that is empty finds nothing."""
        asked = kept(queries.select(F.col(column).alias("asked"), text.facility_name(F.col(column)).alias("query")).distinct())
        hits = self._named(asked.select("query").distinct())
        return asked.join(hits, "query").select(F.col("asked").alias("query"), "code", "name", "address", "category")

    def lookup(self, text_or_code: str, limit: int = 50):
        code = extract_code(text_or_code)
        return self.get(code) if code else self.search_by_name(text_or_code, limit)
