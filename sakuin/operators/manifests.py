"""Summaries of a published register and the gates it must pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def source_manifest(sources: DataFrame, facility_source: DataFrame, documents: DataFrame) -> DataFrame:
    """Per source of the dimension: latest date, number of facilities, documents sorted by url. Sources without rows show as such."""
    facilities = facility_source.groupBy("source_id").agg(F.countDistinct("code").alias("facility_count"))
    files = documents.groupBy("source_id").agg(F.max("as_of").alias("as_of"), F.sort_array(F.collect_set(F.struct("url", "sha256"))).alias("documents"))
    zero = F.lit(0).cast("long")
    return sources.join(facilities, "source_id", "left").join(files, "source_id", "left").withColumn("facility_count", F.coalesce("facility_count", zero))


def global_manifest(facilities: DataFrame, filings: DataFrame) -> DataFrame:
    """One row: facilities, filings, latest date."""
    return facilities.agg(F.count("*").alias("facility_count"), F.max("as_of").alias("as_of")).crossJoin(filings.agg(F.count("*").alias("standard_count")))  # one row each


def change_manifest(events: DataFrame, documents: DataFrame, base_as_of) -> DataFrame:
    """One row of the change layer; without documents its date is the base's."""
    latest = documents.agg(F.coalesce(F.max("published_at"), F.lit(base_as_of).cast("date")).alias("latest_as_of"), F.count("*").alias("document_count"))
    return events.agg(F.countDistinct("code").alias("facility_count"), F.count("*").alias("event_count")).crossJoin(latest)


def latest_published(sources: DataFrame, documents: DataFrame, fallback: str = "base_as_of") -> DataFrame:
    """Per source its latest publication, or the base date."""
    latest = documents.groupBy("source_id").agg(F.max("published_at").alias("latest"))
    return sources.join(latest, "source_id", "left").withColumn("latest", F.coalesce("latest", fallback))


CATEGORIES = ("medical", "dental", "pharmacy")


def gates(facilities: DataFrame, facility_source: DataFrame, documents: DataFrame, sources: DataFrame, minimum: int = 100_000) -> DataFrame:
    """(gate, subject, found, least, passed): facility minimum, a document and a facility per source, each category present."""
    spark = facilities.sparkSession
    total = facilities.agg(F.lit("minimum").alias("gate"), F.lit("facilities").alias("subject"), F.count("*").alias("found"), F.lit(minimum).cast("long").alias("least"))
    rows = [total]
    for gate, table, key in (("documents", documents, "url"), ("source", facility_source, "code")):
        n = table.groupBy("source_id").agg(F.countDistinct(key).alias("found"))
        rows.append(sources.select("source_id").join(n, "source_id", "left").select(F.lit(gate).alias("gate"), F.col("source_id").alias("subject"), F.coalesce("found", F.lit(0).cast("long")).alias("found"), F.lit(1).cast("long").alias("least")))
    names = spark.createDataFrame([(c,) for c in CATEGORIES], "category string")
    n = facilities.groupBy("category").agg(F.count("*").alias("found"))
    rows.append(names.join(n, "category", "left").select(F.lit("category").alias("gate"), F.col("category").alias("subject"), F.coalesce("found", F.lit(0).cast("long")).alias("found"), F.lit(1).cast("long").alias("least")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.withColumn("passed", F.col("found") >= F.col("least"))


class Observed:
    """A table whose numbers are taken while it is written; `get` has them after that."""

    def __init__(self, table: DataFrame, *metrics):
        self._seen = Observation()
        self.table = table.observe(self._seen, *metrics)

    @property
    def get(self) -> dict:
        return self._seen.get


def observed(facilities: DataFrame, filings: DataFrame) -> tuple[Observed, Observed]:
    """Facilities with their number, latest date and number in each category, filings with their number."""
    count = F.count(F.lit(1))
    return Observed(facilities, count.alias("facility_count"), F.max("as_of").alias("as_of"), *[F.count_if(F.col("category") == c).alias(c) for c in CATEGORIES]), Observed(filings, count.alias("standard_count"))


def measured(spark: SparkSession, facilities: Observed, filings: Observed) -> DataFrame:
    """global_manifest from the numbers of written tables."""
    f = facilities.get
    return spark.createDataFrame([(f["facility_count"], f["as_of"], filings.get["standard_count"])], "facility_count long, as_of date, standard_count long")


def measured_gates(spark: SparkSession, facilities: Observed, manifest: DataFrame, sources: DataFrame, minimum: int = 100_000) -> DataFrame:
    """gates and date_gates from the numbers of written tables. sources: a written source_manifest."""
    f, one = facilities.get, F.lit(1).cast("long").alias("least")
    rows = [("minimum", "facilities", f["facility_count"], minimum), *[("category", c, f[c], 1) for c in CATEGORIES]]
    fixed = spark.createDataFrame(rows, "gate string, subject string, found long, least long")
    each = F.explode(F.array(F.struct(F.lit("documents").alias("gate"), F.coalesce(F.size(F.array_distinct(F.transform("documents", lambda d: d["url"]))), F.lit(0)).cast("long").alias("found")), F.struct(F.lit("source").alias("gate"), F.col("facility_count").alias("found"))))
    by_source = sources.select(F.col("source_id").alias("subject"), each.alias("g")).select("g.gate", "subject", "g.found", one)
    checked = fixed.unionByName(by_source).withColumn("passed", F.col("found") >= F.col("least"))
    return checked.unionByName(date_gates(manifest, sources))


def date_gates(manifest: DataFrame, sources: DataFrame) -> DataFrame:
    """Gates like those of gates: the register and each of its sources must have a date. manifest: one row with as_of; sources:
    source_id, as_of (see source_manifest)."""
    one, found = F.lit(1).cast("long").alias("least"), F.col("as_of").isNotNull().cast("long").alias("found")
    rows = manifest.select(F.lit("date").alias("gate"), F.lit("register").alias("subject"), found, one)
    return rows.unionByName(sources.select(F.lit("date").alias("gate"), F.col("source_id").cast("string").alias("subject"), found, one)).withColumn("passed", F.col("found") >= F.col("least"))


def discovery_gates(found: DataFrame, sources: DataFrame) -> DataFrame:
    """Gates like those of gates: each source must offer a document and a date. found: source_id, url, as_of."""
    sums = found.groupBy("source_id").agg(F.count("url").alias("links"), F.count("as_of").alias("dates"))
    rows = sources.select("source_id").join(sums, "source_id", "left")
    sides = F.explode(F.array(*[F.struct(F.lit(g).alias("gate"), F.coalesce(c, F.lit(0).cast("long")).alias("found")) for g, c in (("page date", "dates"), ("page links", "links"))]))
    rows = rows.select(F.col("source_id").cast("string").alias("subject"), sides.alias("g")).select("g.gate", "subject", "g.found", F.lit(1).cast("long").alias("least"))
    return rows.withColumn("passed", F.col("found") >= F.col("least"))


def require(checked: DataFrame) -> DataFrame:
    """The gates as they are, or an error that names the first that failed."""
    failed = checked.where("not passed").orderBy("gate", "subject").first()
    if failed:
        raise ValueError(f"gate {failed['gate']} of {failed['subject']}: {failed['found']} found, {failed['least']} needed")
    return checked


def parse_rates(pages: DataFrame, least: float = 0.9) -> DataFrame:
    """Per document: acceptance lines, parsed events and whether the share of parsed ones is high enough (no events at all fails)."""
    sums = pages.groupBy("document_url").agg(F.sum("accepted").alias("accepted"), F.sum("parsed").alias("parsed"))
    return sums.withColumn("passed", (F.col("parsed") > 0) & ((F.col("accepted") == 0) | (F.col("parsed") >= least * F.col("accepted"))))
