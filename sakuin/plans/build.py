"""From source documents to the tables of a published register and of its change layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sakuin.functions import codes, text
from sakuin.operators import manifests, merge, name_index, positioned, sheets
from sakuin.operators.tables import kept
from sakuin.plans.sinks import Publication
from sakuin.sources import registers, workbooks


def _snapshot(documents: DataFrame, files: DataFrame, sources: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """What is read and merged: facility, filing, source, catalog, quarantine; and the documents that were used."""
    meta = documents.select("source_id", "bureau_name", "page_url", F.col("url").alias("document_url"), "as_of", "context", F.col("category").alias("category_hint")).join(files.select("document_url", "sha256"), "document_url")
    rows = workbooks.worksheet_rows(workbooks.workbooks(files.join(meta.select("document_url"), "document_url", "left_semi")))
    found, quarantine = sheets.records(rows, meta, registers.PREFECTURES, registers.BUREAU_PREFECTURES)
    # One order over all documents, as if they were read one after another.
    found = kept(found.drop("ord").withColumnRenamed("ord_key", "ord"))
    order = F.struct(F.col("ord"), F.col("pos"))
    facility = found.groupBy("code").agg(
        merge.longest(F.col("name"), order).alias("name"), merge.first_value(F.col("address"), order).alias("address"), F.max("as_of").alias("as_of"),
        *[F.min_by(c, order).alias(c) for c in ("category", "prefecture_code", "local_code")],
    )
    filings = merge.distinct_filings(found.select("code", "ord", "pos", *merge.FILING))
    sources_of = merge.distinct_sources(found.select("code", "ord", "source_id", "bureau_name", "page_url", F.col("document_url").alias("url"), "document_sha256", "workbook", "worksheet")).drop("ord")
    listed = filings.withColumn("standard_id", codes.standard_id(F.col("abbreviation"), F.col("standard_name")))
    filing = merge.placed(listed, "ord", "pos").select("code", "pos", "standard_id", "acceptance_number", "effective_from")
    used = meta.select("source_id", F.col("document_url").alias("url"), "sha256", "as_of")
    return {"facility": facility, "filing": filing, "source": sources_of, "catalog": merge.catalog(filings), "quarantine": quarantine}, used


def _index(facility: DataFrame) -> DataFrame:
    return facility.select("code", "name", "address", "category", text.facility_name(F.col("name")).alias("name_norm"))


def snapshot_tables(documents: DataFrame, files: DataFrame, sources: DataFrame, minimum: int = 100_000, checked: bool = True) -> dict[str, DataFrame]:
    """Tables of the monthly register.

    documents: source_id, bureau_name, page_url, url, as_of, context, category (see monthly_documents); files: document_url, content,
    sha256; sources: source_id. With `checked`, a gate that isn't met raises an error before anything is published.
    """
    tables, used = _snapshot(documents, files, sources)
    links = tables["source"].select("code", "source_id").distinct()
    total, per_source = manifests.global_manifest(tables["facility"], tables["filing"]), manifests.source_manifest(sources.select("source_id"), links, used)
    index = _index(tables["facility"])
    listed = kept(name_index.lists(index))
    if checked:
        manifests.require(manifests.gates(tables["facility"], links, used, sources, minimum))
        manifests.require(manifests.date_gates(total, per_source))
    return {**tables, "search_index": index, "name_list": listed, "name_length": name_index.lengths(listed), "manifest": total, "manifest_source": per_source}


def publish_snapshot(place: Publication, documents: DataFrame, files: DataFrame, sources: DataFrame, minimum: int = 100_000) -> dict[str, str]:
    """Build and publish the monthly register with each table computed once: counts and dates are observed while facilities and filings
    are written, the other tables are made from written ones, and the gates look at these numbers before the version is committed."""
    spark, (tables, used) = documents.sparkSession, _snapshot(documents, files, sources)
    facilities, filings = manifests.observed(tables["facility"], tables["filing"])
    totals = lambda: manifests.measured(spark, facilities, filings)
    made = {
        **tables, "facility": facilities.table, "filing": filings.table,
        "search_index": lambda read: _index(read("facility")),
        "name_list": lambda read: name_index.lists(read("search_index")),
        "name_length": lambda read: name_index.lengths(read("name_list")),
        "manifest": lambda read: totals(),
        "manifest_source": lambda read: manifests.source_manifest(sources.select("source_id"), read("source").select("code", "source_id").distinct(), used),
    }
    gates = lambda read: manifests.require(manifests.measured_gates(spark, facilities, read("manifest"), read("manifest_source"), minimum))
    latest = lambda: None if facilities.get["as_of"] is None else str(facilities.get["as_of"])
    return place.publish(made, as_of=latest, gates=gates)


def change_tables(documents: DataFrame, items: DataFrame, base_as_of, checked: bool = True) -> dict[str, DataFrame]:
    """Tables of the change layer.

    documents: source_id, page_url, url, sha256, published_at, action, category, context, prefecture_code_hint (see change_documents);
    items: document_url, page, x, y, text, ocr.
    """
    meta = documents.select(F.col("url").alias("document_url"), "sha256", "source_id", "page_url", "published_at", "action", F.col("category").alias("category_hint"), "prefecture_code_hint", "context")
    found, pages = (kept(t) for t in positioned.change_events(items, meta, registers.PREFECTURES))
    if checked:
        failed = manifests.parse_rates(pages).where("not passed").orderBy("document_url").first()
        if failed:
            raise ValueError(f"{failed['document_url']}: {failed['parsed']} of {failed['accepted']} filings could be read")
    # Of equal events the first line's facts stand, whatever the order of rows.
    place = F.struct("document_url", "page", "line")
    first = found.groupBy("code", "id").agg(F.min_by(F.struct(*[c for c in found.columns if c not in ("code", "id")]), place).alias("e"))
    events = first.select("code", "id", "e.*").withColumnRenamed("document_url", "url").withColumn("source_page_url", F.col("page_url"))
    order = F.struct("url", "page", "line")
    facility = events.groupBy("code").agg(merge.longest(F.col("name"), order).alias("name"), merge.first_value(F.col("address"), order).alias("address"), F.min_by("category", order).alias("category"), F.max("published_at").alias("latest_as_of"))
    index = _index(facility)
    listed = kept(name_index.lists(index))
    columns = ["code", "id", "action", "published_at", "standard_id", "abbreviation", "standard_name", "acceptance_number", "effective_from", "url", "source_id", "source_page_url", "page", "document_sha256", "extraction_method"]
    return {
        "change_event": events.select(*columns), "change_facility": facility, "change_search_index": index,
        "change_name_list": listed, "change_name_length": name_index.lengths(listed),
        "change_manifest": manifests.change_manifest(events, meta, base_as_of),
        "change_warning": pages.where("parsed = 0 or ocr").select("document_url", "page", F.when(F.col("parsed") == 0, "no rows").otherwise("scanned page").alias("problem")),
    }
