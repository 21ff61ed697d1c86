"""Command line: build a register, build its change layer, or list the documents that pages offer."""

from __future__ import annotations

import argparse
import sys
from datetime import UTC, datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sakuin.operators import discovery, manifests
from sakuin.plans import build, client, sinks, static
from sakuin.sources import registers, workbooks


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> None:
    """Pages and files come as tables or folders that an outside fetcher keeps; every command ends with one line of JSON."""
    parser = argparse.ArgumentParser(prog="sakuin")
    parser.add_argument("command", choices=["update", "update-recent", "discover"])
    parser.add_argument("--pages", required=True, help="Parquet of page_url, html (for changes also the columns of change_pages)")
    parser.add_argument("--files", help="Parquet of document_url, content; for changes Parquet of positioned text with sha256")
    parser.add_argument("--out", help="folder to publish in")
    parser.add_argument("--root", default="", help="folder that --out must lie inside")
    parser.add_argument("--base", help="date of the register that changes refer to; by default that of the published one")
    parser.add_argument("--manifest", help="published manifest.json that has this date, where the register itself is elsewhere")
    parser.add_argument("--json", help="folder for the published layer as static JSON files")
    parser.add_argument("--min-facilities", type=int, default=100_000)
    o = parser.parse_args(args)
    spark = spark or SparkSession.builder.getOrCreate()
    pages = spark.read.parquet(o.pages)
    place = sinks.Publication(spark, o.out, o.root or o.out.rpartition("/")[0]) if o.out else None
    if o.command == "update-recent":
        seen = sinks.layers(spark, o.out)
        base = o.base or (static.base_date(spark, o.manifest) if o.manifest else str(client.Register(spark, o.out).manifest().first()["as_of"]))
        if not {"source_id", "prefecture_code_hint"} <= set(pages.columns):
            pages = pages.select("page_url", "html").join(registers.change_pages(spark), "page_url")
        items = spark.read.parquet(o.files)
        known = items.select("document_url", "sha256").distinct().withColumnRenamed("document_url", "url")

        def changes(base):
            found = discovery.change_documents(pages, base).join(known, "url")
            return found, build.change_tables(found, items.drop("sha256"), base)

        def rebased(newer):
            nonlocal base, found
            base = str(sinks.stored(spark, newer["snapshot"], "manifest").first()["as_of"])
            found, made = changes(base)
            return made

        found, tables = changes(base)
        published = place.publish(tables, "changes", base=seen.get("snapshot"), rebase=None if o.base or o.manifest else rebased)["changes"]
        layer, result = "changes", "change_manifest"
    else:
        bureaus = registers.bureaus(spark)
        found = discovery.monthly_documents(pages.select("page_url", "html").join(bureaus, "page_url"))
        if o.command == "discover":
            for row in found.orderBy("source_id", "url").toJSON().toLocalIterator():
                sys.stdout.write(row + "\n")
            return
        offered = pages.join(bureaus, "page_url").select("source_id").distinct()
        manifests.require(manifests.discovery_gates(found, offered))
        files = workbooks.within(spark.read.parquet(o.files), F.octet_length("content"), "document_url").withColumn("sha256", F.sha2("content", 256))
        published = build.publish_snapshot(place, found, files, offered, o.min_facilities)["snapshot"]
        layer, result = "snapshot", "manifest"
    read = lambda name: sinks.stored(spark, published, name)
    if o.json:
        now, written = datetime.now(UTC).isoformat(timespec="seconds"), {n: read(n) for n in sinks.tables_of(spark, published)}
        if layer == "snapshot":
            static.export_snapshot(written, bureaus, o.json, now)
        else:
            documents = found.drop("bureau_name").join(registers.bureaus(spark).select("source_id", "bureau_name"), "source_id", "left")
            static.export_changes(written, documents, str(base), o.json, now)
    sys.stdout.write(sinks.one_json(read(result)))


if __name__ == "__main__":
    main()
