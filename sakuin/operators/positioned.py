"""Positioned page text to change events: lines, columns, record segments, acceptance lines."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sakuin.functions import codes, dates, text
from sakuin.operators.sheets import names_in
from sakuin.operators.tables import dealt, kept


def segments(rows: DataFrame, partition: list[str], order: str, starts: Column, name: str) -> DataFrame:
    """Add the number of starts at or before each row; rows before the first are in segment 0."""
    window = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.sum(F.when(starts, 1).otherwise(0)).over(window).cast("long"))


# How far a line's items may lie below its first, how sure a recognised word must be, and how far from an acceptance
# line of a scanned page its date may lie.
LINE_GAP = 1.5
CONFIDENCE = 25
DATE_REACH = 20
PAGE = ["document_url", "page"]

# Default columns of scanned pages, as (code, name, address, address end, content, content end).
SCANNED = {"remove": (65.0, 135.0, 225.0, 370.0, 485.0, 580.0), "upsert": (25.0, 100.0, 220.0, 350.0, 380.0, None)}
_ITEM = {"document_url": "string", "page": "int", "x": "double", "y": "double", "text": "string", "ord": "int"}
_LINE_OF = ", ".join(f"{c} {t}" for c, t in _ITEM.items()) + ", line int, line_y double"


def lines(items: DataFrame) -> DataFrame:
    """Add line and line_y: items within 1.5 of the first item's y are one line. The first item is what counts, so this walks each
    page once, in order of y: pages are dealt to tasks, and a task's pages stream by in batches."""

    def walk(batches):
        seen, number, first = (), -1, None
        for batch in batches:
            at = []
            for url, page, y in zip(batch["document_url"].to_pylist(), batch["page"].to_pylist(), batch["y"].to_numpy(zero_copy_only=False).tolist(), strict=True):
                if (url, page) != seen:
                    seen, number, first = (url, page), -1, None
                if first is None or abs(y - first) > LINE_GAP:
                    number, first = number + 1, y
                at.append((number, first))
            more = [pa.array([a[0] for a in at], pa.int32()), pa.array([a[1] for a in at], pa.float64(), from_pandas=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*_ITEM, "line", "line_y"])

    rows = items.select(*[F.col(c).cast(t).alias(c) for c, t in _ITEM.items()]).repartition(*PAGE)
    return rows.sortWithinPartitions(*PAGE, F.asc_nulls_last("y"), "x").mapInArrow(walk, _LINE_OF)


def recognised(items: DataFrame) -> DataFrame:
    """Words that optical recognition is sure enough of, with its look-alikes replaced; text of other pages as it is. items may have
    a column confidence (0 to 100; null and absent: sure)."""
    if "confidence" in items.columns:
        items = items.where(~F.coalesce("ocr", F.lit(False)) | (F.coalesce(F.col("confidence"), F.lit(100)) >= CONFIDENCE)).drop("confidence")
    return items.withColumn("text", F.when(F.col("ocr"), text.ocr_text(F.col("text"))).otherwise(F.col("text")))


def columns(items: DataFrame) -> DataFrame:
    """Column positions of each page by its headers, or the defaults of scanned pages; pages without either have no row.

    items: PAGE, ord, x, y, norm (normalised text), action, ocr.
    """
    packed = text.compact(F.col("norm"))

    def header(pattern: str, what: str = "x") -> Column:
        return F.min_by(what, F.when(packed.rlike(pattern), F.col("ord")))

    # Header texts of the notices, and how far from a header its column's text may begin or end.
    heads = items.groupBy(*PAGE).agg(
        F.first("action").alias("action"), F.first("ocr").alias("ocr"),
        *[header(p, w).alias(f"{n}_{w}") for n, p in (("code", "^(?:医療機関|薬局)(?:番号|コード)\\z"), ("name", "^(?:医療機関|薬局)?名称\\z"), ("address", "^(?:医療機関|薬局)?所在地\\z")) for w in ("x", "y")],
        header("^(?:失効|辞退)内容\\z").alias("content_x"), header("^(?:失効|辞退)事由\\z").alias("reason_x"), header("^開設者氏名\\z").alias("owner_x"), header("^病床数\\z").alias("beds_x"),
    )
    body = items.join(heads.select(*PAGE, F.greatest("code_y", "name_y", "address_y").alias("head_y"), F.col("address_x").alias("ax")), PAGE)
    body = body.where((F.col("y") > F.col("head_y") + 5) & (F.col("x") > F.col("ax") + 70) & ~packed.rlike("^(?:算定開始年月日|〒|[0-9]+\\z)") & ~packed.rlike("受理内容|届出内容"))
    heads = heads.join(body.groupBy(*PAGE).agg(F.min("x").alias("first_x")), PAGE, "left")
    remove = F.col("action") == "remove"
    complete = F.col("code_x").isNotNull() & F.col("name_x").isNotNull() & F.col("address_x").isNotNull() & F.when(remove, F.col("content_x").isNotNull()).otherwise(F.col("first_x").isNotNull())
    end = F.when(remove, F.coalesce(F.col("owner_x") - 30, F.col("content_x") - 5)).otherwise(F.coalesce("beds_x", "first_x") - 5)
    found = [F.col("code_x"), F.col("name_x") - 18, F.col("address_x") - 25, end, F.when(remove, F.col("content_x") - 25).otherwise(F.col("first_x")), F.when(remove, F.col("reason_x"))]
    names = ("c_code", "c_name", "c_address", "c_address_end", "c_content", "c_content_end")
    scanned = [F.when(remove, F.lit(a)).otherwise(F.lit(b)).cast("double") for a, b in zip(SCANNED["remove"], SCANNED["upsert"], strict=True)]
    return heads.where(complete | F.col("ocr")).select(*PAGE, *[F.when(complete, a).otherwise(b).alias(n) for a, b, n in zip(found, scanned, names, strict=True)])


def change_events(items: DataFrame, documents: DataFrame, prefectures: list[tuple[str, str]]) -> tuple[DataFrame, DataFrame]:
    """(events, pages) of positioned text.

    items: document_url, page, x, y, text, ocr and perhaps confidence; documents: document_url, sha256, source_id, page_url, published_at, action,
    category_hint, prefecture_code_hint, context. events has one row per change with its facility; pages has accepted and parsed
    counts. Records without a name have no events. Items, lines, pages and lines of records are read by many parts, so they are tables.
    """
    items = recognised(items).withColumn("ord", F.row_number().over(Window.partitionBy(*PAGE).orderBy("y", "x", "text"))).withColumn("norm", text.normalize_text(F.col("text")))
    meta = documents.withColumnRenamed("sha256", "document_sha256")
    items = kept(items.join(meta.select("document_url", "action"), "document_url"))
    where = columns(items)
    ocr = items.groupBy(*PAGE).agg(F.max("ocr").alias("ocr"))
    placed = lines(items.withColumn("text", F.col("norm"))).withColumnRenamed("text", "norm").join(where, PAGE)

    def joined(condition: Column, value: str = "norm") -> Column:
        found = F.array_sort(F.collect_list(F.when(condition, F.struct("x", "ord", F.col(value).alias("t")))))
        return F.array_join(F.transform(found, lambda s: s["t"]), " ")

    not_number = ~F.col("norm").rlike("^[0-9]+\\z")
    is_code = (F.col("x") < F.col("c_name") - 15) & (F.abs(F.col("x") - F.col("c_code")) < 35) & codes.printed_code(F.col("norm")).isNotNull()
    in_content = (F.col("x") >= F.col("c_content") - 5) & (F.col("c_content_end").isNull() | (F.col("x") < F.col("c_content_end") - 5))
    line = kept(placed.groupBy(*PAGE, "line").agg(
        F.first("line_y").alias("y"), joined(F.lit(True)).alias("full"), joined(in_content).alias("content"), F.min(F.when(in_content, F.col("x"))).alias("min_x"), F.first("c_content").alias("c_content"),
        F.min_by(codes.printed_code(F.col("norm")), F.when(is_code, F.col("x"))).alias("code"),
        joined((F.col("x") >= F.col("c_name")) & (F.col("x") < F.col("c_address")) & not_number).alias("name_part"), joined((F.col("x") >= F.col("c_address")) & (F.col("x") < F.col("c_address_end")) & not_number).alias("address_part"),
    ))
    pages = line.groupBy(*PAGE).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "full"))), lambda s: s["full"]), " ").alias("all")).join(meta, "document_url").join(ocr, PAGE)
    pages = dealt(pages, *reversed(PAGE)).withColumn("norm_context", text.normalize_text(F.col("context")))
    context = text.squeeze(F.concat_ws(" ", "norm_context", "all"))
    names = F.array(*[F.struct(F.lit(c).alias("code"), F.lit(n).alias("name")) for c, n in prefectures])
    hits = names_in(context, names)
    pages = kept(pages.withColumns({"category": F.coalesce(text.category(context), "category_hint"), "prefecture_code": F.when(F.size(hits) == 1, F.get(hits, F.lit(0))).otherwise(F.col("prefecture_code_hint"))}).drop("all", "context", "norm_context"))
    pages = pages.where("category is not null and prefecture_code is not null")

    rows = kept(segments(line, PAGE, "line", F.col("code").isNotNull(), "record").where("record > 0").join(pages, PAGE))
    key = [*PAGE, "record"]
    by_line = lambda c: F.array_join(F.filter(F.transform(F.array_sort(F.collect_list(F.struct("line", c))), lambda s: s[c]), lambda t: t != ""), " ")
    head = rows.groupBy(*key).agg(F.min_by("code", "line").alias("code"), by_line("name_part").alias("name"), by_line("address_part").alias("address"), F.first("ocr").alias("ocr"), F.first("category").alias("category"), F.first("prefecture_code").alias("prefecture_code"))
    head = head.select(*key, F.coalesce("code.full_code", codes.full_code(F.col("prefecture_code"), F.col("category"), F.col("code.local_code"))).alias("code"), F.when(F.col("ocr"), F.regexp_replace("name", "[\\s|_]+", "")).otherwise(F.col("name")).alias("name"), text.clean_address(F.col("address")).alias("address"), "category")

    gone = rows.where("action = 'remove'").withColumn("abbreviation", F.regexp_replace("content", f"{text.WHITE}+", ""))
    gone = gone.where((F.col("abbreviation") != "") & ~text.compact(F.col("abbreviation")).rlike("^(?:失効|辞退)内容\\z"))
    gone = gone.select(*key, "line", "abbreviation", F.lit(None).cast("string").alias("standard_name"), F.lit("").alias("acceptance_number"), dates.max_date(dates.dates_in_text(F.col("full"))).alias("effective_from"))

    added = rows.where("action = 'upsert'").withColumn("accepted", text.acceptance(F.col("content")))
    # A line belongs to the next acceptance line of its record; that line itself ends the stretch.
    after = Window.partitionBy(*key).orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    added = added.withColumn("part", F.coalesce(F.sum(F.col("accepted").isNotNull().cast("int")).over(after), F.lit(0)))
    part = [*key, "part"]
    is_name = F.col("accepted").isNull() & (F.col("min_x") <= F.col("c_content") + 22) & text.is_standard_name(F.col("content"))
    named = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(is_name, F.struct("line", "content")))), lambda s: s["content"]), "")
    stretch = added.groupBy(*part).agg(named.alias("standard_name"), F.max_by(F.struct("line", "y", "accepted", "full", "ocr"), F.when(F.col("accepted").isNotNull(), F.col("line"))).alias("a")).where("a is not null")
    near = stretch.select(*part, F.col("a.y").alias("ay")).join(added.select(*key, "y", "full"), key).where(f"abs(y - ay) <= {DATE_REACH}").groupBy(*part).agg(F.max(dates.max_date(dates.dates_in_text(F.col("full")))).alias("near_date"))
    squash = lambda c: F.when(F.col("a.ocr"), F.regexp_replace(c, f"{text.WHITE}+", "")).otherwise(c)
    added = stretch.join(near, part, "left").select(*key, F.col("a.line").alias("line"), F.nullif(squash(F.col("a.accepted.abbreviation")), F.lit("")).alias("abbreviation"), F.nullif(squash(F.col("standard_name")), F.lit("")).alias("standard_name"), F.col("a.accepted.acceptance_number").alias("acceptance_number"), F.when(F.col("a.ocr"), F.col("near_date")).otherwise(dates.max_date(dates.dates_in_text(F.col("a.full")))).alias("effective_from"))

    both = gone.unionByName(added)
    counts = both.groupBy(*PAGE).agg(F.count("*").alias("accepted"))
    events = both.join(head.where("name <> ''"), key).join(pages.select(*PAGE, "action", "published_at", "source_id", "page_url", "document_sha256", "ocr"), PAGE)
    effective = F.date_format("effective_from", "yyyy-MM-dd")
    events = events.withColumns({
        "id": codes.event_id(F.col("document_sha256"), F.col("page"), F.col("code"), F.col("action"), F.col("abbreviation"), F.col("standard_name"), F.col("acceptance_number"), effective),
        "standard_id": codes.standard_id(F.col("abbreviation"), F.col("standard_name")), "extraction_method": F.when(F.col("ocr"), "ocr").otherwise("text"),
    }).drop("ocr", "record")
    parsed = events.groupBy(*PAGE).agg(F.count("*").alias("parsed"))
    zero = F.lit(0).cast("long")
    tally = ocr.join(counts, PAGE, "left").join(parsed, PAGE, "left").select(*PAGE, "ocr", F.coalesce("accepted", zero).alias("accepted"), F.coalesce("parsed", zero).alias("parsed"))
    return events, tally
