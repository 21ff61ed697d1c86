"""Finding the newest documents on source pages, and change notices after a base date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sakuin.functions import dates, links, text
from sakuin.operators import merge
from sakuin.sources.html import page_links


def latest_only(candidates: DataFrame, page_dates: DataFrame | None = None) -> DataFrame:
    """Candidates of each source's latest date; undated ones count as latest. page_dates (source_id, page_as_of) dates sources whose
    candidates have no date at all. A maximum and a join, so a source with very many candidates is no single window."""
    latest = candidates.groupBy("source_id").agg(F.max("as_of").alias("latest"))
    if page_dates is not None:
        latest = latest.join(page_dates, "source_id", "left").select("source_id", F.coalesce("latest", "page_as_of").alias("latest"))
    dated = candidates.join(latest, "source_id")
    return dated.where(F.coalesce("as_of", "latest") == F.col("latest")).drop("as_of").withColumnRenamed("latest", "as_of")


def _dated(found: DataFrame, extract) -> DataFrame:
    """Links with normalised texts and the latest date that an element's own text gave at or above them."""
    own = F.transform(F.reverse(F.transform("own_norm", extract)), dates.max_date)
    found = found.withColumn("own_norm", F.split(text.normalize_text(F.array_join("own_texts", "\u0001")), "\u0001"))
    found = found.withColumn("own_date", F.get(F.filter(own, lambda d: d.isNotNull()), F.lit(0)))
    window = Window.partitionBy("source_id", "page_url").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("current_date", F.last("own_date", ignorenulls=True).over(window))
    levels = F.transform(F.split(text.normalize_text(F.array_join("headings", "\u0001")), "\u0001"), text.squeeze)
    named = {"anchor": "anchor", "nearby": "row_text", "column": "column_text"}
    return found.withColumns({"levels": levels, **{k: text.normalize_text(F.col(v)) for k, v in named.items()}})


def _titles(levels) -> Column:
    return F.filter(levels, lambda x: x != "")


def monthly_documents(pages: DataFrame) -> DataFrame:
    """Newest list documents of each source.

    pages: source_id, bureau_name, page_url, target_section, excluded_section, html. A link counts if it is a workbook or archive on
    an allowed host and the headings and row around it say so. Sources without any date or link have no rows; gates catch them.
    """
    found = page_links(pages).join(pages.drop("html"), "page_url")
    found = _dated(found, dates.as_of_dates)
    page_dates = found.groupBy("source_id").agg(F.max("own_date").alias("page_as_of"))
    titles = F.array_join(_titles(F.col("levels")), " / ")
    section = F.array_join(_titles(F.slice("levels", 2, 5)), " / ")
    context = text.squeeze(F.concat_ws(" / ", titles, "nearby", "anchor"))
    good = found.where(links.is_workbook(F.col("href")) & links.is_allowed(F.col("url"))).withColumns({"context": context, "section": F.concat_ws(" ", section, "nearby")})
    good = good.where(F.expr("context rlike target_section and not section rlike excluded_section"))
    category = F.coalesce(text.category(F.concat_ws(" ", "anchor", "url")), text.category(F.col("nearby")))
    rows = good.select("source_id", "bureau_name", "page_url", "url", F.col("current_date").alias("as_of"), "context", category.alias("category"), "ord", F.lit("upsert").alias("action"))
    return merge.documents(latest_only(rows, page_dates)).drop("action")


def change_documents(pages: DataFrame, base_as_of) -> DataFrame:
    """Change notices published after the base date.

    pages: source_id, bureau_name, page_url, prefecture_code_hint, document_url_pattern, document_context_pattern, html.
    """
    base = F.lit(base_as_of).cast("date")
    found = _dated(page_links(pages).join(pages.drop("html"), "page_url"), dates.dates_in_text)
    page_dates = found.groupBy("page_url").agg(F.max("own_date").alias("page_date"))
    row_dates = F.transform(F.split(text.normalize_text(F.array_join("row_texts", "\u0001")), "\u0001"), lambda x: dates.max_date(dates.dates_in_text(x)))
    in_row = F.filter("row_links", links.is_notice)
    order = F.size(F.filter(F.slice("row_links", 1, F.greatest(F.col("row_index"), F.lit(0))), links.is_notice))
    named = links.category_from_url(F.col("url"))
    placed = F.when((F.size(in_row) == 4) & (order < 3), F.get(F.array(F.lit("medical"), F.lit("dental"), F.lit("pharmacy")), order))
    context = text.squeeze(F.concat_ws(" / ", F.array_join(_titles(F.col("levels")), " / "), "column", "nearby", "anchor"))
    good = found.where(links.is_notice(F.col("url")) & links.is_allowed(F.col("url"))).withColumns({"context": context, "named": named, "row_date": F.get(F.filter(row_dates, lambda d: d.isNotNull()), F.lit(0)), "placed": placed, "fourth": (F.size(in_row) == 4) & (order == 3)})
    deepest = F.coalesce(F.try_element_at(_titles(F.col("levels")), F.lit(-1)), F.lit(""))
    good = good.where(~(F.col("named").isNull() & F.col("fourth")) & ~deepest.rlike("訪看|訪問看護") & ~links.before_base_month(F.col("url"), base))
    good = good.where("(document_url_pattern is null or url rlike document_url_pattern) and (document_context_pattern is null or context rlike document_context_pattern)")
    heading = F.get(F.filter(F.transform(F.reverse("levels"), text.category), lambda c: c.isNotNull()), F.lit(0))
    category = F.coalesce("named", "placed", text.category(F.col("column")), heading, text.category(F.col("nearby")))
    good = good.withColumn("category", category).where(F.col("category").isNotNull() & ~F.concat_ws(" ", "column", "anchor").rlike(links.EXCLUDED))
    near = dates.max_date(dates.dates_in_text(F.col("nearby")))
    published = F.coalesce(near, "row_date", F.call_function("try_to_date", links.date_from_url(F.col("url"))), "current_date", "page_date")
    good = good.join(page_dates, "page_url").withColumn("published_at", published).where(F.col("published_at") > base)
    action = links.action(F.col("anchor"), F.col("url"), F.col("nearby"), F.col("context"))
    prefecture = F.coalesce(links.prefecture_from_url(F.col("url")), "prefecture_code_hint")
    rows = good.select("source_id", "bureau_name", "page_url", "url", "published_at", "context", "category", "ord", action.alias("action"), prefecture.alias("prefecture_code_hint"))
    return merge.documents(rows)
