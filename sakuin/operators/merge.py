"""Merging rows into one record per code: longest name, first address, latest date, distinct filings and sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sakuin.functions.codes import PREFIX, standard_id
from sakuin.functions.text import utf16_length
from sakuin.operators.tables import kept


def longest(value: Column, order: Column) -> Column:
    """The longest value by UTF-16 units, the first in order (any type) among equals."""
    return F.min_by(value, F.when(value.isNotNull(), F.struct(-utf16_length(value), order)))


def first_value(value: Column, order: Column) -> Column:
    """The first value that isn't null."""
    return F.min_by(value, F.when(value.isNotNull(), order))


def merge_facilities(rows: DataFrame) -> DataFrame:
    """One row per code from (code, ord, name, address, category, prefecture_code, local_code, as_of). All aggregates combine
    before the shuffle, so a code with very many rows is no burden."""
    order = F.col("ord")
    return rows.groupBy("code").agg(
        longest(F.col("name"), order).alias("name"), first_value(F.col("address"), order).alias("address"), F.max("as_of").alias("as_of"),
        *[F.min_by(c, order).alias(c) for c in ("category", "prefecture_code", "local_code")],
    )


FILING = ("abbreviation", "standard_name", "acceptance_number", "effective_from")


def distinct_filings(rows: DataFrame, keep_first_row: bool = True, by: tuple[str, ...] = ("code",)) -> DataFrame:
    """Distinct filings of each code (or of other keys), null and empty alike, in order. rows: the keys, ord (of the sheet row), pos
    (within it) and the filing. With keep_first_row, filings that repeat within a key's first row stay, as published registers have them; all
    rows are dealt once by their keys then, a key's distinct filings are folded as its rows stream by, and rows without ord are left out."""
    keys = {f"k_{c}": F.coalesce(F.col(c).cast("string"), F.lit("")) for c in FILING}
    least = F.min(F.struct("ord", "pos", *FILING)).alias("f")
    if not keep_first_row:
        return rows.withColumns(keys).groupBy(*by, *keys).agg(least).select(*by, "f.*")
    rows = rows.select(*by, "ord", "pos", *FILING).where("ord is not null")
    joined = rows.join(rows.groupBy(*by).agg(F.min("ord").alias("first")).hint("shuffle_hash"), list(by))
    kept = joined.where("ord <= first").drop("first")  # not by equality, which would be a key of the join and deal the rows a second time
    later = joined.withColumns(keys).groupBy(*by, "first", *keys).agg(least).where("f.ord > first").select(*by, "f.*")
    return kept.unionByName(later)


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """Rows with pos, their place (from 0) in their code's order; a column `pos` of before is replaced.

    Rows are dealt by ranges of code and order and sorted within them, so a code with very many rows lies in as many ranges as it needs and
    is no one task's; places within a range start after what the code's earlier ranges hold. Rows that are equal in order, and codes that
    are null, are numbered in any order.
    """
    ranged = kept(rows.repartitionByRange("code", *order).sortWithinPartitions("code", *order).withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)))
    heads = ranged.groupBy("code", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))  # a row for each code and range
    earlier = F.sum("n").over(Window.partitionBy("code").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    heads = heads.select(F.col("code").alias("c"), F.col("part").alias("p"), "first", F.coalesce(earlier, F.lit(0)).alias("before"))
    numbered = ranged.join(heads, ranged["code"].eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")))
    return numbered.withColumn("pos", (F.col("at") - F.col("first") + F.col("before")).cast("int")).drop("at", "part", "c", "p", "first", "before")


def distinct_sources(rows: DataFrame) -> DataFrame:
    """First row of each (code, document_sha256, workbook, worksheet)."""
    others = [c for c in rows.columns if c not in ("code", "document_sha256", "workbook", "worksheet")]
    return rows.groupBy("code", "document_sha256", "workbook", "worksheet").agg(*[F.min_by(c, "ord").alias(c) for c in others])


def catalog(filings: DataFrame) -> DataFrame:
    """Dictionary (standard_id, abbreviation, standard_name) of distinct filings; a key of two different pairs raises an error."""
    pairs = filings.select("abbreviation", "standard_name").distinct().withColumn("standard_id", standard_id(F.col("abbreviation"), F.col("standard_name")))
    checked = pairs.groupBy("standard_id").agg(F.count("*").alias("n"), F.first("abbreviation").alias("abbreviation"), F.first("standard_name").alias("standard_name"))
    guard = F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("key collision: "), F.col("standard_id"))).cast("string")).otherwise(F.col("standard_id"))
    return checked.select(guard.alias("standard_id"), "abbreviation", "standard_name")


def documents(candidates: DataFrame) -> DataFrame:
    """One row per url from (url, ord, category, action, ...): the first row stands, a missing category is filled from later
    ones, and `remove` of any row holds."""
    order = F.col("ord")
    others = [c for c in candidates.columns if c not in ("url", "ord", "category", "action")]
    sticky = F.when(F.max((F.col("action") == "remove").cast("int")) == 1, "remove").otherwise("upsert")
    return candidates.groupBy("url").agg(first_value(F.col("category"), order).alias("category"), sticky.alias("action"), *[F.min_by(c, order).alias(c) for c in others])


def shards(facilities: DataFrame) -> DataFrame:
    """Per prefix of the code: number of facilities and latest date."""
    return facilities.groupBy(F.substring("code", 1, PREFIX).alias("prefix")).agg(F.count("*").alias("n"), F.max("as_of").alias("as_of"))
