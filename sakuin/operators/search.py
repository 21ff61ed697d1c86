"""Ranked name search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def matches(index: DataFrame, query: str) -> DataFrame:
    """Rows of (code, name, name_norm, ...) whose normalised name holds the normalised query; an empty query has no matches."""
    return index.where(F.col("name_norm").contains(query)) if query else index.limit(0)


def name_order(collation: str | None = "ja") -> Column:
    name = F.coalesce("standard_name", "abbreviation", F.lit(""))
    return F.collate(name, collation) if collation else name


def name_key(name: str, collation: str | None = "ja") -> Column:
    """A name that sorts in Japanese order wherever columns are compared: sorts, windows, ranges and arrays. Not for keys of groups and
    joins, since names that differ in script alone are equal in that order."""
    return F.collate(F.coalesce(name, F.lit("")), collation) if collation else F.coalesce(name, F.lit(""))


def in_order(row: Column, name: str, *keys: str, collation: str | None = "ja") -> Column:
    """Aggregate: the rows of a group as an array in Japanese order of a name, then by keys. For groups that fit a row of a sink."""
    listed = F.array_sort(F.collect_list(F.struct(name_key(name, collation).alias("_name"), *[F.col(k).alias(f"_{k}") for k in keys], row.alias("_row"))))
    return F.transform(listed, lambda s: s["_row"])


def by_name(filings: DataFrame, *keys: str, collation: str | None = "ja") -> DataFrame:
    """Filings in Japanese order of their names (abbreviations where they have none), then by keys."""
    return filings.orderBy(name_order(collation), *keys)


def ranked(found: DataFrame, query: str, limit: int, collation: str | None = "ja") -> DataFrame:
    """Names that begin with the query first, then by name; one pass that keeps `limit` rows a task."""
    name = F.collate(F.col("name"), collation) if collation else F.col("name")
    return found.orderBy(~F.col("name_norm").startswith(query), name, "code").limit(limit)
