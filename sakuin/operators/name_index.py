"""Substring search by lists of character runs.

Every normalised name is listed under each run of one, two and three characters that it holds. A name that holds a query holds all its
runs, so the rarest runs' lists, intersected, leave few names to look at; the names themselves then decide. Lists are rows, dealt to parts
by run and sorted, so a query opens the parts of its runs and no list ever comes into one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RUN = 3
PARTS = 64
PICKED = 2  # lists that are intersected for a query


def runs(value: Column, size: Column | int) -> Column:
    """Distinct runs of so many characters; none if there are fewer."""
    size = F.lit(size) if isinstance(size, int) else size
    places = F.sequence(F.lit(1), F.length(value) - size + 1)
    return F.when(F.length(value) >= size, F.array_distinct(F.transform(places, lambda i: F.substring(value, i, size)))).otherwise(F.array().cast("array<string>"))


def part_of(run: Column) -> Column:
    return F.pmod(F.xxhash64(run), F.lit(PARTS)).cast("int")


def lists(index: DataFrame) -> DataFrame:
    """(part, run, code) of a search index (code, name_norm)."""
    every = F.array_union(F.array_union(runs(F.col("name_norm"), 1), runs(F.col("name_norm"), 2)), runs(F.col("name_norm"), RUN))
    rows = index.where("name_norm <> ''").select("code", F.explode(every).alias("run"))
    return rows.select(part_of(F.col("run")).alias("part"), "run", "code")


def lengths(listed: DataFrame) -> DataFrame:
    """(part, run, n): how long each list is."""
    return listed.groupBy("part", "run").agg(F.count("*").alias("n"))


def picked(queries: DataFrame, sizes: DataFrame) -> DataFrame:
    """(query, part, run, wanted): the shortest lists for each normalised query, and how many these are. A query with a run that no name holds
    has none."""
    asked = queries.where("query <> ''").select("query").distinct()
    asked = asked.select("query", F.explode(runs(F.col("query"), F.least(F.length("query"), F.lit(RUN)))).alias("run")).withColumn("part", part_of(F.col("run")))
    known = asked.join(sizes, ["part", "run"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    own = Window.partitionBy("query")
    first = known.withColumns({"place": F.row_number().over(own.orderBy("n", "run")), "least": F.min("n").over(own)})
    return first.where((F.col("place") <= PICKED) & (F.col("least") > 0)).select("query", "part", "run", F.count("*").over(own).alias("wanted"))


def found(queries: DataFrame, listed: DataFrame, sizes: DataFrame, index: DataFrame) -> DataFrame:
    """Rows of the index with the query that their names hold. queries: query (normalised); an empty one finds nothing, and repeated
    ones count once."""
    asked = picked(queries, sizes)
    hits = listed.join(asked, ["part", "run"]).groupBy("query", "code").agg(F.count("*").alias("n"), F.max("wanted").alias("wanted")).where("n = wanted")
    return index.join(hits.select("query", "code"), "code").where(F.contains("name_norm", "query")).select("query", *index.columns)


def overlaid(queries: DataFrame, base: tuple[DataFrame, DataFrame, DataFrame], changes: tuple[DataFrame, DataFrame, DataFrame]) -> DataFrame:
    """found over a snapshot and its changes, each given as lists, lengths and index: a changed facility counts with its new name only."""
    old = found(queries, *base).join(changes[2].select("code"), "code", "left_anti")
    return old.unionByName(found(queries, *changes).select(*old.columns))
