"""Replaying ordered change events over a snapshot, and the sources that back the result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def event_order(*keys: str) -> list[Column]:
    """Publication, removals before insertions, then id."""
    return [F.col("published_at"), F.when(F.col("action") == "remove", 0).otherwise(1), F.col("id"), *[F.col(k) for k in keys]]


def replay(base: DataFrame, events: DataFrame) -> DataFrame:
    """Filings that hold after all events.

    base: code, pos, standard_id, abbreviation and more; events: code, id, action, published_at, standard_id, abbreviation and more.
    Each event takes away entries of its id or of its non-empty abbreviation; an upsert then adds its own. So an entry holds if
    no later event has its id or abbreviation: two window maxima over one partitioning of code, whatever the order of rows.
    Result: the base's columns with seq (0: from the base), to be read in order of seq, pos.
    """
    numbered = events.withColumn("seq", F.row_number().over(Window.partitionBy("code").orderBy(*event_order())))
    columns = [c for c in base.columns if c in events.columns or c == "pos"]
    extra = [c for c in base.columns if c not in columns]
    left = base.select(*base.columns, F.lit("upsert").alias("action"), F.lit(0).alias("seq"))
    right = numbered.select(*[F.lit(0).cast(base.schema["pos"].dataType).alias("pos") if c == "pos" else F.lit(None).cast(base.schema[c].dataType).alias(c) if c in extra else F.col(c) for c in base.columns], "action", "seq")
    log = left.unionByName(right).repartition("code")
    by_id = F.max("seq").over(Window.partitionBy("code", "standard_id"))
    named = F.coalesce(F.col("abbreviation"), F.lit("")) != ""
    by_name = F.when(named, F.max("seq").over(Window.partitionBy("code", "abbreviation"))).otherwise(F.col("seq"))
    last = log.withColumns({"m_id": by_id, "m_name": by_name})
    return last.where("action <> 'remove' and seq = m_id and seq = m_name").drop("m_id", "m_name", "action")


def decode(standards: DataFrame, catalog: DataFrame) -> DataFrame:
    """Names for standard ids; unknown ids stay with null names. The dictionary is broadcast only while Spark knows it to be small."""
    return standards.join(catalog, "standard_id", "left")


def overlay_facilities(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """Facilities of either layer; the change layer's values win where they aren't null."""
    both = snapshot.alias("s").join(changes.alias("c"), F.col("s.code") == F.col("c.code"), "full_outer")
    return both.select(F.coalesce("s.code", "c.code").alias("code"), *[F.coalesce(f"c.{c}", f"s.{c}").alias(c) for c in ("name", "address", "category")])


def overlay_index(base: DataFrame, changes: DataFrame) -> DataFrame:
    """Search rows of the base that no change replaces, and all change rows."""
    return base.join(changes, "code", "left_anti").unionByName(changes)


_FACTS = {"published_at": "date", "page": "int", "extraction_method": "string"}


def provenance(snapshot: DataFrame, events: DataFrame) -> DataFrame:
    """(code, url) with its source, kind (0: snapshot, 1: change) and the facts of publication date, page and extraction method: an
    event's document overrides the snapshot's, the last event overrides earlier ones. Columns of facts may be missing."""
    facts = lambda df: [F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in _FACTS.items()]
    rows = snapshot.select("code", "url", "source_id", F.lit(0).alias("kind"), F.lit(0).alias("seq"), *facts(snapshot))
    numbered = events.withColumn("seq", F.row_number().over(Window.partitionBy("code").orderBy(*event_order())))
    rows = rows.unionByName(numbered.select("code", "url", "source_id", F.lit(1).alias("kind"), "seq", *facts(numbered)))
    last = F.max_by(F.struct("source_id", "kind", *_FACTS), F.struct("kind", "seq")).alias("last")
    return rows.groupBy("code", "url").agg(last).select("code", "url", "last.*")
