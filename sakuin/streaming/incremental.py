"""Replay of change events that keeps its state between batches and touches only what a batch is about.

An event takes away entries of its id or of its non-empty abbreviation that came before it, so what holds follows from two maxima for each
code: the latest event of each id, and the latest of each abbreviation (in order of publication, removals first, then id). Maxima don't
depend on how events are split into batches: late and re-sent events change nothing that they shouldn't. The state is these marks, dealt
to buckets by code; a batch reads and rewrites the buckets of its codes, and a numbered file that names each bucket's folder commits it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sakuin.plans.files import Folder

BUCKETS = 256
_ORDER = ("code", "action", "published_at", "id")


def bucket_of(code: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(code.cast("string")), F.lit(buckets)).cast("int")


def marks_of(events: DataFrame) -> DataFrame:
    """(code, kind, key, last): the latest event of each id (kind `id`) and of each non-empty abbreviation (kind `name`). last: its
    publication, rank (0: removal), id and, for ids, all its other columns. Combined before the shuffle, so a code with very many events is
    no burden."""
    row = F.struct(*[c for c in events.columns if c not in _ORDER])
    rank = F.when(F.col("action") == "remove", 0).otherwise(1).alias("rank")
    last = lambda r: F.struct("published_at", rank, "id", r.alias("row"))
    key = lambda c: F.col(c).cast("string").alias("key")
    ids = events.select("code", F.lit("id").alias("kind"), key("standard_id"), last(row).alias("last"))
    names = events.where("abbreviation <> ''").select("code", F.lit("name").alias("kind"), key("abbreviation"), last(F.when(F.lit(False), row)).alias("last"))
    return _latest(ids.unionByName(names))


def _latest(marks: DataFrame) -> DataFrame:
    return marks.groupBy("code", "kind", "key").agg(F.max("last").alias("last"))


def held(base: DataFrame, marks: DataFrame) -> DataFrame:
    """Filings that hold: the base's columns with published_at and id of the event that added them (null: from the base), to be read
    in order of published_at, id, pos. base: code, pos, standard_id, abbreviation and more."""
    ids = marks.where("kind = 'id'").select(F.col("code").alias("c"), F.col("key").alias("k"), "last")
    names = marks.where("kind = 'name'").select(F.col("code").alias("c"), F.col("key").alias("k"), F.struct("last.published_at", "last.rank", "last.id").alias("name"))
    same = lambda d, c, k: (d["code"].eqNullSafe(F.col("c"))) & (k.cast("string").eqNullSafe(F.col("k")))
    kept = base.join(ids, same(base, "code", base["standard_id"]), "left_anti")
    kept = kept.join(names, same(kept, "code", kept["abbreviation"]), "left_anti")
    kind = {f.name: f.dataType for f in base.schema}
    row = marks.schema["last"].dataType["row"].dataType.names
    added = marks.where("kind = 'id' and last.rank = 1")
    value = lambda c: F.col("code") if c == "code" else F.col(f"last.row.{c}").cast(kind[c]) if c in row else F.lit(0 if c == "pos" else None).cast(kind[c])
    added = added.select(*[value(c).alias(c) for c in base.columns], "last.published_at", "last.id", F.struct("last.published_at", "last.rank", "last.id").alias("own"))
    added = added.join(names, same(added, "code", added["abbreviation"]), "left").where("name is null or own >= name")
    none = [F.lit(None).cast(added.schema[c].dataType).alias(c) for c in ("published_at", "id")]
    return kept.select(*base.columns, *none).unionByName(added.select(*base.columns, "published_at", "id"))


class ReplayState:
    """Marks of all events so far, below a folder. keep: versions whose files stay, for readers that have begun."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, keep: int = 3):
        self.spark, self.path, self.buckets, self.keep, self._folder = spark, path.rstrip("/"), buckets, max(1, keep), Folder(spark, path)

    def version(self) -> tuple[int, dict]:
        """Number of the newest version, and what it says: buckets (the folder of each), schema of the marks, and batch."""
        names = self._folder.names("versions")
        return (int(names[-1].removesuffix(".json")), json.loads(self._folder.read(f"versions/{names[-1]}"))) if names else (0, {"buckets": {}, "schema": None, "batch": None})

    def _read(self, version: dict, wanted: set[int] | None = None) -> DataFrame | None:
        """Marks of some buckets, or of all; None where there are none yet."""
        paths = [f"{self.path}/data/{folder}/bucket={b}" for b, folder in version["buckets"].items() if wanted is None or int(b) in wanted]
        if not version["schema"]:
            return None
        schema = StructType.fromJson(version["schema"])
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def merge(self, events: DataFrame, batch: int | None = None) -> int:
        """Take a batch in and return the version that has it. Only buckets with codes of the batch are read and written. Of two merges that
        saw the same version one commits; the other merges anew with what has come."""
        fresh = marks_of(events).withColumn("bucket", bucket_of(F.col("code"), self.buckets)).persist()
        try:
            touched = {r[0] for r in fresh.select("bucket").distinct().collect()}  # at most as many as there are buckets
            while True:
                number, now = self.version()
                if not touched:
                    return number
                old = self._read(now, touched)
                rows = fresh if old is None else _latest(fresh.drop("bucket").unionByName(old)).withColumn("bucket", bucket_of(F.col("code"), self.buckets))
                folder = uuid.uuid4().hex
                rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "code").write.partitionBy("bucket").parquet(f"{self.path}/data/{folder}")
                schema = now["schema"] or json.loads(fresh.drop("bucket").schema.json())
                content = {"buckets": {**now["buckets"], **{str(b): folder for b in touched}}, "schema": schema, "batch": batch}
                if self._folder.create(f"versions/{number + 1:020d}.json", json.dumps(content)):
                    self._retire(number + 1)
                    return number + 1
                self._folder.remove(f"data/{folder}")
        finally:
            fresh.unpersist()

    def clear(self) -> int:
        """Forget all events, as a new snapshot asks."""
        while True:
            number, now = self.version()
            if self._folder.create(f"versions/{number + 1:020d}.json", json.dumps({**now, "buckets": {}, "batch": None})):
                self._retire(number + 1)
                return number + 1

    def _retire(self, number: int) -> None:
        log = {int(n.removesuffix(".json")): json.loads(self._folder.read(f"versions/{n}")) for n in self._folder.names("versions")}
        kept = {x for k, v in log.items() if k > number - self.keep for x in v["buckets"].items()}
        for k, v in sorted(log.items()):
            if k <= number - self.keep:
                for b, folder in set(v["buckets"].items()) - kept:
                    self._folder.remove(f"data/{folder}/bucket={b}")
                self._folder.remove(f"versions/{k:020d}.json")

    def current(self, base: DataFrame, codes: DataFrame | None = None) -> DataFrame:
        """Filings that hold now (see held), of all codes or of a table of codes; then only their buckets are read."""
        version = self.version()[1]
        if codes is None:
            marks = self._read(version)
        else:
            base = base.join(codes.select("code").distinct(), "code", "left_semi")
            asked = {r[0] for r in codes.select(bucket_of(F.col("code"), self.buckets)).distinct().collect()}
            marks = self._read(version, asked)
            marks = marks if marks is None else marks.join(codes.select("code").distinct(), "code", "left_semi")
        if marks is None:
            return base.withColumns({"published_at": F.lit(None).cast("date"), "id": F.lit(None).cast("string")})
        return held(base, marks)


def replay_stream(events: DataFrame, state: ReplayState, checkpoint: str) -> StreamingQuery:
    """Keep a state up to date from a stream of events. A micro-batch that is sent again after a failure changes nothing."""
    return events.writeStream.foreachBatch(lambda batch, number: state.merge(batch, number) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
