"""Corpus preparation in five stages: language, near duplicates, repeated passages, benchmark passages, packing."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sakuin.llm import decontamination, jaccard_join, language_id, packing, suffix_dedup
from sakuin.llm.shared import durable, fold, forget


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or that no learned language fits, go. The network learns from the same rows as op1.

    A language fits at the score that the network's own held-out windows give (see language_id.train). Null and empty texts go;
    repeated rows are judged alike; an empty table stays empty; columns named like the judgement, in
    whatever case, keep their own names and values.
    """
    model = language_id.train(docs.where(fold(F.col("doc_id"), 4) != 2))
    aside = {c: _fresh(c, docs) if c.lower() in ("lang_pred", "score") else c for c in docs.columns}
    plain = docs.select(*[F.col(c).alias(n) for c, n in aside.items()])
    kept = language_id.identify(plain, model).where((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= model.least))
    return kept.select(*[F.col(n).alias(c) for c, n in aside.items()])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that link at a Jaccard similarity of 0.75 over five-word shingles, the one with the smallest doc_id stays.

    Texts without words and rows without doc_id link with nothing and stay. Rows with one doc_id stay or go together, so of copies
    under one id all stay. An empty table stays empty; other columns are kept whatever their names.
    """
    groups = jaccard_join.similar_groups(docs)
    out = groups.where("component_id <> doc_id").select(F.col("doc_id").alias(_fresh("out", docs))).distinct()
    return docs.join(out, docs["doc_id"] == out[out.columns[0]], "left_anti").select(docs.columns)


def _fresh(name: str, docs: DataFrame) -> str:
    """A column name that docs don't have."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of 50-byte strings that start in an earlier document too are cut out; a text of which no word is left goes.

    Null, empty and blank texts go. Texts under one doc_id are cut each for itself; rows without doc_id stay whole. n_chars follows
    the text where it is there. An empty table stays empty; other columns are kept whatever their names.
    """
    base, _, table, marks = suffix_dedup.repeats(docs)
    forget(spark, table)
    copies = base.where("whole").groupBy(F.col("doc_id").alias("id")).agg(F.collect_set("tag").alias("copies"))
    columns = docs.columns
    key, found, whole = (_fresh(c, docs) for c in ("id", "marks", "whole"))
    text = F.coalesce(docs["text"], F.lit(""))
    state = marks.join(copies, "id", "full_outer").select(F.col("id").alias(key), F.col("marks").alias(found), F.col("copies").alias(whole))
    own = suffix_dedup.own_marks(F.col(found), text), F.coalesce(F.array_contains(whole, F.xxhash64(text)), F.lit(False))

    def cut(batches):
        for batch in batches:
            cols = dict(zip(batch.schema.names, batch.columns, strict=True))
            kept = [suffix_dedup.cut_text(t, m, w) for t, m, w in zip(*(cols[c].to_pylist() for c in ("text", found, whole)), strict=True)]
            cols["text"] = pa.array(kept, pa.string())
            if "n_chars" in cols:
                cols["n_chars"] = pa.array([None if t is None else len(t) for t in kept], cols["n_chars"].type)
            yield pa.RecordBatch.from_arrays([cols[c] for c in columns], names=columns)

    joined = docs.join(state, docs["doc_id"] == state[key], "left").select(*[docs[c] for c in columns], own[0].alias(found), own[1].alias(whole))
    return joined.mapInArrow(cut, docs.schema).where(F.col("text").rlike("[^\\x20\\x09-\\x0D]"))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go, with all rows under their doc_id.

    Null and empty texts overlap nothing and stay. Of rows without doc_id all go if one of them overlaps. An empty table, or an
    empty benchmark, changes nothing; other columns are kept.
    """
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens: one row per piece with its place. Null text is empty and has one piece, as have repeated
    rows each for itself; an empty table gives no rows, and other columns are left out."""
    return packing.pack_documents(docs)


STAGES = [
    ("language", language_stage),
    ("near duplicates", near_duplicate_stage),
    ("repeated passages", passage_stage),
    ("benchmark", benchmark_stage),
    ("packing", packing_stage),
]

#: SQL has neither the learned network nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
