"""Learned verdicts on rows of the given tables that were not learned from."""

import os

import pytest
from pyspark.sql import functions as F

from sakuin.llm import language_id, quality_rules, url_filters
from sakuin.llm.shared import fold

SF = os.environ.get("ACCURACY_SF_DIR", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("lang is not null")
    held = fold(F.col("doc_id"), 4) == 2
    found = language_id.identify(docs.where(held), language_id.train(docs.where(~held))).where("lang_pred <> 'und'")
    n, right = found.agg(F.count("*"), F.count_if(F.col("lang_pred") == F.col("lang"))).first()
    print(f"language: {right} of {n}")
    assert right >= 0.97 * n


def test_quality_of_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 0
    rules = quality_rules.learn(docs, labels.where(~held))
    judged = quality_rules.judge(quality_rules.text_statistics(docs.join(labels.where(held).select("doc_id"), "doc_id", "left_semi")), rules).join(labels, "doc_id")
    n, right, base = judged.agg(F.count("*"), F.count_if(F.col("kept") == (F.col("quality") == 1)), F.count_if(F.col("base_failed") == (F.col("quality") == 0))).first()
    print(f"quality: {right} of {n} by base and rules, {base} by the base alone, {len(rules)} rules")
    assert right >= base and right >= 0.8 * n


def test_verdicts_of_held_out_urls(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    seen = url_filters.lexical(url_filters.longest_rule(url_filters.host_and_path(pages.select("page_id", "url")))).where("rule is not null").withColumn("blocked", F.col("rule_verdict") == "block")
    held = F.crc32(F.col("url").cast("binary")) % 4 == 1
    model = url_filters.train(seen.where(~held))
    n, right, blocked = model.with_suffix(seen.where(held)).agg(F.count("*"), F.count_if((model.score() > 0) == F.col("blocked")), F.count_if("blocked")).first()
    print(f"urls: {right} of {n}, of which {blocked} are blocked by rules")
    assert right >= max(blocked, n - blocked)
