"""Plans whose use of the driver, of shuffles and of tasks must not grow faster than their input."""

import re

import pytest

from sakuin.operators import merge, sheets
from sakuin.plans import rendered
from sakuin.plans.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("query", ["sheet_headers", "sheet_records", "sheet_quarantine", "workbook_records"])
def test_tables_by_sheet_are_not_sent_to_the_driver(spark, query):
    assert "Broadcast" not in plan(QUERIES[query](spark, SMALL))


def test_filings_are_dealt_once(spark, tmp_path):
    """Both parts read rows that are dealt by their keys alone, not by the row or the filing as well."""
    spark.sql("select id % 2 code, id div 3 ord, id pos, 'a' abbreviation, cast(null as string) standard_name, '' acceptance_number, date'2026-01-01' effective_from, 'b' book from range(9)").write.parquet(f"{tmp_path}/rows")
    found = merge.distinct_filings(spark.read.parquet(f"{tmp_path}/rows"), by=("book", "code"))
    assert {(r["code"], r["ord"], r["pos"]) for r in found.collect()} == {(0, 0, 0), (0, 0, 2), (1, 0, 1)}
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan(found))
    assert dealt and all(re.fullmatch(r"book#\d+, code#\d+L", by) for by in dealt)


def test_many_files_are_dealt_to_few_partitions(spark, tmp_path, monkeypatch):
    """Planning opens some files only, tasks open the rest, and a file written again counts once."""
    import pandas as pd

    from sakuin.sources import sheet_source, workbooks

    monkeypatch.setattr(sheet_source, "OPENED", 2)
    monkeypatch.setattr(sheet_source, "DEALT", 10)
    books = [(f"https://x/{k}/b.xlsx", bytearray(rendered._book({1: {2: f"v{k}"}}))) for k in range(42)]
    place = str(tmp_path / "files")
    sheet_source.write_files(spark.createDataFrame(books, "document_url string, content binary"), place)
    again = [(books[0][0], bytearray(rendered._book({1: {2: "new"}})))]
    sheet_source.write_files(spark.createDataFrame(again, "document_url string, content binary"), place)
    opened, real = [], workbooks.Book
    monkeypatch.setattr(workbooks, "Book", lambda source: opened.append(1) or real(source))
    reader = sheet_source.SheetReader({"path": place})
    parts = reader.partitions()
    assert len(opened) == 2 and len(parts) == 2 + 4
    frame = pd.concat(b.to_pandas() for p in parts for b in reader.read(p))
    assert sorted(c[0][1] for c in frame["cells"]) == sorted(["new", *[f"v{k}" for k in range(1, 42)]])


def test_dates_of_a_small_file_are_many_tasks_work(spark):
    assert "Exchange hashpartitioning(o_orderkey" in plan(QUERIES["cell_dates"](spark, SMALL))


def test_shards_are_parsed_once(spark, tmp_path):
    """A file's JSON is parsed by one expression, whatever filters follow, and the views of all facilities read a table of it."""
    from pyspark.sql import functions as F

    from sakuin.plans import static

    (tmp_path / "facilities").mkdir()
    (tmp_path / "facilities" / "0110.json").write_text('{"schemaVersion":1,"asOf":"2026-07-01","prefix":"0110","facilities":{"0110000001":{"name":"n","address":null,"category":"medical","sourceIds":["k"],"sourceDocuments":["u"],"standards":[["s","",null]]}}}')
    shards = static.read_json(spark, [f"{tmp_path}/facilities"], static.SHARD)
    assert plan(shards.select("asOf", F.explode("facilities"))).count("from_json(") == 1
    found = static.StaticRegister(spark, str(tmp_path)).facilities()
    assert "FileScan text" not in plan(found)
    assert [(r["code"], r["name"], str(r["as_of"]), r["recent_change_count"]) for r in found.collect()] == [("0110000001", "n", "2026-07-01", 0)]


def test_pages_of_text_are_walked_once(spark):
    """Pages stream through tasks, whatever the batches; their lines are made once, not for each part of the plan that reads them."""
    from sakuin.operators import positioned

    items = [(f"u{d}", p, float(x), y, "t", x) for d in range(2) for p in (1, 2) for x, y in enumerate([2.0, 0.0, 1.4, 1.6, 3.2, None])]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        found = positioned.lines(spark.createDataFrame(items, "document_url string, page int, x double, y double, text string, ord int")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    at = {0: (1, 1.6), 1: (0, 0.0), 2: (0, 0.0), 3: (1, 1.6), 4: (2, 3.2), 5: (2, 3.2)}
    assert sorted((r["document_url"], r["page"], r["ord"], r["line"], r["line_y"]) for r in found) == sorted((d, p, o, *at[o]) for d, p, _, _, _, o in items)
    made = plan(QUERIES["notice_events"](spark, SMALL))
    assert "InPandas" not in made and "MapInArrow" not in made
