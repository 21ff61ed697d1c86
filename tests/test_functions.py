from datetime import date

import pytest
from pyspark.sql import functions as F

from sakuin.functions import codes, dates, links, text


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"s {kind}").select(f(F.col("s")).alias("r")).first()["r"]


def normal(f):
    return lambda c: f(text.normalize_text(c))


@pytest.mark.parametrize(("value", "expected"), [("令和8年7月1日", date(2026, 7, 1)), ("平成30年4月1日", date(2018, 4, 1)), ("令和元年5月1日", date(2019, 5, 1)), ("昭和64年1月7日", date(1989, 1, 7)), ("R8.7.1", date(2026, 7, 1)), ("２０２４/２/２９", date(2024, 2, 29)), ("2024/2/30", None), ("2024-13-01", None), ("", None), (None, None)])
def test_parse_date(spark, value, expected):
    assert one(spark, value, normal(dates.parse_date)) == expected


def test_dates_of_text(spark):
    value = "令和8年7月1日現在 / 令和8年6月1日現在"
    assert one(spark, value, normal(dates.as_of_dates)) == [date(2026, 7, 1), date(2026, 6, 1)]
    assert one(spark, "2024/1/5 と R6.2.30 と 令和6年3月1日", normal(dates.dates_in_text)) == [date(2024, 1, 5), date(2024, 3, 1)]


@pytest.mark.parametrize(("value", "expected"), [("19999", None), ("20000", date(1954, 10, 3)), ("45658", date(2025, 1, 1)), ("45658.5", date(2025, 1, 1)), ("80000", date(2119, 1, 11)), ("80001", None), ("x", None)])
def test_serials(spark, value, expected):
    assert one(spark, value, dates.serial_date) == expected


@pytest.mark.parametrize(("value", "expected"), [("18-1011-5202", "1810115202"), ("１８-１０１１-５２０２", "1810115202"), ("さくら診療所", None), ("1820115202", None), ("181011520", None)])
def test_extract_code(spark, value, expected):
    from sakuin.plans import client

    assert one(spark, value, normal(codes.extract_code)) == expected == client.extract_code(value)


def test_other_codes(spark):
    assert one(spark, "01-15202", normal(codes.sheet_code)).asDict() == {"local_code": "0115202", "full_code": None}
    assert one(spark, "1810115202", normal(codes.sheet_code))["full_code"] == "1810115202"
    assert one(spark, "9910115202", normal(codes.sheet_code)) is None
    assert one(spark, "01,2345,6", normal(codes.printed_code))["local_code"] == "0123456"
    assert one(spark, "(0123456)", normal(codes.printed_code)) is None
    assert one(spark, "2026/7/1", normal(codes.printed_code)) is None


def test_hash_keys(spark):
    row = spark.createDataFrame([("歯医DX2", None, "1632030498", 1)], "a string, n string, c string, p int")
    sha = "173de3bb5852aa5e9c944bca50da7f728d3ec3865170aa85d7760e3e56e378d5"
    got = row.select(codes.standard_id(F.col("a"), F.col("n")).alias("s"), codes.event_id(F.lit(sha), F.col("p"), F.col("c"), F.lit("remove"), F.col("a"), F.col("n"), F.lit(""), F.lit("2026-09-01")).alias("e")).first()
    assert tuple(got) == ("f0fb95ea079256cf", "fb2a8c64428e77c768940bbf")


@pytest.mark.parametrize(("value", "expected"), [("医科 一覧", "medical"), ("tokyo_shika.pdf", "dental"), ("薬局", "pharmacy"), ("医科・歯科", None), ("", None), ("x_ika_1", "medical")])
def test_category(spark, value, expected):
    assert one(spark, value, normal(text.category)) == expected


def test_text(spark):
    assert one(spark, " ㈱　ア\n﻿ｲ ", text.normalize_text) == "(株) ア イ"
    assert one(spark, "医療・機関：(番号)", normal(text.compact)) == "医療機関番号"
    assert one(spark, "サクラ・クリニック（中央）", text.facility_name) == "サクラクリニック中央"
    assert one(spark, "〒123-4567 東京都 港区", normal(text.clean_address)) == "東京都港区"
    assert one(spark, "〒123-4567", normal(text.clean_address)) is None
    assert one(spark, "①２。", text.ocr_text) == "1２."
    assert one(spark, "𠮷田", text.utf16_length) == 3
    assert one(spark, "(外来感染) 第 109 号", normal(text.acceptance)).asDict() == {"abbreviation": "外来感染", "acceptance_number": "第109号"}
    assert one(spark, "第109号", normal(text.acceptance)) is None


def test_links(spark):
    url = "https://a.mhlw.go.jp/x/260715-22-13-01.pdf"
    assert one(spark, url, links.date_from_url) == "2026-07-15"
    assert one(spark, url, links.prefecture_from_url) == "13"
    assert one(spark, url, links.category_from_url) == "medical"
    assert one(spark, "http://a.mhlw.go.jp/x.pdf", links.is_allowed) is False
    assert one(spark, "https://evil.example/x.pdf", links.is_allowed) is False
    assert one(spark, "https://a.mhlw.go.jp/%E5%8C%BB.zip?x", links.is_workbook) is True
    assert one(spark, "https://a.mhlw.go.jp/%E5%8C%BB.zip?x", links.label) == "医.zip"


def test_display(spark):
    assert [one(spark, v, dates.long_date) for v in ("2026-07-01", "soon", "", None)] == ["2026年7月1日", "soon", "—", "—"]
    assert [one(spark, v, dates.tokyo_time) for v in ("2026-07-01 20:30:00", "2026-07-01T00:00:00Z", "x", None)] == ["2026/07/02 05:30", "2026/07/01 09:00", "x", "—"]
    assert [one(spark, v, dates.grouped_number, "long") for v in (1234567, 12, None)] == ["1,234,567", "12", "—"]
