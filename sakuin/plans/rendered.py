"""Operators that read documents, on pages, sheets and notices rendered from the shared tables, each with the same question in SQL."""

from __future__ import annotations

import io
import uuid
import zipfile
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import functions as F

from sakuin.functions import codes, dates, links, text
from sakuin.operators import discovery, manifests, merge, name_index, positioned, replay, search, sheets
from sakuin.operators.tables import kept
from sakuin.plans import sinks, static
from sakuin.plans.client import Register
from sakuin.plans.ordered import OrderedTable
from sakuin.plans.queries import _CODE, _KIND, _customers, _shared, query, table
from sakuin.sources import html, registers, sheet_source, workbooks

_N7 = "lpad(cast(c_custkey as varchar), 7, '0')"


@query(f"""with s as (select c_custkey, code, n, case c_custkey % 6 when 0 then code when 1 then substr(n, 1, 2) || '-' || substr(n, 3) when 2 then substr(n, 1, 2) || ',' || substr(n, 3, 4) || '，' || substr(n, 7)
when 3 then '(' || n || ')' when 4 then cast(c_custkey as varchar) else '9' || code end s from (select c_custkey, {_CODE} code, {_N7} n from customer))
select c_custkey, s, case when c_custkey % 6 <> 5 then case when c_custkey % 6 = 0 then substr(code, 4) else n end end sheet_local, case when c_custkey % 6 = 0 then code end sheet_full,
case when c_custkey % 6 = 0 then substr(code, 4) when c_custkey % 6 in (1, 2) or (c_custkey % 6 = 4 and length(s) = 7) then n end printed_local, case when c_custkey % 6 = 0 then code end printed_full from s""")
def code_shapes(spark, sf_dir):
    """Codes as sheets and notices write them; every rendered full code must hold one."""
    k = F.col("c_custkey") % 6
    rows = _customers(spark, sf_dir).withColumn("n", F.lpad(F.col("c_custkey").cast("string"), 7, "0"))
    part = lambda a, b: F.substring("n", a, b)
    shaped = F.when(k == 0, codes.required_code(F.col("code"))).when(k == 1, F.concat(part(1, 2), F.lit("-"), part(3, 5))).when(k == 2, F.concat(part(1, 2), F.lit(","), part(3, 4), F.lit("，"), part(7, 1)))
    shaped = shaped.when(k == 3, F.concat(F.lit("("), "n", F.lit(")"))).when(k == 4, F.col("c_custkey").cast("string")).otherwise(F.concat(F.lit("9"), "code"))
    rows = rows.select("c_custkey", shaped.alias("s")).select("c_custkey", "s", codes.sheet_code(F.col("s")).alias("a"), codes.printed_code(F.col("s")).alias("b"))
    return rows.select("c_custkey", "s", F.col("a.local_code").alias("sheet_local"), F.col("a.full_code").alias("sheet_full"), F.col("b.local_code").alias("printed_local"), F.col("b.full_code").alias("printed_full"))


@query("""select o_orderkey, case when o_orderkey % 4 < 3 then '外来' || cast(o_orderkey % 9 as varchar) end abbreviation, case when o_orderkey % 4 < 3 then '第' || cast(o_orderkey as varchar) || '号' end acceptance_number,
cast(o_orderkey % 9 + 1 as varchar) || '.' || cast(o_orderkey % 7 as varchar) || ',' recognised from orders""")
def acceptance_parse(spark, sf_dir):
    """Acceptance numbers, with look-alikes of optical recognition; a number without brackets is none."""
    number, name = "cast(o_orderkey as string)", "cast(o_orderkey % 9 as string)"
    cell = F.expr(f"case o_orderkey % 4 when 0 then '(外来' || {name} || ')第' || {number} || '号' when 1 then 'x（外来' || {name} || '） 笠 ' || {number} || ' 旨' when 2 then '(外来' || {name} || ') 策' || {number} || '三 y' else '第' || {number} || '号' end")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", text.acceptance(cell).alias("a"), text.ocr_text(F.expr("substring('①②③④⑤⑥⑦⑧⑨', cast(o_orderkey % 9 as int) + 1, 1) || '．' || cast(o_orderkey % 7 as string) || '，'")).alias("recognised"))
    return rows.select("o_orderkey", "a.abbreviation", "a.acceptance_number", "recognised")


@query("""select s_suppkey, case when s_suppkey % 3 > 0 then '東京都' || replace(s_name, ' ', '') end address, 'a' || lower(s_name) || 'x' searched, s_name || '|b c' names, length(s_name) + 2 units, s_suppkey % 5 not in (0, 1, 2) is_name from supplier""")
def document_text(spark, sf_dir):
    """Addresses without postal codes, names in the form of searches, names of a cell, lengths in UTF-16 units, lines that name a filing."""
    address = F.expr("case when s_suppkey % 3 = 0 then '〒123-4567 ' when s_suppkey % 3 = 1 then '〒 100ー0001 |東京都 ' || s_name else '_東京都　' || s_name end")
    line = F.expr("case s_suppkey % 5 when 0 then '病床 ' || s_name when 1 then s_name || '：一' when 2 then '12' || s_name else s_name end")
    rows = table(spark, sf_dir, "supplier")
    return rows.select("s_suppkey", text.clean_address(address).alias("address"), text.facility_name(F.expr("'Ａ・' || s_name || 'ー　（Ｘ）'")).alias("searched"), F.array_join(text.split_names(F.expr("' ' || s_name || '\\r\\n \\n b  c'")), "|").alias("names"),
                       text.utf16_length(F.expr("s_name || '𠮷'")).cast("long").alias("units"), text.is_standard_name(line).alias("is_name"))


@query("""with d as (select o_orderkey k, make_date(2019 + cast(o_orderkey % 9 as int), 1 + cast(o_orderkey % 12 as int), 1 + cast(o_orderkey % 28 as int)) a, make_date(2024, 1 + cast(o_orderkey % 12 as int), 2) b, date '1899-12-30' + cast(40000 + o_orderkey % 9000 as int) s from orders)
select k o_orderkey, cast(case k % 3 when 0 then 1 when 1 then 2 else 0 end as bigint) n, case k % 3 when 0 then s when 1 then a end first, case k % 3 when 0 then s when 1 then greatest(a, b) end latest, a current, strftime(a, '%Y年') || cast(month(a) as varchar) || '月' || cast(day(a) as varchar) || '日' shown,
strftime(cast(a as timestamp) + interval 5 hour, '%Y/%m/%d %H:%M') clock, format('{:,}', k * 1000) grouped, case k % 2 when 0 then '—' else 'x' end raw from d""")
def cell_dates(spark, sf_dir):
    """Dates of a sheet's cell (no abbreviated era there), dates that a page says it is current at, and dates, times and numbers as shown."""
    k = "cast(o_orderkey % {} as string)"
    era = f"'令和' || case o_orderkey % 9 when 0 then '元' else cast(1 + o_orderkey % 9 as string) end || '年' || {'cast(1 + o_orderkey % 12 as string)'} || '月' || {'cast(1 + o_orderkey % 28 as string)'} || '日'"
    cell = F.expr(f"case o_orderkey % 3 when 0 then ' ' || cast(40000 + o_orderkey % 9000 as string) || '.75 ' when 1 then {era} || '～2024/' || cast(1 + o_orderkey % 12 as string) || '/2' else 'R6.1.' || {k.format(9)} end")
    page = F.expr(f"{era} || ' 現在（令和5年1月1日から）'")
    rows = _dealt(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey").select("o_orderkey", dates.cell_dates(cell).alias("d"), dates.max_date(dates.as_of_dates(page)).alias("current"))
    clock = F.date_format(F.expr("cast(current as timestamp) - interval 4 hours"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return rows.select("o_orderkey", F.size("d").cast("long").alias("n"), F.get("d", F.lit(0)).alias("first"), dates.max_date(F.col("d")).alias("latest"), "current", dates.long_date(F.col("current")).alias("shown"), dates.tokyo_time(clock).alias("clock"),
                       dates.grouped_number(F.col("o_orderkey") * 1000).alias("grouped"), dates.long_date(F.expr("case o_orderkey % 2 when 0 then '' else 'x' end")).alias("raw"))


@query("""with u as (select p_partkey k, lpad(cast(1 + p_partkey % 47 as varchar), 2, '0') p, case p_partkey % 3 when 0 then '01' when 1 then '03' else '04' end c, case p_partkey % 3 when 0 then 'medical' when 1 then 'dental' else 'pharmacy' end kind from part)
select k p_partkey, case when k % 4 < 2 then p end prefecture, case when k % 4 < 3 then kind end category, case k % 4 when 0 then '2026-07-15' when 1 then null when 2 then '2026-09-01' else '2025-03-02' end published, k % 5 > 0 is_allowed, k % 4 < 2 is_notice, k % 4 >= 2 is_workbook, k % 4 = 1 and k % 2 = 1 and k % 8 = 1 before_base,
case k % 4 when 0 then '260715-22-' || p || '-' || c || '.pdf' when 1 then p || '_' || c || '_' || case when k % 8 = 1 then '2026.6-1_' else '2026.7-2_' end || '.PDF' when 2 then '10_' || c || '_list_80901-' || c || '_' || c || '_x.zip' else '令和_20250302.xlsx' end as label, case when k % 3 > 0 then k % 3 end page_no,
case when k % 7 = 0 then '/s' else '/s?q=a+' || cast(k as varchar) || '%26' end as search, '/f/' || cast(k as varchar) facility, case k % 3 when 0 then '医科' when 1 then '歯科' else '薬局' end category_label from u""")
def address_facts(spark, sf_dir):
    """What addresses of documents tell: prefecture, category by number, dates, format, host, month before the base; labels and links."""
    p, c = "lpad(cast(1 + p_partkey % 47 as string), 2, '0')", "case p_partkey % 3 when 0 then '01' when 1 then '03' else '04' end"
    name = f"""case p_partkey % 4 when 0 then '260715-22-' || {p} || '-' || {c} || '.pdf' when 1 then {p} || '_' || {c} || '_' || case when p_partkey % 8 = 1 then '2026.6-1_' else '2026.7-2_' end || '.PDF'
    when 2 then 'list_80901-' || {c} || '_' || {c} || '_x.zip' else '%E4%BB%A4%E5%92%8C_20250302.xlsx' end"""
    u = F.expr(f"case when p_partkey % 5 = 0 then 'http' else 'https' end || '://a.mhlw.go.jp/x/' || case p_partkey % 4 when 2 then {c.replace("'01'", "'10_01_'").replace("'03'", "'10_03_'").replace("'04'", "'10_04_'")} else '' end || {name}")
    rows = table(spark, sf_dir, "part").select("p_partkey", u.alias("u"))
    u, k = F.col("u"), F.col("p_partkey")
    shown = links.page_link(u, F.col("p_partkey") % 3)
    plain = F.when(k % 4 == 2, F.lit(None)).otherwise(links.prefecture_from_url(u))
    return rows.select("p_partkey", plain.alias("prefecture"), links.category_from_url(u).alias("category"), links.date_from_url(u).alias("published"), links.is_allowed(u).alias("is_allowed"), links.is_notice(u).alias("is_notice"), links.is_workbook(u).alias("is_workbook"),
                       links.before_base_month(u, F.lit("2026-07-01").cast("date")).alias("before_base"), links.label(u).alias("label"), F.nullif(F.regexp_extract(shown, "#page=([0-9]+)", 1), F.lit("")).cast("bigint").alias("page_no"),
                       links.search_link("/s", F.expr("case when p_partkey % 7 = 0 then '' else 'a ' || cast(p_partkey as string) || '&' end")).alias("search"), links.facility_link("/f", k.cast("string")).alias("facility"),
                       text.category_label(F.expr("case p_partkey % 3 when 0 then 'medical' when 1 then 'dental' else 'pharmacy' end")).alias("category_label"))


@query("""select o_orderkey, case o_orderkey % 8 when 0 then 'remove' when 1 then 'remove' when 2 then 'upsert' when 3 then 'remove' when 4 then 'upsert' when 5 then 'remove' when 6 then 'upsert' else 'remove' end as action from orders""")
def action_steps(spark, sf_dir):
    """What stands closest to a link decides what its notice does: each step of the rule, and what comes before it."""
    cases = [("辞退", "n.pdf", "新規", ""), ("新規", "x_jitai.pdf", "", ""), ("変更", "n.pdf", "廃止", "失効"), ("医科", "n.pdf", "取下げ 新規", ""), ("医科", "n.pdf", "新規", "失効"), ("医科", "n.pdf", "一覧", "失効 一覧"), ("医科", "n.pdf", "一覧", "一覧"), ("", "Shikkou/n.pdf", "変更", "")]
    at = lambda k: F.element_at(F.array(*[F.lit(c[k]) for c in cases]), (F.col("o_orderkey") % 8 + 1).cast("int"))
    return table(spark, sf_dir, "orders").select("o_orderkey", links.action(at(0), at(1), at(2), at(3)).alias("action"))


def _pages(spark, sf_dir, body: str, **more):
    """A page per supplier with `body` as its HTML (SQL over supplier)."""
    extra = {"source_id": "cast(s_suppkey as string)", "bureau_name": "s_name", "page_url": "'https://k.mhlw.go.jp/a/' || cast(s_suppkey as string) || '/i.html'", "html": body, **more}
    return table(spark, sf_dir, "supplier").selectExpr(*[f"{v} as {k}" for k, v in extra.items()])


def _dealt(rows, key: str):
    """Rows of a small file dealt to tasks, for work that takes long a row."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


_K = "cast(s_suppkey as string)"


@query("""with s as (select s_suppkey k, 'https://k.mhlw.go.jp/a/' || cast(s_suppkey as varchar) || '/' base from supplier)
select k s_suppkey, 0 ord, base || 'p' || cast(k as varchar) || '.pdf' url, 'A&B' anchor, '医科' column_text, '一|二||||' headings, 'A&B歯' row_text, 1 links_in_row from s
union all select k, 1, 'https://k.mhlw.go.jp/q.pdf?x=1', '歯', '歯科', '一|二||||', 'A&B歯', 2 from s
union all select k, 2, 'https://other.example/z', '先', '', '三|||||', '先へ', 1 from s""".replace("1 links_in_row", "2 links_in_row"))
def page_links(spark, sf_dir):
    """Links of a page with their row, column head and the headings above."""
    body = f"'<h1>一</h1><h2>二</h2><table><tr><th>医科</th><th>歯科</th></tr><tr><td><a href=\"p' || {_K} || '.pdf\">A&amp;B</a></td><td><a href=\"/q.pdf?x=1\">歯</a></td></tr></table><h1>三</h1><p><a href=\"https://other.example/z\">先</a>へ<script>var a;</script></p><a>none</a>'"
    found = html.page_links(_pages(spark, sf_dir, body)).where("href is not null")
    return found.select(F.regexp_extract("page_url", "/a/([0-9]+)/", 1).cast("bigint").alias("s_suppkey"), "ord", "url", "anchor", "column_text", F.array_join("headings", "|").alias("headings"), "row_text", F.size("row_links").alias("links_in_row"))


@query("""with s as (select s_suppkey k, make_date(2026, 1 + cast(s_suppkey % 12 as int), 1) d, 'https://k.mhlw.go.jp/a/' || cast(s_suppkey as varchar) || '/' base from supplier)
select k s_suppkey, base || 'new_ika.xlsx' url, d as_of, 'medical' category from s union all select k, base || 'new_list.zip', d, 'dental' from s""")
def monthly_discovery(spark, sf_dir):
    """The newest lists of each page: sections, hosts, formats, dates and categories of its links; a link twice counts once."""
    row = lambda href, text: f"<li>{text} <a href=\"{href}\">{text}</a></li>"
    body = "'<h1>届出受理医療機関名簿</h1><h2>令和8年' || cast(1 + s_suppkey % 12 as string) || '月1日現在</h2><ul>" + row("new_ika.xlsx", "医科") + row("new_list.zip", "歯科") + row("new_ika.xlsx", "医科") + row("x.pdf", "薬局") + row("https://evil.example/e.xlsx", "薬局") + "</ul><h2>訪問看護</h2><p>" + row("h_ika.xlsx", "医科") + "</p><h2>令和7年12月1日現在</h2><p>" + row("old_ika.xlsx", "医科") + "</p>'"
    pages = _pages(spark, sf_dir, body, target_section=f"'{registers.TARGET_SECTION}'", excluded_section=f"'{registers.EXCLUDED_SECTION}'")
    return discovery.monthly_documents(pages).select(F.col("source_id").cast("bigint").alias("s_suppkey"), "url", "as_of", "category")


@query("""with s as (select s_suppkey k, make_date(2026, 7, 1 + cast(s_suppkey % 28 as int)) d, 'https://k.mhlw.go.jp/a/' || cast(s_suppkey as varchar) || '/' base from supplier where s_suppkey % 28 > 0)
select k s_suppkey, base || 'a.pdf' url, d published_at, 'medical' category, 'upsert' as action, '13' prefecture from s union all select k, base || 'b.pdf', d, 'dental', 'remove', '13' from s
union all select k, base || 'c.pdf', d, 'pharmacy', 'upsert', '13' from s union all select k, base || '47_04_x.pdf', d, 'pharmacy', 'upsert', '47' from s""")
def change_discovery(spark, sf_dir):
    """Notices after the base date: places in a row of four, what they do, pages that list no filings, hints of prefectures."""
    cell = lambda href, text: f"<td><a href=\"{href}\">{text}</a></td>"
    day = "cast(1 + s_suppkey % 28 as string)"
    body = f"'<h2>令和8年7月' || {day} || '日掲載</h2><table><tr><th>一</th><th>二</th><th>三</th><th>四</th></tr><tr>" + cell("a.pdf", "新規・変更") + cell("b.pdf", "辞退") + cell("c.pdf", "新規・変更") + cell("d.pdf", "その他") + f"</tr></table><p><a href=\"47_04_x.pdf\">追加</a></p><p><a href=\"help_ika.pdf\">検索方法</a></p><h3>訪問看護</h3><p><a href=\"v_ika.pdf\">医科</a></p><h2>令和8年6月15日掲載</h2><p><a href=\"old_ika.pdf\">医科 新規</a></p>'"
    pages = _pages(spark, sf_dir, body, prefecture_code_hint="'13'", document_url_pattern="'pdf'", document_context_pattern="cast(null as string)")
    found = discovery.change_documents(pages, "2026-07-01")
    return found.select(F.col("source_id").cast("bigint").alias("s_suppkey"), "url", "published_at", "category", "action", F.col("prefecture_code_hint").alias("prefecture"))


# Header cells of the lists, as sheets and notices have them.
HEADS = ("医療機関番号", "医療機関名称", "医療機関所在地", "受理届出名称", "受理記号", "受理番号", "算定開始年月日")


def _sheet_rows(spark, sf_dir):
    """A sheet per supplier: a title, a header stacked over two rows for every second one, and four rows, of which two go with the
    facility above."""
    s = table(spark, sf_dir, "supplier").selectExpr("s_suppkey k", "s_name", "cast(s_suppkey % 100000 as string) n")
    heads = ", ".join(f"{c}, '{h}'" for c, h in enumerate(HEADS, 1))
    split = ", ".join(f"{c}, '{h[:4]}'" for c, h in enumerate(HEADS, 1)), ", ".join(f"{c}, '{h[4:]}'" for c, h in enumerate(HEADS, 1) if h[4:])
    rows = [
        ("1", "map(1, case k % 3 when 0 then '東京都 医科' when 1 then '大阪府 歯科' else '不明' end)"), ("3", f"case when k % 2 = 0 then map({split[0]}) else map(9, '注') end"), ("4", f"case when k % 2 = 0 then map({split[1]}) else map({heads}) end"),
        ("6", "map(1, '00-' || lpad(n, 5, '0'), 2, s_name, 3, '港区', 4, '一\\n二', 6, '(甲)第' || n || '号\\n(乙)第2号', 7, '45658')"),
        ("7", "map(4, '三', 5, '丙', 6, '第' || n || '号', 7, '令和6年6月1日')"), ("9", "map(2, '別 ' || s_name, 6, '（丁）')"), ("10", "map(1, '合計')"),
    ]
    each = F.explode(F.array(*[F.struct(F.lit(int(r)).alias("row_number"), F.expr(c).alias("cells")) for r, c in rows]))
    return s.select(F.concat(F.lit("https://x/"), F.col("k").cast("string"), F.lit(".xlsx")).alias("document_url"), F.lit("book.xlsx").alias("workbook"), F.lit("一覧").alias("sheet"), each.alias("r")).select("document_url", "workbook", "sheet", "r.*")


@query("""select s_suppkey, 4 header_row, 1 code, 2 as name, 3 address, 4 standard_name, 5 abbreviation, 6 acceptance, 7 effective_from from supplier""")
def sheet_headers(spark, sf_dir):
    """The header row of each sheet and the column of each field, in headers of one row and stacked ones."""
    cells = _sheet_rows(spark, sf_dir).select(*sheets.SHEET, "row_number", F.explode("cells").alias("column", "raw")).withColumn("value", text.normalize_text(F.col("raw")))
    found = sheets.header_columns(cells)
    return found.select(F.regexp_extract("document_url", "([0-9]+)[.]xlsx", 1).cast("bigint").alias("s_suppkey"), "header_row", *[F.col(f"col_{f}").alias(f) for f in ("code", "name", "address", "standard_name", "abbreviation", "acceptance", "effective_from")])


def _records(spark, sf_dir):
    rows = _sheet_rows(spark, sf_dir)
    meta = rows.select("document_url").distinct().selectExpr("document_url", "'kinki' source_id", "'近畿' bureau_name", "'p' page_url", "date'2026-07-01' as_of", "cast(null as string) category_hint", "'' context", "'s' sha256")
    return sheets.records(rows, meta, registers.PREFECTURES, registers.BUREAU_PREFECTURES)


@query("""with s as (select s_suppkey k, s_name, cast(s_suppkey % 100000 as varchar) n, case s_suppkey % 3 when 0 then '131' else '273' end || lpad(cast(s_suppkey % 100000 as varchar), 7, '0') code from supplier where s_suppkey % 3 < 2)
select code, k s_suppkey, 6 ord, 0 pos, s_name as name, '港区' address, '甲' abbreviation, '一' standard_name, '第' || n || '号' acceptance_number, date '2025-01-01' effective_from from s
union all select code, k, 6, 1, s_name, '港区', '乙', '二', '第2号', date '2025-01-01' from s union all select code, k, 7, 0, s_name, '港区', '丙', '三', '第' || n || '号', date '2024-06-01' from s
union all select code, k, 9, 0, '別 ' || s_name, '港区', '丁', null, '', null from s""")
def sheet_records(spark, sf_dir):
    """Filings of sheets: values go down until the next one, prefecture and category come from the sheet, cells hold several filings."""
    good, _ = _records(spark, sf_dir)
    return good.select("code", F.regexp_extract("document_url", "([0-9]+)[.]xlsx", 1).cast("bigint").alias("s_suppkey"), "ord", "pos", "name", "address", "abbreviation", "standard_name", "acceptance_number", "effective_from")


@query("""select s_suppkey, unnest([6, 7, 9]) row_number, 'prefecture or category unknown' problem from supplier where s_suppkey % 3 = 2""")
def sheet_quarantine(spark, sf_dir):
    """Rows whose prefecture or category stays unknown."""
    _, bad = _records(spark, sf_dir)
    return bad.select(F.regexp_extract("document_url", "([0-9]+)[.]xlsx", 1).cast("bigint").alias("s_suppkey"), "row_number", "problem")


def _book(rows: dict[int, dict[int, str]]) -> bytes:
    """A workbook with one sheet: the first column in shared strings, numbers and truth values plain, all else inline."""
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    shared, body = [], ""
    for number, cells in rows.items():
        body += f'<row r="{number}">'
        for column, value in cells.items():
            at = f'r="{chr(64 + column) if column <= 26 else "A" + chr(38 + column)}{number}"'
            if column == 1:
                shared.append(value)
                body += f'<c {at} t="s"><v>{len(shared) - 1}</v></c>'
            elif value in ("TRUE", "FALSE"):
                body += f'<c {at} t="b"><v>{int(value == "TRUE")}</v></c>'
            elif value.isdigit():
                body += f"<c {at}><v>{value}</v></c>"
            else:
                body += f'<c {at} t="inlineStr"><is><t>{escape(value)}</t></is></c>'
        body += "</row>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="一" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="/xl/worksheets/s.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}>" + "".join(f"<si><r><t>{escape(s[:2])}</t></r><r><t>{escape(s[2:])}</t></r></si>" for s in shared) + "</sst>")
        z.writestr("xl/worksheets/s.xml", f"<worksheet {main}><sheetData>{body}</sheetData></worksheet>")
    return out.getvalue()


@query("""with s as (select s_suppkey k, s_name, case when s_suppkey % 2 = 0 then 'b.xlsx' else 'l.xlsx' end book, case when s_suppkey % 4 = 3 then ['l.xlsx', 'm.xlsm'] when s_suppkey % 2 = 0 then ['b.xlsx'] else ['l.xlsx'] end books from supplier),
w as (select k, s_name, unnest(books) workbook from s)
select k s_suppkey, workbook, '一' sheet, 2 row_number, 1 as column, s_name as value from w union all select k, workbook, '一', 2, 2, cast(k as varchar) from w union all select k, workbook, '一', 5, 3, 'a<b' from w union all select k, workbook, '一', 5, 27, case when k % 2 = 0 then 'TRUE' else 'FALSE' end from w""")
def workbook_cells(spark, sf_dir):
    """Cells of workbooks, alone and in archives with other files: shared, inline, plain and truth values, rows and cells left out."""

    def render(frames):
        for frame in frames:
            rows = []
            for k, name in zip(frame["k"], frame["s_name"], strict=True):
                data, url = _book({2: {1: name, 2: str(k)}, 4: {}, 5: {3: "a<b", 27: "TRUE" if k % 2 == 0 else "FALSE"}}), f"https://x/{k}/b.xlsx"
                if k % 2:
                    out, url = io.BytesIO(), f"https://x/{k}/%E4%B8%80.zip"
                    with zipfile.ZipFile(out, "w") as z:
                        z.writestr("d/l.xlsx", data), z.writestr("__MACOSX/l.xlsx", b""), z.writestr("read.txt", b"x")
                        if k % 4 == 3:
                            z.writestr("m.xlsm", data)
                    data = out.getvalue()
                rows.append((url, data, len(data)))
            yield pd.DataFrame(rows, columns=["path", "content", "length"])

    files = _dealt(table(spark, sf_dir, "supplier").selectExpr("s_suppkey k", "s_name"), "k").mapInPandas(render, "path string, content binary, length long")
    place = f"{_shared(spark)}/books-{uuid.uuid4().hex}"
    sheet_source.write_files(workbooks.documents(files), place)
    rows = sheet_source.read_sheets(spark, place)
    return rows.select(F.regexp_extract("document_url", "x/([0-9]+)/", 1).cast("bigint").alias("s_suppkey"), "workbook", "sheet", "row_number", F.explode("cells").alias("column", "value"))


@query("""select l_orderkey, l_linenumber, cast(dense_rank() over (partition by l_orderkey // 256 order by l_orderkey, l_linenumber // 3) - 1 as integer) line from lineitem""")
def text_lines(spark, sf_dir):
    """Items of a page as lines: within 1.5 of the line's first item."""
    li = table(spark, sf_dir, "lineitem")
    items = li.selectExpr("cast(l_orderkey div 256 as string) document_url", "1 page", "cast(l_linenumber as double) x", "cast((l_orderkey % 256) * 100 + (l_linenumber div 3) * 10 + (l_linenumber % 3) * 0.7 as double) y", "'t' text", "cast((l_orderkey % 256) * 8 + l_linenumber as int) ord")
    order, number = F.col("document_url").cast("bigint") * 256 + F.floor((F.col("ord") - 1) / 8), F.pmod(F.col("ord") - 1, F.lit(8)) + 1
    return positioned.lines(items).select(*[c.cast(li.schema[n].dataType).alias(n) for c, n in ((order, "l_orderkey"), (number, "l_linenumber"))], "line")


def _notices(spark, sf_dir):
    """A notice per supplier as positioned text: filings that come for even keys, filings that go for odd ones; every tenth page was
    recognised from a picture."""
    s = table(spark, sf_dir, "supplier").selectExpr("s_suppkey k", "s_name", "lpad(cast(s_suppkey % 100000 as string), 5, '0') n", "s_suppkey % 10 = 0 ocr")
    head = [(10, 50, "'医療機関番号'"), (100, 50, "'医療機関 名称'"), (220, 50, "'所 在 地'")]
    code, name = (10, 80, "'13-' || n"), (100, 80, "s_name")
    come = [*head, (380, 50, "'受理内容'"), code, name, (100, 90, "'診療所'"), (200, 80, "'〒123-4567'"), (200, 90, "'港区'"), (380, 80, "'外来加算'"), (410, 90, "'(外来)第' || n || '号'"), (600, 90, "'令和8年7月1日'"), (380, 100, "'連携'"), (380, 104, "'加算'"), (410, 110, "'(連携)笠5' || '旨'"), (600, 110, "'2026/6/1'")]
    gone = [*head, (400, 50, "'開設者氏名'"), (500, 50, "'辞退内容'"), (640, 50, "'辞退事由'"), code, name, (200, 80, "'港区'"), (493, 80, "'外来'"), (645, 80, "'令和8年7月2日'"), (493, 90, "'連携'")]
    array = lambda items: "array(" + ", ".join(f"struct({x}D as x, {y}D as y, {t} as text)" for x, y, t in items) + ")"
    items = s.selectExpr("cast(k as string) document_url", "1 page", "ocr", f"explode(case when k % 2 = 0 then {array(come)} else {array(gone)} end) i").select("document_url", "page", "i.*", "ocr")
    unsure = s.where("ocr").selectExpr("cast(k as string) document_url", "1 page", "10D x", "95D y", "'99-99999' text", "ocr", "12 confidence")
    docs = s.selectExpr("cast(k as string) document_url", "'sha' sha256", "'kanto' source_id", "'p' page_url", "date'2026-07-15' published_at", "case when k % 2 = 0 then 'upsert' else 'remove' end action", "'medical' category_hint", "'13' prefecture_code_hint", "'医科' context")
    return positioned.change_events(items.withColumn("confidence", F.lit(90)).unionByName(unsure), docs, registers.PREFECTURES)


@query("""with s as (select s_suppkey k, s_name, '131' || '13' || lpad(cast(s_suppkey % 100000 as varchar), 5, '0') code, lpad(cast(s_suppkey % 100000 as varchar), 5, '0') n from supplier)
select k s_suppkey, code, case when k % 2 = 1 then s_name when k % 10 = 0 then s_name || '診療所' else s_name || ' 診療所' end as name, '港区' address, case when k % 2 = 0 then 'upsert' else 'remove' end as action, '外来' abbreviation, case when k % 2 = 0 then '外来加算' end standard_name,
case when k % 2 = 0 then '第' || n || '号' else '' end acceptance_number, case when k % 2 = 0 then date '2026-07-01' else date '2026-07-02' end effective_from, case when k % 10 = 0 then 'ocr' else 'text' end extraction_method from s
union all select k, code, case when k % 2 = 1 then s_name when k % 10 = 0 then s_name || '診療所' else s_name || ' 診療所' end, '港区', case when k % 2 = 0 then 'upsert' else 'remove' end, '連携', case when k % 2 = 0 then '連携加算' end,
case when k % 2 = 0 then '第5号' else '' end, case when k % 10 = 0 then date '2026-07-01' when k % 2 = 0 then date '2026-06-01' end, case when k % 10 = 0 then 'ocr' else 'text' end from s""")
def notice_events(spark, sf_dir):
    """Changes of notices: columns by their heads, records by their codes, filings by their acceptance lines, names above them; dates
    near by on recognised pages, whose unsure words don't count."""
    events, _ = _notices(spark, sf_dir)
    return events.select(F.col("document_url").cast("bigint").alias("s_suppkey"), "code", "name", "address", "action", "abbreviation", "standard_name", "acceptance_number", "effective_from", "extraction_method")


@query("select s_suppkey, cast(2 as bigint) accepted, cast(2 as bigint) parsed, s_suppkey % 10 = 0 ocr, true passed from supplier")
def notice_pages(spark, sf_dir):
    """Acceptance lines and changes of each page, and whether enough could be read."""
    pages = kept(_notices(spark, sf_dir)[1])
    rates = manifests.parse_rates(pages).select("document_url", "passed")
    return pages.join(rates, "document_url").select(F.col("document_url").cast("bigint").alias("s_suppkey"), "accepted", "parsed", "ocr", "passed")


@query("""select event_id, substr(sha256('["s' || cast(user_id as varchar) || '",' || cast(event_id % 7 as varchar) || ',"c","' || event_type || '",' || case when event_id % 3 = 0 then 'null' else '"甲"' end || ',"n","第1号",' || case when event_id % 2 = 0 then 'null' else '"2026-07-01"' end || ']'), 1, 24) id,
substr(sha256('[' || case when event_id % 3 = 0 then 'null' else '"甲"' end || ',"n"]'), 1, 16) standard_id from events""")
def event_keys(spark, sf_dir):
    """Content keys of change events and of standards."""
    e = table(spark, sf_dir, "events")
    abbr, day = F.when(F.col("event_id") % 3 != 0, "甲"), F.when(F.col("event_id") % 2 != 0, "2026-07-01")
    key = codes.event_id(F.concat(F.lit("s"), F.col("user_id").cast("string")), F.col("event_id") % 7, F.lit("c"), F.col("event_type"), abbr, F.lit("n"), F.lit("第1号"), day)
    return e.select("event_id", key.alias("id"), codes.standard_id(abbr, F.lit("n")).alias("standard_id"))


@query("""select o_orderkey, cast(o_orderkey % 20 as varchar) standard_id, case when o_orderkey % 20 < 15 then 'a' || cast(o_orderkey % 20 as varchar) end abbreviation from orders""")
def decoded_filings(spark, sf_dir):
    """Names for the ids of filings; unknown ids stay."""
    o = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "cast(o_orderkey % 20 as string) standard_id")
    known = o.select("standard_id").distinct().where("cast(standard_id as int) < 15").withColumn("abbreviation", F.concat(F.lit("a"), "standard_id"))
    return replay.decode(o, known).select("o_orderkey", "standard_id", "abbreviation")


@query("""select l_orderkey code, l_suppkey % 3 document_sha256, l_returnflag workbook, min(l_linenumber) first_line, arg_min('u' || cast(l_partkey as varchar), l_linenumber * 10000000 + l_partkey) url from lineitem group by 1, 2, 3""")
def distinct_provenance(spark, sf_dir):
    """The first row of each document, workbook and sheet that a code comes from."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("code"), (F.col("l_suppkey") % 3).alias("document_sha256"), F.col("l_returnflag").alias("workbook"), F.lit("s").alias("worksheet"), (F.col("l_linenumber") * 10000000 + F.col("l_partkey")).alias("ord"), F.concat(F.lit("u"), F.col("l_partkey").cast("string")).alias("url"), F.col("l_linenumber").alias("first_line"))
    return merge.distinct_sources(li).select("code", "document_sha256", "workbook", "first_line", "url")


_FACILITY = f"f as (select {_CODE} code, c_name as name, {_KIND} category, c_nationkey source from customer)"


@query(f"""with {_FACILITY}, o as (select {_CODE} code, o_orderkey ord, o_orderpriority sid, o_orderstatus num, case when o_orderkey % 2 = 0 then strftime(o_orderdate, '%Y-%m-%d') end eff, cast(o_orderdate as date) d from orders join customer on c_custkey = o_custkey),
t as (select code, '[' || string_agg('["' || sid || '","' || num || '",' || coalesce('"' || eff || '"', 'null') || ']', ',' order by ord) || ']' standards, max(d) as_of from o group by 1),
e as (select f.code, as_of, '"' || f.code || '":{{"name":"' || name || '","address":null,"category":"' || category || '","sourceIds":["' || cast(source as varchar) || '"],"sourceDocuments":["u"],"standards":' || standards || '}}' entry from f join t using (code))
select substr(code, 1, 4) prefix, '{{"schemaVersion":1,"asOf":"' || strftime(max(as_of), '%Y-%m-%d') || '","prefix":"' || substr(code, 1, 4) || '","facilities":{{' || string_agg(entry, ',' order by code) || '}}}}' as value from e group by 1""")
def facility_shards(spark, sf_dir):
    """The JSON of each shard of the register."""
    c = _customers(spark, sf_dir)
    o = c.join(table(spark, sf_dir, "orders"), F.col("o_custkey") == F.col("c_custkey"))
    filings = o.select("code", F.col("o_orderkey").alias("ord"), F.col("o_orderpriority").alias("standard_id"), F.col("o_orderstatus").alias("acceptance_number"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderdate").cast("date")).alias("effective_from"))
    as_of = o.groupBy("code").agg(F.max(F.col("o_orderdate").cast("date")).alias("as_of"))
    facilities = c.select("code", F.col("c_name").alias("name"), F.lit(None).cast("string").alias("address"), "category").join(as_of, "code")
    return sinks.shard_json(facilities, filings, c.select("code", F.col("c_nationkey").cast("string").alias("source_id"), F.lit("u").alias("document_url")))


@query(f"""with {_FACILITY}, e as (select {_CODE} code, o_orderkey id, case when o_orderkey % 3 = 0 then 'remove' else 'upsert' end as action, cast(o_orderdate as date) d from orders join customer on c_custkey = o_custkey),
t as (select code, max(d) latest, string_agg('{{"id":"' || cast(id as varchar) || '","action":"' || action || '","publishedAt":"' || strftime(d, '%Y-%m-%d') || '","standardId":"s","abbreviation":null,"name":"n","acceptanceNumber":"","effectiveFrom":null,"documentUrl":"u","sourceId":"k","sourcePageUrl":"p","page":1}}', ',' order by d, case when action = 'remove' then 0 else 1 end, cast(id as varchar)) events from e group by 1),
j as (select f.code, latest, '"' || f.code || '":{{"name":"' || name || '","address":null,"category":"' || category || '","events":[' || events || ']}}' entry from f join t using (code))
select substr(code, 1, 4) prefix, '{{"schemaVersion":1,"baseAsOf":"1990-01-01","latestAsOf":"' || strftime(max(latest), '%Y-%m-%d') || '","prefix":"' || substr(code, 1, 4) || '","facilities":{{' || string_agg(entry, ',' order by code) || '}}}}' as value from j group by 1""")
def change_shards(spark, sf_dir):
    """The JSON of each shard of the change layer, its events in order."""
    c = _customers(spark, sf_dir)
    e = c.join(table(spark, sf_dir, "orders"), F.col("o_custkey") == F.col("c_custkey")).selectExpr("code", "cast(o_orderkey as string) id", "case when o_orderkey % 3 = 0 then 'remove' else 'upsert' end action", "cast(o_orderdate as date) published_at", "'s' standard_id", "cast(null as string) abbreviation", "'n' standard_name", "'' acceptance_number", "cast(null as date) effective_from", "'u' url", "'k' source_id", "'p' source_page_url", "1 page")
    return sinks.change_shard_json(c.select("code", F.col("c_name").alias("name"), F.lit(None).cast("string").alias("address"), "category"), e, "1990-01-01")


@query(f"""with {_FACILITY} select substr(code, 1, 4) prefix, '{{"schemaVersion":1,"prefix":"' || substr(code, 1, 4) || '","facilityCount":' || cast(count(*) as varchar) || ',"facilities":[' || string_agg('["' || code || '","' || name || '",null,"' || category || '"]', ',' order by code) || ']}}' as value from f group by 1""")
def search_shards(spark, sf_dir):
    """The JSON of the search index, by prefix."""
    return sinks.search_json(_customers(spark, sf_dir).select("code", F.col("c_name").alias("name"), F.lit(None).cast("string").alias("address"), "category"))


@query("""with p as (select distinct p_brand a, p_type n, substr(sha256(cast(to_json([p_brand, p_type]) as varchar)), 1, 16) id from part)
select substr(id, 1, 2) part, '{"schemaVersion":1,"standards":{' || string_agg('"' || id || '":{"abbreviation":"' || a || '","name":"' || n || '"}', ',' order by id) || '}}' as value from p group by 1""")
def catalog_shards(spark, sf_dir):
    """The JSON of the dictionary, by the first digits of its keys."""
    return sinks.catalog_json(merge.catalog(table(spark, sf_dir, "part").select(F.col("p_brand").alias("abbreviation"), F.col("p_type").alias("standard_name"))))


@query("""select (select count(distinct user_id) from events) facility_count, (select count(*) from events) event_count, (select max(cast(o_orderdate as date)) from orders) latest_as_of, (select count(*) from orders) document_count""")
def change_summary(spark, sf_dir):
    """The manifest of the change layer."""
    docs = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("published_at"))
    return manifests.change_manifest(table(spark, sf_dir, "events").select(F.col("user_id").alias("code")), docs, "1990-01-01")


@query("""with d as (select n_nationkey k, count(c_custkey) links, count(case when c_nationkey % 5 > 0 then c_custkey end) dated from nation left join customer on c_nationkey = n_nationkey and c_nationkey % 7 > 0 group by 1)
select 'page links' gate, cast(k as varchar) subject, links found, links > 0 passed from d union all select 'page date', cast(k as varchar), dated, dated > 0 from d
union all select 'date', cast(k as varchar), case when dated > 0 then 1 else 0 end, dated > 0 from d union all select 'date', 'register', 1, true""")
def date_gates(spark, sf_dir):
    """Gates of pages without a document or a date, and of sources and a register without a date."""
    sources = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("source_id"))
    found = table(spark, sf_dir, "customer").where("c_nationkey % 7 > 0").selectExpr("c_nationkey source_id", "c_name url", "case when c_nationkey % 5 > 0 then date'2026-07-01' end as_of")
    dated = sources.join(found.groupBy("source_id").agg(F.max("as_of").alias("as_of")), "source_id", "left")
    gates = manifests.discovery_gates(found, sources).unionByName(manifests.date_gates(found.agg(F.max("as_of").alias("as_of")), dated))
    return gates.select("gate", "subject", "found", "passed")


@query("""select o_orderkey, n, row_number() over (partition by o_custkey order by coalesce(n, a, ''), o_orderkey) place from (select o_orderkey, o_custkey, case when o_orderkey % 3 > 0 then o_clerk end n, case when o_orderkey % 2 > 0 then o_orderpriority end a from orders)""".replace("o_clerk", "o_orderstatus || cast(o_orderkey % 10 as varchar)"))
def filings_by_name(spark, sf_dir):
    """Filings of a facility in Japanese order of their names, or of their abbreviations."""
    from pyspark.sql import Window

    o = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_custkey", "case when o_orderkey % 3 > 0 then o_orderstatus || cast(o_orderkey % 10 as string) end standard_name", "case when o_orderkey % 2 > 0 then o_orderpriority end abbreviation")
    place = F.row_number().over(Window.partitionBy("o_custkey").orderBy(search.name_order(), "o_orderkey")).cast("long")
    return o.select("o_orderkey", F.col("standard_name").alias("n"), place.alias("place"))


def _register(spark, sf_dir) -> tuple[dict, dict]:
    """Customers as the tables of a register, and changes from orders as those of its change layer. What many of them read is written once."""
    c = kept(_customers(spark, sf_dir).select("c_custkey", "c_name", "c_mktsegment", "code", "category").hint("rebalance", "code"))
    o = c.select("c_custkey", "code").join(table(spark, sf_dir, "orders"), F.col("o_custkey") == F.col("c_custkey"))
    o = kept(o.select("code", "o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority"))
    facility = c.selectExpr("code", "c_name name", "c_mktsegment address", "category", "date_add(date'1992-01-01', cast(c_custkey % 9 as int)) as_of")
    filing = o.selectExpr("code", "cast(o_orderkey as int) pos", "o_orderpriority standard_id", "'' acceptance_number", "cast(null as date) effective_from")
    names = o.select("o_orderpriority").distinct().selectExpr("o_orderpriority standard_id", "substring(o_orderpriority, 1, 1) abbreviation", "o_orderpriority standard_name")
    events = kept(o.where("o_orderkey % 7 = 0").selectExpr("code", "cast(o_orderkey as string) id", "case when o_orderkey % 2 = 0 then 'remove' else 'upsert' end action", "cast(o_orderdate as date) published_at", "o_orderpriority standard_id", "substring(o_orderpriority, 1, 1) abbreviation", "o_orderpriority standard_name", "'' acceptance_number", "cast(null as date) effective_from", "'https://x/' || cast(o_custkey % 3 as string) url", "'e' source_id", "'p' source_page_url", "cast(o_orderkey % 5 as int) page", "'text' extraction_method"))
    changed = events.groupBy("code").agg(F.max("published_at").alias("latest_as_of")).selectExpr("code", "'changed' name", "cast(null as string) address", "'medical' category", "latest_as_of")
    index = facility.select("code", "name", "address", "category", text.facility_name(F.col("name")).alias("name_norm"))
    snapshot = {"facility": facility, "filing": filing, "catalog": names, "source": c.selectExpr("code", "'https://x/1' url", "'m' source_id"), "search_index": index}
    return snapshot, {"change_event": events, "change_facility": changed, "change_search_index": changed.select("code", "name", "address", "category", F.col("name").alias("name_norm"))}


def _published(spark, sf_dir) -> Register:
    """The register of customers, published in the folder that the cluster shares."""
    snapshot, changes = _register(spark, sf_dir)
    place = sinks.Publication(spark, f"{_shared(spark)}/register-{uuid.uuid4().hex}", _shared(spark))
    place.publish(snapshot)
    place.publish(changes, "changes")
    return Register(spark, place.path)


def _static(spark, sf_dir) -> static.StaticRegister:
    """The register of customers as static JSON files in the folder that the cluster shares."""
    snapshot, changes = _register(spark, sf_dir)
    bureaus = spark.createDataFrame([("m", "monthly", "https://x"), ("e", "events", "https://y")], "source_id string, bureau_name string, page_url string")
    place = f"{_shared(spark)}/static-{uuid.uuid4().hex}/v1"
    used = spark.createDataFrame([("m", "https://x/1", "sha")], "source_id string, url string, sha256 string").crossJoin(snapshot["facility"].agg(F.max("as_of").alias("as_of")))  # one row each
    more = {"manifest": manifests.global_manifest(snapshot["facility"], snapshot["filing"]), "manifest_source": manifests.source_manifest(bureaus.select("source_id"), snapshot["source"], used)}
    static.export_snapshot({**snapshot, **more}, bureaus, place, "2026-01-01T00:00:00Z")
    e = changes["change_event"]
    documents = e.groupBy("url").agg(F.min("published_at").alias("published_at"), F.min("action").alias("action")).selectExpr("'e' source_id", "'events' bureau_name", "'p' page_url", "url", "'sha' sha256", "published_at", "action")
    total = manifests.change_manifest(e, documents, "1992-01-09")
    static.export_changes({**changes, "change_manifest": total}, documents, "1992-01-09", place, "2026-01-01T00:00:00Z")
    return static.StaticRegister(spark, place)


_EVENTS = f"e as (select {_CODE} code, o_custkey, cast(o_orderdate as date) d, o_orderkey, case when o_orderkey % 2 = 0 then 0 else 1 end act from orders join customer on c_custkey = o_custkey where o_orderkey % 7 = 0)"


_FACILITIES = f"""with f as (select {_CODE} code, c_name, c_mktsegment, {_KIND} kind, date '1992-01-01' + cast(c_custkey % 9 as int) as_of from customer), {_EVENTS}, n as (select code, count(*) n, max(d) latest from e group by 1),
s as (select substr(f.code, 1, 4) prefix, greatest(max(as_of), max(latest)) as_of from f left join n using (code) group by 1)
select f.code, case when n.n is null then c_name else 'changed' end as name, c_mktsegment address, case when n.n is null then kind else 'medical' end category, s.as_of, coalesce(n.n, 0) changes from f left join n using (code) join s on s.prefix = substr(f.code, 1, 4)"""


@query(_FACILITIES)
def register_facilities(spark, sf_dir):
    """All facilities of a published register under its changes: a shard's date, the number of changes."""
    return _published(spark, sf_dir).facilities().select("code", "name", "address", "category", "as_of", F.col("recent_change_count").alias("changes"))


@query(f"""with {_EVENTS}, f as (select {_CODE} code, date '1992-01-01' + cast(c_custkey % 9 as int) as_of from customer), s as (select substr(code, 1, 4) prefix, max(as_of) as_of from f group by 1),
r as (select code, 'https://x/1' url, 'snapshot' kind, s.as_of, null page, 0 seq from f join s on prefix = substr(code, 1, 4) union all
select code, 'https://x/' || cast(o_custkey % 3 as varchar), 'change', d, o_orderkey % 5, row_number() over (partition by code order by d, act, cast(o_orderkey as varchar)) from e),
l as (select *, row_number() over (partition by code, url order by seq desc) r from r)
select code, url, kind, as_of published_at, cast(page as integer) page, case when kind = 'change' then 'text' end extraction_method, case when url like '%/0' then '0' when url like '%/1' then '1' else '2' end as label, case when page > 0 then url || '#page=' || cast(page as varchar) else url end link,
case when exists (select 1 from e where e.code = l.code) then 'e,m' else 'm' end sources from l where r = 1""")
def register_documents(spark, sf_dir):
    """Documents behind each facility with their facts, and the sources of both layers."""
    register = _published(spark, sf_dir)
    sources = register.source_ids().groupBy("code").agg(F.array_join(F.array_sort(F.collect_set("source_id")), ",").alias("sources"))
    return register.provenance().join(sources, "code").select("code", "url", "kind", "published_at", "page", "extraction_method", "label", "link", "sources")


@query(_FACILITIES)
def static_facilities(spark, sf_dir):
    """All facilities of a register that is published as static JSON files and read back, under its changes."""
    return _static(spark, sf_dir).facilities().select("code", "name", "address", "category", "as_of", F.col("recent_change_count").alias("changes"))


_HOLD = f"""with b as (select {_CODE} code, o_orderkey pos, o_orderpriority sid, substr(o_orderpriority, 1, 1) abbr from orders join customer on c_custkey = o_custkey), {{events}},
x as (select e.code, o_orderkey, act, o_orderpriority sid, substr(o_orderpriority, 1, 1) abbr, row_number() over (partition by e.code order by d, act, cast(o_orderkey as varchar)) seq from e join orders using (o_orderkey)),
l as (select code, pos, sid, abbr, 0 seq, 1 act from b union all select code, 0, sid, abbr, seq, act from x)
select code, cast(case when seq = 0 then row_number() over (partition by code, seq order by pos) - 1 else 0 end as integer) pos, sid standard_id, abbr abbreviation, cast(seq as integer) seq from (
select *, max(seq) over (partition by code, sid) m, max(seq) over (partition by code, abbr) a from l) where act = 1 and seq = m and seq = a"""


@query(_HOLD.replace("{events}", _EVENTS).replace("case when seq = 0 then row_number() over (partition by code, seq order by pos) - 1 else 0 end", "p").replace("select code, pos, sid, abbr, 0 seq, 1 act from b", "select code, row_number() over (partition by code order by pos) - 1 p, sid, abbr, 0 seq, 1 act from b"))
def static_filings(spark, sf_dir):
    """Current filings of a register in static JSON files: shards parsed, the dictionary joined, changes replayed."""
    return _static(spark, sf_dir).filings().select("code", "pos", "standard_id", "abbreviation", "seq")


_ASKED = f"""k as (select c_custkey, case c_custkey % 5 when 0 then substr(code, 1, 2) || '-' || substr(code, 3) when 1 then '9999' || code when 2 then '48' || substr(code, 3) when 3 then translate(code, '0123456789', '０１２３４５６７８９') else code end asked,
case when c_custkey % 5 in (0, 3, 4) then code when c_custkey % 5 = 2 then '48' || substr(code, 3) end wanted from (select c_custkey, {_CODE} code from customer) where c_custkey % 11 < 3)"""


@query(f"""with r as ({_FACILITIES}), {_ASKED} select c_custkey, asked, wanted facility_code, name, address, category, as_of, changes from k left join r on r.code = wanted""")
def lookup_many(spark, sf_dir):
    """Facilities for a table of codes in several forms, some malformed and some in neither layer; only shards of their prefixes are read."""
    c, k = _customers(spark, sf_dir).where("c_custkey % 11 < 3"), F.col("c_custkey") % 5
    shaped = F.when(k == 0, F.concat(F.substring("code", 1, 2), F.lit("-"), F.substring("code", 3, 8))).when(k == 1, F.concat(F.lit("9999"), "code")).when(k == 2, F.concat(F.lit("48"), F.substring("code", 3, 8)))
    asked = c.select("c_custkey", shaped.when(k == 3, F.translate("code", "0123456789", "０１２３４５６７８９")).otherwise(F.col("code")).alias("asked"))
    return _published(spark, sf_dir).get_many(asked, "asked").select("c_custkey", "asked", "facility_code", "name", "address", "category", "as_of", F.col("recent_change_count").alias("changes"))


# Names in several scripts and widths, how a search sees them, and queries in several spellings with what they become.
_FIRST = (("さくら", "さくら"), ("サクラ", "サクラ"), ("ｻｸﾗ", "サクラ"), ("桜", "桜"), ("㈱うめだ", "株うめだ"), ("ＡＢＣ", "abc"))
_SECOND = (("診療所", "診療所"), ("ｸﾘﾆｯｸ", "クリニック"), ("病院", "病院"), ("薬局", "薬局"), ("歯科・医院", "歯科医院"), ("①号館", "1号館"))
_ASKS = (("さ", "さ"), ("サクラ", "サクラ"), ("ｻｸﾗ", "サクラ"), ("院", "院"), ("桜　病", "桜病"), ("（株）うめ", "株うめ"), ("Abc", "abc"), ("1号", "1号"), ("ｸﾘﾆｯｸ1", "クリニック1"), ("無", "無"), ("・", ""), ("改1", "改1"), ("さくら診療所さ", "さくら診療所さ"))
_pick = lambda pairs, side, by: f"case {by} {' '.join(f'when {k} then {chr(39)}{p[side]}{chr(39)}' for k, p in enumerate(pairs))} end"
_NAMED = ", ".join(f"{_pick(_FIRST, side, 'c_custkey % 6')} || {chr(39) + '　' + chr(39) if not side else chr(39) * 2} || {_pick(_SECOND, side, '(c_custkey // 6) % 6')} || cast(c_custkey as varchar) {n}" for side, n in ((0, "name"), (1, "norm")))


@query(f"""with f as (select c_custkey, {_CODE} code, {_KIND} category, {_NAMED} from customer), i as (select code, case when c_custkey % 10 = 0 then 'ｻｸﾗ改' || cast(c_custkey as varchar) else name end as name, case when c_custkey % 10 = 0 then 'サクラ改' || cast(c_custkey as varchar) else norm end as norm, category from f),
q as (select * from (values {', '.join(f"('{a}', '{b}')" for a, b in _ASKS)}) v(query, norm)) select query, code, name, category from q join i on q.norm <> '' and contains(i.norm, q.norm)""")
def search_spellings(spark, sf_dir):
    """Facilities for queries in several spellings over names in several scripts, by lists of character runs of a published register and
    of its changes."""
    named = _customers(spark, sf_dir).selectExpr("c_custkey", "code", "category", "cast(null as string) address", *[x.replace("varchar", "string").replace("(c_custkey // 6) % 6", "cast(floor(c_custkey / 6) as long) % 6") for x in _NAMED.split(", ")[:1]])
    index = named.select("code", "name", "address", "category", text.facility_name(F.col("name")).alias("name_norm"))
    changed = named.where("c_custkey % 10 = 0").selectExpr("code", "'ｻｸﾗ改' || cast(c_custkey as string) name", "address", "category").withColumn("name_norm", text.facility_name(F.col("name")))
    place = sinks.Publication(spark, f"{_shared(spark)}/names-{uuid.uuid4().hex}", _shared(spark))
    sides = [(t, kept(name_index.lists(t))) for t in (index, changed)]
    place.publish({"search_index": index, "name_list": sides[0][1], "name_length": name_index.lengths(sides[0][1])})
    place.publish({"change_search_index": changed, "change_name_list": sides[1][1], "change_name_length": name_index.lengths(sides[1][1])}, "changes")
    return Register(spark, place.path).search_many(spark.createDataFrame([(a,) for a, _ in _ASKS], "query string")).select("query", "code", "name", "category")


@query("""with s as (select s_suppkey k, 1 + cast(s_suppkey % 27 as int) d, 'https://k.mhlw.go.jp/a/' || cast(s_suppkey as varchar) || '/' base from supplier)
select k s_suppkey, base || 'r_ika.pdf' url, make_date(2026, 8, d + 1) published_at, 'medical' category, 'upsert' as action from s union all select k, base || 's_shika.pdf', make_date(2026, 8, d), 'dental', 'remove' from s""")
def row_dates(spark, sf_dir):
    """Notices whose date stands in a table row above theirs: the nearest row with a date counts, and the latest date in it."""
    row = lambda *cells: "<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"
    day = lambda month, plus: f"令和8年{month}月' || cast(1 + s_suppkey % 27 + {plus} as string) || '日"
    table_ = row(day(9, 0)) + row(day(8, 1), day(7, 0)) + row("見出し") + row('医科 <a href="r_ika.pdf">新規</a>') + row(day(7, 1), day(8, 0)) + row('歯科 <a href="s_shika.pdf">辞退</a>')
    pages = _pages(spark, sf_dir, f"'<h2>令和8年7月1日</h2><table>{table_}</table>'", prefecture_code_hint="'13'", document_url_pattern="cast(null as string)", document_context_pattern="cast(null as string)")
    found = discovery.change_documents(pages, "2026-07-31")
    return found.select(F.col("source_id").cast("bigint").alias("s_suppkey"), "url", "published_at", "category", "action")


@query("""select s_suppkey, case when s_suppkey % 3 = 0 then '一覧' || cast(s_suppkey % 10 as varchar) || '.xlsx' when s_suppkey % 3 = 1 then '医科ｶﾅ' || cast(s_suppkey % 10 as varchar) || '.xlsx' else 'plain' || cast(s_suppkey % 10 as varchar) || '.xlsx' end workbook, s_name as value from supplier""")
def archive_names(spark, sf_dir):
    """Names of workbooks in archives, in UTF-8 where the archive says so and else in Shift_JIS, read from the files themselves."""

    def render(frames):
        for frame in frames:
            rows = []
            for k, name in zip(frame["k"], frame["s_name"], strict=True):
                inner = f"{('一覧', '医科ｶﾅ', 'plain')[k % 3]}{k % 10}.xlsx"
                coded = inner.encode("shift_jis")
                out = io.BytesIO()
                with zipfile.ZipFile(out, "w") as z:
                    z.writestr(inner if k % 3 == 0 else "n" * len(coded), _book({1: {1: name}}))
                data = out.getvalue() if k % 3 == 0 else out.getvalue().replace(b"n" * len(coded), coded)  # zipfile itself writes UTF-8 only
                rows.append((f"https://x/{k}/l.zip", data))
            yield pd.DataFrame(rows, columns=["document_url", "content"])

    files = _dealt(table(spark, sf_dir, "supplier").selectExpr("s_suppkey k", "s_name"), "k").mapInPandas(render, "document_url string, content binary")
    place = f"{_shared(spark)}/archives-{uuid.uuid4().hex}"
    sheet_source.write_files(files, place)
    rows = sheet_source.read_sheets(spark, place, [1]).where("row_number <= 1")
    return rows.select(F.regexp_extract("document_url", "x/([0-9]+)/", 1).cast("bigint").alias("s_suppkey"), "workbook", F.element_at("cells", 1).alias("value"))


# Texts in odd forms, what normalisation makes of them, and that without white space, colons, middle dots and brackets.
_ODD = (("ｻｸﾗ　診療所", "サクラ 診療所", "サクラ診療所"), ("㈱①号", "(株)1号", "株1号"), ("Ａ－１２：３", "A-12:3", "A-123"), ("が・カ゛", "が・カ ゙", "がガ"), ("　【ﾊﾟ】［x］ ", "【パ】[x]", "パ[x]"), ("㍿㌔Ⅳ", "株式会社キロIV", "株式会社キロIV"), ("﻿a b", "a b", "ab"))


@query(f"""select o_orderkey, {' || '.join(['case o_orderkey % 7 ' + ' '.join(f"when {k} then '{x[0]}'" for k, x in enumerate(_ODD)) + ' end'])} || cast(o_orderkey as varchar) raw,
case o_orderkey % 7 {' '.join(f"when {k} then '{x[1] + (' ' if x[0].endswith(' ') else '')}'" for k, x in enumerate(_ODD))} end || cast(o_orderkey as varchar) as normal, case o_orderkey % 7 {' '.join(f"when {k} then '{x[2]}'" for k, x in enumerate(_ODD))} end || cast(o_orderkey as varchar) compact from orders""")
def odd_forms(spark, sf_dir):
    """Normalised and compact text of half and full width, ligatures, circled digits, voicing marks, and white space of all kinds."""
    pieces = F.element_at(F.array(*[F.lit(x[0]) for x in _ODD]), (F.col("o_orderkey") % 7 + 1).cast("int"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(pieces, F.col("o_orderkey").cast("string")).alias("raw"))
    return rows.withColumn("normal", text.normalize_text(F.col("raw"))).withColumn("compact", text.compact(F.col("normal")))


# Names in Japanese order; equal places are equal in that order.
_PLACES = (("1号", 1), ("abc", 2), ("あい", 3), ("アイ", 3), ("ｱｲ", 3), ("あいう", 4), ("うめだ", 5), ("ウメダ", 5), ("か", 6), ("が", 7), ("さくら", 8), ("サクラ", 8), ("医院", 9), ("桜", 10), ("大阪", 11), ("東京", 12), ("梅田", 13), ("薬局", 14))


@query(f"""with v as (select * from (values {', '.join(f"({k}, '{n}', {p})" for k, (n, p) in enumerate(_PLACES))}) v(k, name, place)) select o_custkey code, o_orderkey, name,
row_number() over (partition by o_custkey order by place, o_orderkey) as in_code, row_number() over (order by place, o_orderkey) as in_all from orders join v on k = o_orderkey % {len(_PLACES)}""")
def japanese_order(spark, sf_dir):
    """Places of names in kana, kanji and mixed widths in Japanese order: within each code by a sorted array, and among all by ranges."""
    name = F.element_at(F.array(*[F.lit(n) for n, _ in _PLACES]), (F.col("o_orderkey") % len(_PLACES) + 1).cast("int"))
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("code"), "o_orderkey", name.alias("standard_name"))
    listed = o.groupBy("code").agg(search.in_order(F.struct(F.col("standard_name"), F.col("o_orderkey")), "standard_name", "o_orderkey").alias("s")).select("code", F.posexplode("s").alias("p", "s"))
    own = listed.select("code", "s.o_orderkey", F.col("s.standard_name").alias("name"), (F.col("p") + 1).cast("bigint").alias("in_code"))
    every = merge.placed(o.select(F.lit("all").alias("code"), search.name_key("standard_name").alias("key"), "o_orderkey"), "key", "o_orderkey")
    return own.join(every.select("o_orderkey", (F.col("pos") + 1).cast("bigint").alias("in_all")), "o_orderkey")


@query("""with r as (select l_orderkey code, l_linenumber ord, p pos, l_returnflag || cast(p // 2 as varchar) abbr from lineitem, (values (0), (1), (2)) v(p)), f as (select code, min(ord) first from r group by 1),
k as (select code, abbr, min(ord * 10 + pos) o from r group by 1, 2) select r.code, r.ord, r.pos, r.abbr abbreviation from r join f using (code) where ord = first union all
select k.code, k.o // 10, k.o % 10, k.abbr from k join f using (code) where k.o // 10 > first""")
def first_row_filings(spark, sf_dir):
    """Filings that repeat within a code's first row stay, as published registers have them; later rows add what is new."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("code"), F.col("l_linenumber").alias("ord"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("pos"), "l_returnflag")
    rows = rows.withColumns({"abbreviation": F.concat("l_returnflag", F.floor(F.col("pos") / 2).cast("string")), "standard_name": F.lit(None).cast("string"), "acceptance_number": F.lit(""), "effective_from": F.lit(None).cast("date")})
    return merge.distinct_filings(rows.drop("l_returnflag")).select("code", "ord", "pos", "abbreviation")


@query(f"""with f as (select {_CODE} code, c_name name from customer) select code, name, (select count(*) from f g where g.code < f.code) as before from f where code >= '04' and code <= '0640001000'""")
def code_range(spark, sf_dir):
    """Facilities of a range of codes from a table in order of codes: the files that overlap the range are opened, and places follow
    from the files before them."""
    ordered = OrderedTable(spark, f"{_shared(spark)}/ordered-{uuid.uuid4().hex}")
    ordered.write(_customers(spark, sf_dir).select("code", F.col("c_name").alias("name")), "code", files=8)
    found = merge.placed(ordered.between("04", "0640001000").select("code", "name", F.lit("all").alias("every")).withColumnRenamed("code", "own").withColumnRenamed("every", "code"), "own")
    return found.select(F.col("own").alias("code"), "name", (F.col("pos") + ordered.before("04")).cast("bigint").alias("before"))


@query("""select s_suppkey, case s_suppkey % 3 when 0 then '131' else '273' end || lpad(cast(s_suppkey % 100000 as varchar), 7, '0') code, '別 ' || s_name as name, '港区' address, '乙,甲,丁,丙' standards, '第2号,第' || cast(s_suppkey % 100000 as varchar) || '号,,第' || cast(s_suppkey % 100000 as varchar) || '号' numbers, 1 worksheets from supplier where s_suppkey % 3 < 2""")
def workbook_records(spark, sf_dir):
    """A record for each code of a workbook: its longest name, first address, and filings in Japanese order of abbreviations."""
    found, _ = _records(spark, sf_dir)
    rows = sheets.workbook_records(found)
    each = lambda c: F.array_join(F.transform("standards", lambda s: s[c]), ",")
    return rows.select(F.regexp_extract("document_url", "([0-9]+)[.]xlsx", 1).cast("bigint").alias("s_suppkey"), "code", "name", "address", each("abbreviation").alias("standards"), each("acceptance_number").alias("numbers"), F.size("worksheets").alias("worksheets"))
