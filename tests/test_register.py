import io
import zipfile
from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sakuin.operators import discovery, manifests, merge, positioned, replay, sheets
from sakuin.plans import sinks
from sakuin.plans.client import LAYERS, Register
from sakuin.plans.static import StaticRegister
from sakuin.sources import registers, workbooks

HEADS = ["項番", "医療機関番号", "医療機関名称", "医療機関所在地", "受理届出名称", "受理記号", "受理番号", "算定開始年月日"]


def book(rows: dict[int, list]) -> bytes:
    def cell(r, c, v):
        return f'<c r="{chr(65 + c)}{r}" t="inlineStr"><is><t>{v}</t></is></c>'

    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    sheet = "".join(f'<row r="{r}">' + "".join(cell(r, c, v) for c, v in enumerate(vs) if v) + "</row>" for r, vs in rows.items())
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="医科" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{sheet}</sheetData></worksheet>")
    return out.getvalue()


ROWS = {
    1: ["福井県 医科"], 2: [], 3: HEADS,
    4: ["1", "01-15202", "さくら診療所", "福井県福井市", "外来感染対策向上加算", "外来感染", "(外来感染)第109号", "令和7年1月1日"],
    5: ["", "", "", "", "連携強化加算", "連携強化", "(連携強化)第50号", "令和6年6月1日"],
}


def test_workbook_to_filings(spark):
    docs = spark.createDataFrame([("https://x/fukui_ika.xlsx", bytearray(book(ROWS)), "s")], "document_url string, content binary, sha256 string")
    rows = workbooks.worksheet_rows(workbooks.workbooks(docs))
    meta = spark.createDataFrame([("https://x/fukui_ika.xlsx", "kinki", "近畿", "p", date(2026, 7, 1), "medical", "", "s")], "document_url string, source_id string, bureau_name string, page_url string, as_of date, category_hint string, context string, sha256 string")
    good, bad = sheets.records(rows, meta, registers.PREFECTURES)
    got = sorted((r["code"], r["name"], r["address"], r["abbreviation"], r["standard_name"], r["acceptance_number"], r["effective_from"]) for r in good.collect())
    assert got == [
        ("1810115202", "さくら診療所", "福井県福井市", "外来感染", "外来感染対策向上加算", "第109号", date(2025, 1, 1)),
        ("1810115202", "さくら診療所", "福井県福井市", "連携強化", "連携強化加算", "第50号", date(2024, 6, 1)),
    ]
    assert bad.count() == 0
    merged = merge.merge_facilities(good).collect()
    assert [(r["code"], r["category"], r["local_code"]) for r in merged] == [("1810115202", "medical", "0115202")]


def test_archives(spark):
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("a/b.xlsx", book(ROWS)), z.writestr("__MACOSX/x.xlsx", b""), z.writestr("readme.txt", b"")
    docs = spark.createDataFrame([("u/list.zip", bytearray(inner.getvalue()), "s")], "document_url string, content binary, sha256 string")
    assert [r["workbook"] for r in workbooks.workbooks(docs).collect()] == ["b.xlsx"]
    for name in ("../x.xlsx", "x.xls"):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr(name, b"")
        with pytest.raises(ValueError):
            list(workbooks._books("l.zip", out.getvalue()))
    with pytest.raises(ValueError):
        list(workbooks._books("old.xls", b""))


def test_oversized_files_are_an_error(spark):
    files = spark.createDataFrame([("u/a.xlsx", 3, bytearray(b"abc")), ("u/big.xlsx", 4, bytearray(b"abcd"))], "path string, length long, content binary")
    assert workbooks.documents(files, 4).count() == 2
    with pytest.raises(Exception, match="u/big.xlsx is larger than 3 bytes"):
        workbooks.documents(files, 3).collect()
    with pytest.raises(Exception, match="u/big.xlsx is larger than 3 bytes"):
        workbooks.within(files, F.octet_length("content"), "path", 3).select("path").collect()


def test_zip_explode(spark):
    rows = spark.createDataFrame([(1, "(甲)第1号\n(乙)第2号", "一\n二", "x", "令和6年1月1日"), (2, "(甲)第1号(乙)", "一", "x", "2024/1/1 2024/1/2 2024/1/3"), (3, "", "一", "略", "45658"), (4, "", "", "略", "")], "k int, c_acceptance string, c_standard_name string, c_abbreviation string, c_effective_from string")
    got = [tuple(r) for r in sheets.filings(rows).orderBy("k", "pos").select("k", "pos", "abbreviation", "standard_name", "acceptance_number", "effective_from").collect()]
    d = date(2024, 1, 1)
    assert got == [(1, 0, "甲", "一", "第1号", d), (1, 1, "乙", "二", "第2号", d), (2, 0, "甲", None, "第1号", None), (2, 1, "乙", None, "", None), (3, 0, "略", "一", "", date(2025, 1, 1))]


def test_merge_rules(spark):
    rows = spark.createDataFrame([("c", 1, "ab", None), ("c", 2, "cd", "x"), ("c", 3, "𠮷", "y"), ("c", 4, "abc", None)], "code string, ord int, name string, address string")
    rows = rows.withColumns({"category": F.lit("medical"), "prefecture_code": F.lit("18"), "local_code": F.lit("1"), "as_of": F.lit("2026-07-01").cast("date")})
    r = merge.merge_facilities(rows).first()
    assert (r["name"], r["address"]) == ("abc", "x")
    assert merge.merge_facilities(rows.where("ord < 4")).first()["name"] == "ab"
    f = spark.createDataFrame([("c", 1, 0, "a", None), ("c", 1, 1, "a", ""), ("c", 2, 0, "a", None), ("c", 2, 1, "b", None), ("c", 3, 0, "b", "")], "code string, ord int, pos int, abbreviation string, standard_name string").withColumns({"acceptance_number": F.lit(""), "effective_from": F.lit(None).cast("date")})
    assert sorted((r["ord"], r["pos"]) for r in merge.distinct_filings(f).collect()) == [(1, 0), (1, 1), (2, 1)]
    assert sorted((r["ord"], r["pos"]) for r in merge.distinct_filings(f, keep_first_row=False).collect()) == [(1, 0), (2, 1)]


def fold(base, events):
    held = [(b["standard_id"], b["abbreviation"], "base", b["pos"]) for b in base]
    for k, e in enumerate(sorted(events, key=lambda e: (e["published_at"], e["action"] != "remove", e["id"])), 1):
        held = [h for h in held if h[0] != e["standard_id"] and not (e["abbreviation"] and h[1] == e["abbreviation"])]
        if e["action"] == "upsert":
            held.append((e["standard_id"], e["abbreviation"], "event", k))
    return held


_id, _abbr = st.sampled_from("abcd"), st.sampled_from(["x", "y", "", None])


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.lists(st.tuples(_id, _abbr), max_size=4), st.lists(st.tuples(_id, _abbr, st.sampled_from(["upsert", "remove"]), st.integers(1, 3)), max_size=6)), min_size=1, max_size=12))
def test_replay_equals_fold(spark, cases):
    base, events, expected = [], [], set()
    for c, (b, e) in enumerate(cases):
        mine = [{"code": str(c), "pos": k, "standard_id": i, "abbreviation": a} for k, (i, a) in enumerate(b)]
        log = [{"code": str(c), "id": f"{k:02d}", "standard_id": i, "abbreviation": a, "action": x, "published_at": date(2026, 7, d)} for k, (i, a, x, d) in enumerate(e)]
        expected |= {(str(c), *h) for h in fold(mine, log)}
        base, events = base + mine, events + log
    got = replay.replay(spark.createDataFrame(base, "code string, pos int, standard_id string, abbreviation string"), spark.createDataFrame(events, "code string, id string, standard_id string, abbreviation string, action string, published_at date"))
    assert {(r["code"], r["standard_id"], r["abbreviation"], "event" if r["seq"] else "base", r["seq"] or r["pos"]) for r in got.collect()} == expected


MONTHLY = """<body><h1>届出受理医療機関名簿</h1><h2>令和8年7月1日現在</h2><ul><li>医科 <a href="latest_ika.xlsx">医科</a></li><li>歯科 <a href="latest_shika.zip">歯科</a></li></ul>
<h2>訪問看護</h2><p><a href="houmon_ika.xlsx">一覧</a></p><h2>令和8年6月1日現在</h2><p>医科 <a href="old_ika.xlsx">医科</a></p></body>"""


def test_monthly_discovery(spark):
    pages = spark.createDataFrame([("kinki", "近畿", "https://k.mhlw.go.jp/a/i.html", registers.TARGET_SECTION, registers.EXCLUDED_SECTION, MONTHLY)], "source_id string, bureau_name string, page_url string, target_section string, excluded_section string, html string")
    got = sorted((r["url"], r["category"], r["as_of"]) for r in discovery.monthly_documents(pages).collect())
    assert got == [("https://k.mhlw.go.jp/a/latest_ika.xlsx", "medical", date(2026, 7, 1)), ("https://k.mhlw.go.jp/a/latest_shika.zip", "dental", date(2026, 7, 1))]


CHANGES = """<body><h2>令和8年7月15日掲載</h2><table><tr><th>医科</th><th>歯科</th><th>薬局</th><th>訪問看護</th></tr>
<tr><td><a href="new_ika.pdf">新規・変更</a></td><td><a href="remove_shika.pdf">辞退</a></td><td><a href="new_yakkyoku.pdf">新規・変更</a></td><td><a href="houkan.pdf">訪問看護</a></td></tr></table>
<p><a href="help_ika.pdf">PDFファイル内を検索する方法</a></p><h2>令和8年6月15日掲載</h2><p><a href="old_ika.pdf">医科 新規</a></p></body>"""


def test_change_discovery(spark):
    pages = spark.createDataFrame([("kinki", "近畿", "https://k.mhlw.go.jp/a/i.html", None, None, None, CHANGES)], "source_id string, bureau_name string, page_url string, prefecture_code_hint string, document_url_pattern string, document_context_pattern string, html string")
    got = sorted((r["url"].rsplit("/", 1)[1], r["category"], r["action"], r["published_at"]) for r in discovery.change_documents(pages, "2026-07-01").collect())
    d = date(2026, 7, 15)
    assert got == [("new_ika.pdf", "medical", "upsert", d), ("new_yakkyoku.pdf", "pharmacy", "upsert", d), ("remove_shika.pdf", "dental", "remove", d)]


UPSERT = [(10, 50, "医療機関番号"), (100, 50, "医療機関 名称"), (220, 50, "所 在 地"), (380, 50, "受理内容"), (10, 80, "01,2345,6"), (100, 80, "テスト"), (100, 90, "診療所"), (200, 80, "〒123-4567"), (200, 90, "東京都港区"), (380, 80, "外来感染対策向上加算"), (410, 90, "(外来感染)第109号"), (600, 90, "令和8年7月1日"), (380, 100, "連携強化加算"), (410, 110, "(連携強化)第50号"), (600, 110, "令和8年7月1日")]
REMOVE = [(10, 50, "医療機関番号"), (100, 50, "医療機関名称"), (220, 50, "所在地"), (500, 50, "辞退内容"), (640, 50, "辞退事由"), (10, 80, "01-23456"), (100, 80, "テスト診療所"), (200, 80, "東京都"), (493, 80, "外来感染"), (645, 80, "令和8年7月1日")]


def events_of(spark, items, action):
    frame = spark.createDataFrame([("d", 1, float(x), float(y), t, False) for x, y, t in items], "document_url string, page int, x double, y double, text string, ocr boolean")
    docs = spark.createDataFrame([("d", "s", "kanto-shinetsu", "p", date(2026, 7, 15), action, "medical", "13", "医科")], "document_url string, sha256 string, source_id string, page_url string, published_at date, action string, category_hint string, prefecture_code_hint string, context string")
    events, pages = positioned.change_events(frame, docs, registers.PREFECTURES)
    return sorted(events.collect(), key=lambda r: r["line"]), pages.collect()


def test_positioned_upsert(spark):
    events, pages = events_of(spark, UPSERT, "upsert")
    assert [(e["code"], e["name"], e["address"], e["abbreviation"], e["standard_name"], e["acceptance_number"], e["effective_from"]) for e in events] == [
        ("1310123456", "テスト 診療所", "東京都港区", "外来感染", "外来感染対策向上加算", "第109号", date(2026, 7, 1)),
        ("1310123456", "テスト 診療所", "東京都港区", "連携強化", "連携強化加算", "第50号", date(2026, 7, 1)),
    ]
    assert [(p["accepted"], p["parsed"]) for p in pages] == [(2, 2)]


def test_positioned_remove(spark):
    events, _ = events_of(spark, REMOVE, "remove")
    assert [(e["code"], e["action"], e["abbreviation"], e["standard_name"], e["acceptance_number"], e["effective_from"]) for e in events] == [("1310123456", "remove", "外来感染", None, "", date(2026, 7, 1))]


def test_publish_and_query(spark, tmp_path):
    d, rows = date(2026, 7, 1), lambda name, *r: spark.createDataFrame(list(r), LAYERS[name])
    c = "1810115202"
    tables = {
        "facility": rows("facility", (c, "さくら診療所", "福井県福井市", "medical", d)),
        "filing": rows("filing", (c, 0, "old", "第1号", d), (c, 1, "kept", "第2号", d)),
        "source": rows("source", (c, "https://monthly", "kinki")),
        "catalog": rows("catalog", ("old", "旧", None), ("kept", "継続", None)),
        "search_index": rows("search_index", ("1310123456", "中央さくら病院", "東京都", "medical", "中央さくら病院"), (c, "さくら診療所", "福井県福井市", "medical", "さくら診療所"), ("2710123456", "うめだ薬局", "大阪府", "pharmacy", "うめだ薬局")),
    }
    place = sinks.Publication(spark, f"{tmp_path}/out/v1", f"{tmp_path}/out")
    assert place.current() == {}
    with pytest.raises(ValueError):
        Register(spark, place.path).get(c)
    first = place.publish(tables)
    assert place.current() == first
    register = Register(spark, place.path)
    assert register.change_manifest() is None
    assert [s["standard_id"] for s in register.get(c)["standards"]] == ["old", "kept"]
    assert register.get("1310123456") is None
    events = rows("change_event", (c, "1", "remove", date(2026, 7, 10), "old", "旧", None, "", None, "https://remove/a%20b.pdf", "kinki", "p", 3, "ocr"), (c, "2", "upsert", date(2026, 7, 15), "new", "新", None, "第3号", date(2026, 7, 15), "https://monthly", "other", "p", 1, "text"))
    changed = {"change_event": events, "change_facility": rows("change_facility", (c, "さくら診療所", None, "medical", date(2026, 7, 15))), "change_search_index": rows("change_search_index")}
    both = place.publish(changed, "changes")
    assert both["snapshot"] == first["snapshot"] and place.current() == both
    assert register.get(c)["recent_change_count"] == 0
    register.clear_cache()
    got = register.get("18-1011-5202")
    assert [s["standard_id"] for s in got["standards"]] == ["kept", "new"] and got["by_name"] == ["kept", "new"]
    assert (got["as_of"], got["recent_change_count"], got["address"], got["category_label"]) == (date(2026, 7, 15), 2, "福井県福井市", "医科")
    assert [(x["url"], x["kind"], x["published_at"], x["page"], x["extraction_method"], x["label"], x["link"]) for x in got["documents"]] == [
        ("https://monthly", "change", date(2026, 7, 15), 1, "text", "https://monthly", "https://monthly#page=1"),
        ("https://remove/a%20b.pdf", "change", date(2026, 7, 10), 3, "ocr", "a b.pdf", "https://remove/a%20b.pdf#page=3"),
    ]
    assert got["source_ids"] == ["kinki", "other"]
    total, hits = register.lookup("さくら", limit=1)
    assert (total, hits[0]["name"]) == (2, "さくら診療所")
    assert register.search_by_name("・") == (0, [])
    with pytest.raises(ValueError):
        register.get("x")
    with pytest.raises(ValueError):
        sinks.Publication(spark, "/tmp", "/tmp")
    place.publish(tables)  # a new snapshot ends the changes
    register.clear_cache()
    assert register.get(c)["recent_change_count"] == 0 and set(place.current()) == {"snapshot"}
    assert [x["kind"] for x in register.get(c)["documents"]] == ["snapshot"] and register.get(c)["documents"][0]["published_at"] == d


def test_gates(spark):
    f = spark.createDataFrame([("a", "medical"), ("b", "dental")], "code string, category string")
    src = spark.createDataFrame([("s1",), ("s2",)], "source_id string")
    fs = spark.createDataFrame([("s1", "a"), ("s1", "b")], "source_id string, code string")
    docs = spark.createDataFrame([("s1", "u")], "source_id string, url string")
    got = {(r["gate"], r["subject"]): r["passed"] for r in manifests.gates(f, fs, docs, src, minimum=2).collect()}
    assert got[("minimum", "facilities")] and not got[("documents", "s2")] and not got[("category", "pharmacy")] and got[("source", "s1")]
    with pytest.raises(ValueError):
        manifests.require(manifests.gates(f, fs, docs, src, minimum=2))
    rates = spark.createDataFrame([("d1", 10, 9), ("d2", 100, 89), ("d3", 0, 0)], "document_url string, accepted int, parsed int")
    assert {r["document_url"]: r["passed"] for r in manifests.parse_rates(rates).collect()} == {"d1": True, "d2": False, "d3": False}


def test_stream(spark, tmp_path):
    from sakuin.streaming import deltas

    schema = "code string, id string, action string, published_at date, standard_id string, abbreviation string"
    events = spark.createDataFrame([("c", "1", "upsert", date(2026, 7, 2), "n", "新"), ("c", "2", "remove", date(2026, 7, 3), "o", None)], schema)
    events.write.parquet(f"{tmp_path}/in")
    deltas.append_events(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), f"{tmp_path}/log", f"{tmp_path}/ck").awaitTermination()
    base = spark.createDataFrame([("c", 0, "o", "旧"), ("c", 1, "k", "継")], "code string, pos int, standard_id string, abbreviation string")
    got = deltas.current_filings(base, spark.read.parquet(f"{tmp_path}/log"))
    assert sorted(r["standard_id"] for r in got.collect()) == ["k", "n"]


def test_shard_json(spark):
    f = spark.createDataFrame([("1810115202", "n", None, "medical", date(2026, 7, 1))], LAYERS["facility"])
    s = spark.createDataFrame([("1810115202", 0, "id", "第1号", None)], "code string, ord int, standard_id string, acceptance_number string, effective_from date")
    src = spark.createDataFrame([("1810115202", "kinki", "u")], "code string, source_id string, document_url string")
    got = sinks.shard_json(f, s, src).first()
    assert got["prefix"] == "1810" and '"standards":[["id","第1号",null]]' in got["value"] and '"address":null' in got["value"]


def test_other_json(spark):
    f = spark.createDataFrame([("1810115202", "n", None, "medical")], "code string, name string, address string, category string")
    e = spark.createDataFrame([("1810115202", "2", "upsert", date(2026, 7, 3), "s", "a", None, "第1号", None, "u", "k", "p", 1, "text"), ("1810115202", "9", "remove", date(2026, 7, 3), "s", "a", None, "", None, "u", "k", "p", 1, "text")], LAYERS["change_event"])
    got = sinks.change_shard_json(f, e, "2026-07-01").first()
    assert got["prefix"] == "1810" and got["value"].startswith('{"schemaVersion":1,"baseAsOf":"2026-07-01","latestAsOf":"2026-07-03","prefix":"1810","facilities":{"1810115202":{"name":"n","address":null,')
    assert got["value"].index('"id":"9"') < got["value"].index('"id":"2"')
    with pytest.raises(Exception, match="a shard without a date: 1810"):
        sinks.shard_json(f.withColumn("as_of", F.lit(None).cast("date")), spark.createDataFrame([], "code string, ord int, standard_id string, acceptance_number string, effective_from date"), spark.createDataFrame([], "code string, source_id string, document_url string")).collect()
    catalog = spark.createDataFrame([("abcd", "x", None), ("abff", None, "y"), ("0000", "z", "w")], LAYERS["catalog"])
    assert {r["part"]: r["value"] for r in sinks.catalog_json(catalog).collect()} == {"ab": '{"schemaVersion":1,"standards":{"abcd":{"abbreviation":"x","name":null},"abff":{"abbreviation":null,"name":"y"}}}', "00": '{"schemaVersion":1,"standards":{"0000":{"abbreviation":"z","name":"w"}}}'}
    assert sinks.search_json(f).first()["value"] == '{"schemaVersion":1,"prefix":"1810","facilityCount":1,"facilities":[["1810115202","n",null,"medical"]]}'


def test_command_line_keeps_both_layers(spark, tmp_path, capsys):
    from sakuin.plans import cli

    kinki = next(registers.HOST + p for i, _, p in registers.BUREAUS if i == "kinki")
    monthly = "<h1>届出受理医療機関名簿</h1><h2>令和8年7月1日現在</h2><ul>" + "".join(f'<li>{n} <a href="/x/fukui_{k}.xlsx">{n}</a></li>' for n, k in (("医科", "ika"), ("歯科", "shika"), ("薬局", "yakkyoku"))) + "</ul>"
    spark.createDataFrame([(kinki, monthly)], "page_url string, html string").write.parquet(f"{tmp_path}/pages")
    sheet = lambda k, n: {1: [f"福井県 {k}"], 3: HEADS, 4: ["1", f"01-1520{n}", f"さくら{k}", "福井県福井市", "外来感染対策向上加算", "外来感染", "(外来感染)第109号", "令和7年1月1日"]}
    files = [(f"{registers.HOST}/x/fukui_{f}.xlsx", bytearray(book(sheet(k, n)))) for n, (k, f) in enumerate((("医科", "ika"), ("歯科", "shika"), ("薬局", "yakkyoku")))]
    spark.createDataFrame(files, "document_url string, content binary").write.parquet(f"{tmp_path}/files")
    update = ["update", "--pages", f"{tmp_path}/pages", "--files", f"{tmp_path}/files", "--out", f"{tmp_path}/out/v1", "--json", f"{tmp_path}/json"]
    with pytest.raises(ValueError, match="minimum"):
        cli.main(update, spark)
    cli.main([*update, "--min-facilities", "3"], spark)
    assert '"facility_count":3' in capsys.readouterr().out
    page = next(registers.HOST + p for i, p, *_ in registers.CHANGE_PAGES if i == "kinki")
    notice = '<h2>令和8年7月15日掲載</h2><p><a href="/y/todokedejuri_fukui_ika.pdf">医科 新規</a></p>'
    spark.createDataFrame([(page, notice)], "page_url string, html string").write.parquet(f"{tmp_path}/notices")
    items = [(f"{registers.HOST}/y/todokedejuri_fukui_ika.pdf", "sha", 1, float(x), float(y), t.replace("01,2345,6", "1810115200"), False) for x, y, t in UPSERT]
    spark.createDataFrame(items, "document_url string, sha256 string, page int, x double, y double, text string, ocr boolean").write.parquet(f"{tmp_path}/items")
    cli.main(["update-recent", "--pages", f"{tmp_path}/notices", "--files", f"{tmp_path}/items", "--out", f"{tmp_path}/out/v1", "--json", f"{tmp_path}/json"], spark)
    assert '"event_count":2' in capsys.readouterr().out
    register = Register(spark, f"{tmp_path}/out/v1")
    got = register.get("1810115200")
    assert got["name"] == "テスト 診療所" and got["recent_change_count"] == 2 and got["as_of"] == date(2026, 7, 15)
    assert {s["acceptance_number"] for s in got["standards"]} == {"第109号", "第50号"} and {x["kind"] for x in got["documents"]} == {"snapshot", "change"}
    assert register.get("1830115201")["recent_change_count"] == 0 and "prefix" in register.table("facility").columns
    assert sorted(p.name for p in (tmp_path / "json" / "facilities").iterdir() if p.suffix == ".json") == ["1810.json", "1830.json", "1840.json"]
    files = StaticRegister(spark, f"{tmp_path}/json")
    assert files.get("1810115200") == got and files.manifest().first()["facility_count"] == 3 and files.change_manifest().first()["sources"][0]["documents"][0]["action"] == "upsert"
    elsewhere = ["update-recent", "--pages", f"{tmp_path}/notices", "--files", f"{tmp_path}/items", "--out", f"{tmp_path}/out/v1", "--manifest", f"{tmp_path}/json/manifest.json"]
    cli.main(elsewhere, spark)  # the base date comes from the published JSON
    assert '"event_count":2' in capsys.readouterr().out


def test_dimensions(spark):
    assert registers.change_pages(spark).count() == 24 and registers.bureau_prefectures(spark).count() == 47
    assert [c for c, _ in registers.PREFECTURES] == [f"{k:02d}" for k in range(1, 48)]


def test_recognised_words(spark):
    rows = spark.createDataFrame([("①２。", True, 80), ("sure", True, None), ("unsure", True, 24), ("①", False, 3)], "text string, ocr boolean, confidence int")
    assert [r["text"] for r in positioned.recognised(rows).collect()] == ["1２.", "sure", "①"]


def test_dates_must_be_known(spark):
    m = spark.createDataFrame([(None,)], "as_of date")
    s = spark.createDataFrame([("a", date(2026, 7, 1)), ("b", None)], "source_id string, as_of date")
    assert {(r["subject"], r["passed"]) for r in manifests.date_gates(m, s).collect()} == {("register", False), ("a", True), ("b", False)}
    found = spark.createDataFrame([("a", "u", date(2026, 7, 1)), ("b", "v", None)], "source_id string, url string, as_of date")
    got = {(r["gate"], r["subject"]): r["passed"] for r in manifests.discovery_gates(found, spark.createDataFrame([("a",), ("b",), ("c",)], "source_id string")).collect()}
    assert got == {("page date", "a"): True, ("page links", "a"): True, ("page date", "b"): False, ("page links", "b"): True, ("page date", "c"): False, ("page links", "c"): False}


def test_all_queries_are_registered():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 30


def test_update_summary_reads_all_customers(spark, tmp_path):
    import __spark_entry__ as entry

    tables = {
        "nation": spark.createDataFrame([(0,), (1,), (2,)], "n_nationkey int"),
        "customer": spark.createDataFrame([(40, 0), (41, 0), (42, 1), (43, 2)], "c_custkey long, c_nationkey int"),
        "orders": spark.createDataFrame([(40, date(1995, 1, 1)), (41, date(1996, 2, 2)), (42, date(1997, 3, 3))], "o_custkey long, o_orderdate date"),
    }
    for name, rows in tables.items():
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    got = entry.queries()["update_summary"](spark, str(tmp_path)).collect()
    assert {tuple(r) for r in got} == {(0, date(1996, 2, 2)), (1, date(1997, 3, 3)), (2, date(1990, 1, 1))}


def test_build_snapshot_and_changes(spark, tmp_path):
    from sakuin.plans import build

    docs = spark.createDataFrame([("kinki", "近畿", "p", "https://x/fukui_ika.xlsx", date(2026, 7, 1), "福井県", "medical")], "source_id string, bureau_name string, page_url string, url string, as_of date, context string, category string")
    files = spark.createDataFrame([("https://x/fukui_ika.xlsx", bytearray(book(ROWS)), "s")], "document_url string, content binary, sha256 string")
    src = spark.createDataFrame([("kinki",)], "source_id string")
    with pytest.raises(ValueError):
        build.snapshot_tables(docs, files, src)
    tables = build.snapshot_tables(docs, files, src, checked=False)
    frame = spark.createDataFrame([("d", 1, float(x), float(y), t.replace("01,2345,6", "1810115202"), False) for x, y, t in UPSERT], "document_url string, page int, x double, y double, text string, ocr boolean")
    notes = spark.createDataFrame([("kinki", "p", "d", "s", date(2026, 7, 15), "upsert", "medical", "医科", "18")], "source_id string, page_url string, url string, sha256 string, published_at date, action string, category string, context string, prefecture_code_hint string")
    tables |= build.change_tables(notes, frame, "2026-07-01")
    place = sinks.Publication(spark, f"{tmp_path}/out/v1", f"{tmp_path}/out")
    place.publish({k: v for k, v in tables.items() if not k.startswith("change_")})
    place.publish({k: v for k, v in tables.items() if k.startswith("change_")}, "changes")
    register = Register(spark, place.path)
    got = register.get("1810115202")
    assert got["name"] == "テスト 診療所" and got["recent_change_count"] == 2 and got["as_of"] == date(2026, 7, 15)
    assert [(s["abbreviation"], s["acceptance_number"]) for s in got["standards"]] == [("外来感染", "第109号"), ("連携強化", "第50号")]
    assert register.manifest().first()["facility_count"] == 1 and register.change_manifest().first()["event_count"] == 2
    assert register.search_by_name("てすと")[0] == 0 and register.search_by_name("テスト診療")[0] == 1
