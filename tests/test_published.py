"""Publication with several publishers, static JSON files, lookups of many codes, incremental replay and the substring index."""

import random
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sakuin.functions import text
from sakuin.operators import manifests, merge, name_index, replay
from sakuin.plans import sinks, static
from sakuin.plans.client import LAYERS, Register
from sakuin.streaming.incremental import ReplayState, replay_stream

D = date(2026, 7, 1)
CODES = ["1810115202", "1810115203", "0231000001", "2740000009"]


def rows(spark, name, *r):
    return spark.createDataFrame(list(r), LAYERS[name])


def snapshot(spark, mark="", day=D):
    names = ["さくら診療所", "桜病院", "うめだ薬局", "サクラ歯科"]
    kinds = ["medical", "medical", "dental", "pharmacy"]
    index = [(c, n + mark, None if k == 1 else f"住所{k}", kinds[k], text_of(n + mark)) for k, (c, n) in enumerate(zip(CODES, names, strict=True))]
    return {
        "facility": rows(spark, "facility", *[(c, n, a, k, day) for c, n, a, k, _ in index]),
        "filing": rows(spark, "filing", (CODES[0], 0, "old", "第1号", day), (CODES[0], 1, "kept", "第2号", None), (CODES[2], 0, "kept", "", day)),
        "source": rows(spark, "source", *[(c, f"https://monthly/{c[:2]}", "kinki") for c in CODES]),
        "catalog": rows(spark, "catalog", ("old", "旧", None), ("kept", None, '継続 "x"')),
        "search_index": rows(spark, "search_index", *index),
        "manifest": spark.createDataFrame([(4, day, 3)], "facility_count long, as_of date, standard_count long"),
        "manifest_source": spark.createDataFrame([("kinki", 4, day, [("https://monthly/18", "s")])], "source_id string, facility_count long, as_of date, documents array<struct<url:string,sha256:string>>"),
    }


def text_of(name):
    import unicodedata

    return "".join(c for c in unicodedata.normalize("NFKC", name).lower() if c not in " ・-ー()[]")


def changes(spark, *, day=date(2026, 7, 15)):
    event = lambda c, i, act, sid, abbr, url: (c, i, act, day, sid, abbr, None, "第3号", day if act == "upsert" else None, url, "kinki", "https://page", 3, "text")
    events = rows(spark, "change_event", event(CODES[0], "1", "remove", "old", "旧", "https://remove"), event(CODES[0], "2", "upsert", "new", "新", "https://monthly/18"), event("1840000001", "3", "upsert", "new", "新", "https://add"))
    facility = rows(spark, "change_facility", (CODES[0], "さくら新診療所", None, "medical", day), ("1840000001", "あたらし薬局", "住所9", "pharmacy", day))
    index = facility.select("code", "name", "address", "category", F.col("name").alias("name_norm"))
    return {"change_event": events, "change_facility": facility, "change_search_index": index, "change_manifest": spark.createDataFrame([(2, 3, day)], "facility_count long, event_count long, latest_as_of date")}


def names_of(register):
    register.clear_cache()
    return {r["code"]: r["name"] for r in register.facilities().collect()}


@pytest.mark.parametrize("rebase", [False, True])
def test_changes_that_meet_a_new_snapshot(spark, tmp_path, rebase):
    place, other = (sinks.Publication(spark, f"{tmp_path}/out/v1", f"{tmp_path}/out") for _ in range(2))
    place.publish(snapshot(spark))
    old = Register(spark, place.path)
    assert old.get(CODES[0])["name"] == "さくら診療所"

    def meanwhile(read):  # the other publisher's snapshot comes when the changes are written
        if len(other._folder.names("versions")) == 1:
            other.publish(snapshot(spark, "二", date(2026, 8, 1)), as_of="2026-08-01")

    made = []
    again = lambda newer: made.append(newer) or {k: v.limit(0) if k != "change_manifest" else v for k, v in changes(spark).items()}
    if rebase:
        now = place.publish(changes(spark), "changes", gates=meanwhile, rebase=again)
        assert len(made) == 1 and set(now) == {"snapshot", "changes"} and now["snapshot"] == made[0]["snapshot"]
    else:
        with pytest.raises(sinks.Conflict):
            place.publish(changes(spark), "changes", gates=meanwhile)
        assert set(place.current()) == {"snapshot"}
    fresh = Register(spark, place.path)
    assert fresh.get(CODES[0])["name"] == "さくら診療所二" and fresh.get("1840000001") is None
    assert old.get(CODES[1])["name"] == "桜病院"  # a reader that began before still can


def test_two_publishers_of_changes_and_a_snapshot_that_is_late(spark, tmp_path):
    place, other = (sinks.Publication(spark, f"{tmp_path}/out/v1", f"{tmp_path}/out") for _ in range(2))
    place.publish(snapshot(spark), as_of="2026-07-01")
    late = []

    def meanwhile(read):
        if not late:
            late.append(other.publish(changes(spark), "changes"))

    now = place.publish(changes(spark, day=date(2026, 7, 20)), "changes", gates=meanwhile)  # stands on the same snapshot
    assert now["snapshot"] == late[0]["snapshot"] and place.current() == now
    assert Register(spark, place.path).get(CODES[0])["as_of"] == date(2026, 7, 20)
    other.publish(snapshot(spark, "二", date(2026, 8, 1)), as_of="2026-08-01")
    with pytest.raises(sinks.Conflict):
        place.publish(snapshot(spark), as_of="2026-07-01")
    assert set(place.current()) == {"snapshot"} and names_of(Register(spark, place.path))[CODES[0]] == "さくら診療所二"


def test_failures_leave_the_register_and_old_folders_go(spark, tmp_path):
    place = sinks.Publication(spark, f"{tmp_path}/out/v1", f"{tmp_path}/out", keep=2)
    first = place.publish(snapshot(spark))

    def fail(read):
        raise ValueError("a gate")

    with pytest.raises(ValueError, match="a gate"):
        place.publish(snapshot(spark, "二"), gates=fail)
    broken = {**snapshot(spark), "filing": spark.range(1).select(F.raise_error(F.lit("unreadable")).alias("code"))}
    with pytest.raises(Exception, match="unreadable"):
        place.publish(broken)
    folders = lambda: sorted(p.name for p in Path(place.path).iterdir() if p.name.startswith(("snapshot", "changes")))
    assert place.current() == first and len(folders()) == 1
    second = place.publish(changes(spark), "changes")
    assert first["snapshot"].rpartition("/")[2] in folders() and len(folders()) == 2
    place.publish(changes(spark), "changes")
    place.publish(changes(spark), "changes")
    assert first["snapshot"].rpartition("/")[2] in folders() and second["changes"].rpartition("/")[2] not in folders() and len(folders()) == 3


def found_rows(spark, n=40):
    return spark.createDataFrame([(f"{k % 9:010d}", f"n{k}", ("medical", "dental", "pharmacy")[k % 3], D if k % 4 else None) for k in range(n)], "code string, name string, category string, as_of date")


@pytest.mark.parametrize("broken", [None, "minimum", "category", "source", "date"])
def test_gates_from_numbers_of_written_tables(spark, tmp_path, broken):
    facility = found_rows(spark).where("category <> 'dental'" if broken == "category" else "true").withColumn("as_of", F.lit(None).cast("date") if broken == "date" else F.col("as_of"))
    filing = spark.range(7).selectExpr("cast(id as string) code")
    sources = spark.createDataFrame([("a",), ("b",)], "source_id string")
    used = spark.createDataFrame([("a", "u1", "s", D), ("a", "u2", "s", None)] + ([] if broken == "source" else [("b", "u3", "s", D)]), "source_id string, url string, sha256 string, as_of date")
    source = facility.select("code", F.lit("a").alias("source_id"), F.lit("u1").alias("url")).unionByName(facility.limit(3).select("code", F.lit("b").alias("source_id"), F.lit("u3").alias("url")))
    least = 1000 if broken == "minimum" else 5
    f, n = manifests.observed(facility, filing)
    seen = {}

    def gates(read):
        checked = manifests.measured_gates(spark, f, read("manifest"), read("manifest_source"), least)
        seen["now"] = {tuple(r) for r in checked.select("gate", "subject", "found", "least", "passed").collect()}
        manifests.require(checked)

    place = sinks.Publication(spark, f"{tmp_path}/out/v1", f"{tmp_path}/out")
    tables = {"facility": f.table, "filing": n.table, "source": source, "manifest": lambda read: manifests.measured(spark, f, n), "manifest_source": lambda read: manifests.source_manifest(sources, read("source").select("code", "source_id").distinct(), used)}
    if broken:
        with pytest.raises(ValueError, match="gate"):
            place.publish(tables, gates=gates)
        assert place.current() == {} and not [p for p in Path(place.path).iterdir() if p.name.startswith("snapshot")]
    else:
        place.publish(tables, gates=gates)
        assert tuple(Register(spark, place.path).manifest().first()) == (40, D, 7)
    links = source.select("code", "source_id").distinct()
    before = manifests.gates(facility, links, used, sources, least).unionByName(manifests.date_gates(manifests.global_manifest(facility, filing), manifests.source_manifest(sources, links, used)))
    assert seen["now"] == {tuple(r) for r in before.select("gate", "subject", "found", "least", "passed").collect()}


def test_numbers_of_no_rows(spark, tmp_path):
    f, n = manifests.observed(found_rows(spark).where("code = 'x'").groupBy("code").agg(F.max("as_of").alias("as_of"), F.min("category").alias("category")), found_rows(spark).where("false"))
    for k, t in enumerate((f.table, n.table)):
        t.write.parquet(f"{tmp_path}/{k}")
    assert tuple(manifests.measured(spark, f, n).first()) == (0, None, 0)


def test_places_of_a_giant_code(spark):
    """One code has nearly all rows: they lie in several ranges, and places are those of one sort."""
    rows = spark.range(60_000).selectExpr("case when id % 100 < 97 then '1310000000' when id % 100 = 97 then null else cast(id % 7 as string) end code", "pmod(id * 7919, 60013) ord", "'x' pos", "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = merge.placed(rows, "ord")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got.columns == ["code", "ord", "pos", "id"]
    want = {}
    for r in sorted(rows.collect(), key=lambda r: (r["code"] or "", r["ord"])):
        want.setdefault(r["code"], []).append(r["id"])
    found = {(r["code"], r["pos"]): r["id"] for r in got.collect()}
    assert found == {(c, k): i for c, ids in want.items() for k, i in enumerate(ids)}
    parts = rows.repartitionByRange(4, "code", "ord").where("code = '1310000000'").select(F.spark_partition_id()).distinct().count()
    assert parts > 1


# ---- static files


def exported(spark, path):
    bureaus = spark.createDataFrame([("kinki", "近畿厚生局", "https://page")], "source_id string, bureau_name string, page_url string")
    static.export_snapshot(snapshot(spark), bureaus, path, "2026-07-02T00:00:00Z")
    documents = spark.createDataFrame([("kinki", "近畿厚生局", "https://page", "https://add", "s", date(2026, 7, 15), "upsert")], "source_id string, bureau_name string, page_url string, url string, sha256 string, published_at date, action string")
    static.export_changes(changes(spark), documents, "2026-07-01", path, "2026-07-16T00:00:00Z")
    return static.StaticRegister(spark, path)


def test_static_files_answer_like_tables(spark, tmp_path):
    place = sinks.Publication(spark, f"{tmp_path}/out/v1", f"{tmp_path}/out")
    place.publish(snapshot(spark)), place.publish(changes(spark), "changes")
    tables, files = Register(spark, place.path), exported(spark, f"{tmp_path}/json/v1")
    layout = sorted(str(p.relative_to(f"{tmp_path}/json/v1")) for p in Path(f"{tmp_path}/json/v1").rglob("*.json"))
    assert layout == ["catalog.json", "changes/facilities/1810.json", "changes/facilities/1840.json", "changes/manifest.json", "changes/search.json", "facilities/0231.json", "facilities/1810.json", "facilities/2740.json", "manifest.json", "search.json"]
    for code in [*CODES, "1840000001"]:
        assert files.get(code) == tables.get(code)
    assert files.get("4710000001") is None and files.get("1810999999") is None  # no shard, and none in a shard
    for view in ("facilities", "filings", "source_ids"):
        a, b = (sorted(map(str, getattr(r, view)().collect())) for r in (tables, files))
        assert a == b and a
    for query in ("さくら", "診療", "薬局", "x"):
        assert files.search_by_name(query) == tables.search_by_name(query)
    assert tuple(files.manifest().first())[:3] == (4, D, 3) and files.change_manifest().first()["event_count"] == 3
    assert static.base_date(spark, f"{tmp_path}/json/v1/manifest.json") == "2026-07-01"
    import json

    search = json.loads(Path(f"{tmp_path}/json/v1/search.json").read_text())
    assert [x[0] for x in search["facilities"]] == sorted(CODES) and search["facilityCount"] == 4
    assert json.loads(Path(f"{tmp_path}/json/v1/catalog.json").read_text())["standards"]["kept"] == {"abbreviation": None, "name": '継続 "x"'}
    event = json.loads(Path(f"{tmp_path}/json/v1/changes/facilities/1840.json").read_text())["facilities"]["1840000001"]["events"][0]
    assert event["standard"] == {"abbreviation": "新", "name": None} and event["extractionMethod"] == "text" and event["documentSha256"] is None
    asked = spark.createDataFrame([(CODES[2],), (CODES[0],), ("4710000001",), ("x",)], "code string")
    found = {r["code"]: r["name"] for r in files.get_many(asked).collect()}
    assert found == {CODES[2]: "うめだ薬局", CODES[0]: "さくら新診療所", "4710000001": None, "x": None}


def test_static_files_that_are_missing_or_corrupt(spark, tmp_path):
    path = Path(f"{tmp_path}/json/v1")
    files = exported(spark, str(path))

    def put(name, content):
        (path / "facilities" / f".{name}.crc").unlink()  # Hadoop's checksum of the old content
        (path / "facilities" / name).write_text(content)

    put("0231.json", '{"schemaVersion":1,"asOf":')
    files.clear_cache()
    with pytest.raises(Exception, match="(?i)malformed"):
        files.get(CODES[2])
    assert files.get(CODES[3])["name"] == "サクラ歯科"
    put("2740.json", '{"schemaVersion":2,"asOf":"2026-07-01","prefix":"2740","facilities":{}}')
    with pytest.raises(Exception, match="not a file of this format"):
        files.get(CODES[3])
    for gone in ("changes", "search.json"):
        (path / gone).rename(path / f"{gone}.away")
    files = static.StaticRegister(spark, str(path))
    assert files.get(CODES[0])["name"] == "さくら診療所" and files.change_manifest() is None
    with pytest.raises(Exception, match="(?i)path"):
        files.search_by_name("さくら")


def test_a_failed_export_restores_the_old_files(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/json/v1"
    files = exported(spark, path)
    bureaus = spark.createDataFrame([("kinki", "b", "p")], "source_id string, bureau_name string, page_url string")
    move = static.Folder.move

    def fail(self, old, new):
        if new == "v1" and "new-" in old:
            raise OSError("disk")
        move(self, old, new)

    monkeypatch.setattr(static.Folder, "move", fail)
    with pytest.raises(OSError, match="disk"):
        static.export_snapshot(snapshot(spark, "二"), bureaus, path, "now")
    monkeypatch.setattr(static.Folder, "move", move)
    files.clear_cache()
    assert files.get(CODES[0])["name"] == "さくら新診療所" and sorted(p.name for p in Path(f"{tmp_path}/json").iterdir()) == ["v1"]
    static.export_snapshot(snapshot(spark, "二"), bureaus, path, "now")
    assert static.StaticRegister(spark, path).get(CODES[0])["name"] == "さくら診療所二"  # the changes ended with the old snapshot


# ---- many codes


def test_many_codes_open_their_shards_only(spark, tmp_path):
    place = sinks.Publication(spark, f"{tmp_path}/out/v1", f"{tmp_path}/out")
    place.publish(snapshot(spark)), place.publish(changes(spark), "changes")
    register = Register(spark, place.path)
    asked = spark.createDataFrame([("18-1011-5202", 1), ("１８１０１１５２０３", 2), ("1810999999", 3), ("12", 4), (None, 5), ("1810115202", 6)], "asked string, name int")
    got = register.get_many(asked, "asked")
    assert sorted((r["asked"] or "", r["facility_code"], r["name"], r["recent_change_count"]) for r in got.collect()) == [
        ("", None, None, None), ("12", None, None, None), ("18-1011-5202", CODES[0], "さくら新診療所", 2), ("1810115202", CODES[0], "さくら新診療所", 2), ("1810999999", "1810999999", None, None), ("１８１０１１５２０３", CODES[1], "桜病院", 0)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()


# ---- incremental replay

EVENT = "code string, id string, action string, published_at date, standard_id string, abbreviation string, acceptance_number string"
BASE = "code string, pos int, standard_id string, abbreviation string, acceptance_number string"


def held_by_fold(base, events):
    out = {}
    for c in {r[0] for r in base} | {e[0] for e in events}:
        held = [(p, s, a, None) for x, p, s, a, _ in base if x == c]
        for e in sorted({e for e in events if e[0] == c}, key=lambda e: (e[3], e[2] != "remove", e[1])):
            held = [h for h in held if h[1] != e[4] and not (e[5] and h[2] == e[5])]
            if e[2] == "upsert":
                held.append((0, e[4], e[5], e[1]))
        out[c] = sorted(held, key=str)
    return {c: h for c, h in out.items() if h}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_split_into_batches_gives_the_replay(spark, tmp_path, seed):
    r = random.Random(seed)
    code = lambda: f"c{r.randrange(12)}"
    base = [(code(), k, r.choice("abcd"), r.choice([None, "", "x", "y"]), "") for k in range(40)]
    events = [(code(), f"{k:03d}", r.choice(["upsert", "remove"]), date(2026, 7, r.randint(1, 6)), r.choice(["a", "b", "c", "d", None]), r.choice([None, "", "x", "y", "z"]), "n") for k in range(90)]
    state = ReplayState(spark, f"{tmp_path}/s", buckets=4, keep=2)
    b = spark.createDataFrame(base, BASE)
    order = r.sample(events, len(events))
    cuts = sorted(r.sample(range(len(events)), 3))
    batches = [order[a:z] for a, z in zip([0, *cuts], [*cuts, None], strict=True)]
    batches.insert(2, r.sample(events, 20))  # some come twice, some of these before their batch
    for k, batch in enumerate(batches):
        state.merge(spark.createDataFrame(batch, EVENT), k)
    got = {}
    for x in state.current(b).collect():
        got.setdefault(x["code"], []).append((x["pos"], x["standard_id"], x["abbreviation"], x["id"]))
    assert {c: sorted(h, key=str) for c, h in got.items()} == held_by_fold(base, events)
    full = replay.replay(b, spark.createDataFrame(events, EVENT)).select("code", "pos", "standard_id", "abbreviation")
    assert sorted(map(str, full.collect())) == sorted(map(str, state.current(b).select("code", "pos", "standard_id", "abbreviation").collect()))
    some = spark.createDataFrame([("c1",), ("c2",), ("none",)], "code string")
    part = state.current(b, some).collect()
    assert {x["code"] for x in part} <= {"c1", "c2"} and len(part) == sum(len(got.get(c, ())) for c in ("c1", "c2"))
    state.clear()
    assert state.current(b).count() == len(base)


def test_a_batch_touches_its_buckets_only(spark, tmp_path):
    state = ReplayState(spark, f"{tmp_path}/s", buckets=8, keep=2)
    event = lambda c, k: (c, str(k), "upsert", D, f"s{k}", None, "")
    state.merge(spark.createDataFrame([event(f"c{k}", k) for k in range(200)], EVENT))
    before = state.version()[1]["buckets"]
    assert len(before) == 8
    state.merge(spark.createDataFrame([event("c3", 900), event("c3", 901)], EVENT))
    after = state.version()[1]["buckets"]
    changed = [b for b in after if after[b] != before[b]]
    assert len(changed) == 1
    assert state._read(state.version()[1], {int(changed[0])}).count() < 60  # what the batch had to read
    number = state.version()[0]
    assert state.merge(spark.createDataFrame([], EVENT)) == number
    for k in range(3):
        state.merge(spark.createDataFrame([event("c3", 910 + k)], EVENT))
    assert len([p for p in Path(f"{tmp_path}/s/data").glob(f"*/bucket={changed[0]}")]) == 2  # the newest two versions' files
    assert state.current(spark.createDataFrame([], BASE)).count() == 205


def test_two_merges_that_saw_the_same_version(spark, tmp_path, monkeypatch):
    one, two = (ReplayState(spark, f"{tmp_path}/s", buckets=2) for _ in range(2))
    event = lambda k: spark.createDataFrame([("c", str(k), "upsert", D, f"s{k}", None, "")], EVENT)
    one.merge(event(1))
    read = ReplayState._read

    def meanwhile(self, version, wanted=None):
        monkeypatch.setattr(ReplayState, "_read", read)
        two.merge(event(2))
        return read(self, version, wanted)

    monkeypatch.setattr(ReplayState, "_read", meanwhile)
    one.merge(event(3))
    assert {r["id"] for r in one.current(spark.createDataFrame([], BASE)).collect()} == {"1", "2", "3"}


def test_replay_of_a_stream(spark, tmp_path):
    state = ReplayState(spark, f"{tmp_path}/s", buckets=2)
    for k in range(3):
        spark.createDataFrame([("c", str(k), "upsert", D, f"s{k}", None, "")], EVENT).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = lambda: spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    replay_stream(stream(), state, f"{tmp_path}/c").awaitTermination()
    assert state.version()[0] == 3 and state.current(spark.createDataFrame([], BASE)).count() == 3
    replay_stream(stream(), state, f"{tmp_path}/c2").awaitTermination()  # all sent again
    assert state.current(spark.createDataFrame([], BASE)).count() == 3


# ---- substring index


def test_index_finds_what_contains_finds(spark, tmp_path):
    r = random.Random(4)
    names = ["".join(r.choices("さくサクラ桜院薬局abあ", k=r.randint(1, 9))) for _ in range(300)] + ["", "a", "さくらさくらさくら"]
    index = spark.createDataFrame([(f"{k:010d}", n, n) for k, n in enumerate(names)], "code string, name string, name_norm string")
    queries = {n[a:b] for n in names for a, b in [sorted(r.choices(range(len(n) + 1), k=2))]} | {"さ", "無い", "", "さくら" * 4, "a"}
    listed = name_index.lists(index).cache()
    asked = spark.createDataFrame([(q,) for q in queries] * 2, "query string")
    got = {(x["query"], x["code"]) for x in name_index.found(asked, listed, name_index.lengths(listed), index).collect()}
    assert got == {(q, f"{k:010d}") for q in queries if q for k, n in enumerate(names) if q in n}


def test_search_by_index_and_by_scan_agree(spark, tmp_path):
    sides = (snapshot(spark), changes(spark))
    with_lists = []
    for side, name in zip(sides, ("search_index", "change_search_index"), strict=True):
        listed = name_index.lists(side[name])
        pre = "" if name == "search_index" else "change_"
        with_lists.append({**side, f"{pre}name_list": listed, f"{pre}name_length": name_index.lengths(listed)})
    places = [sinks.Publication(spark, f"{tmp_path}/out/{k}", f"{tmp_path}/out") for k in "ab"]
    for place, tables in zip(places, (sides, with_lists), strict=True):
        place.publish(tables[0]), place.publish(tables[1], "changes")
    scan, index = (Register(spark, p.path) for p in places)
    assert index._listed() and not scan._listed()
    for query in ("さくら", "ｻｸﾗ", "新", "診療所", "薬", "さくら診", "x", ""):
        assert index.search_by_name(query) == scan.search_by_name(query)
    assert index.search_by_name("さくら診") == (0, [])  # its name has changed
    asked = spark.createDataFrame([("桜",), ("さくら　新",), ("さくら新",), (None,)], "query string")
    assert {(r["query"], r["code"]) for r in index.search_many(asked).collect()} == {("桜", CODES[1]), ("さくら　新", CODES[0]), ("さくら新", CODES[0])}
    plan = name_index.found(asked.select(text.facility_name(F.col("query")).alias("query")), index.table("name_list"), index.table("name_length"), index.table("search_index"))._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()  # only the parts of the queries' runs are read
