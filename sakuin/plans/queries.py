"""Register operators on the shared tables, each with the same question in SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sakuin.functions import codes, dates, links, text
from sakuin.operators import manifests, merge, replay, search
from sakuin.streaming.incremental import ReplayState

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _category(key: str):
    k = F.col(key) % 3
    return F.when(k == 0, "medical").when(k == 1, "dental").otherwise("pharmacy")


def _customers(spark, sf_dir) -> DataFrame:
    """Customers as facilities."""
    c = table(spark, sf_dir, "customer")
    prefecture = F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0")
    code = codes.full_code(prefecture, _category("c_custkey"), F.col("c_custkey").cast("string"))
    return c.select("*", code.alias("code"), _category("c_custkey").alias("category"), prefecture.alias("prefecture_code"))


_CODE = "lpad(cast(c_nationkey + 1 as varchar), 2, '0') || case c_custkey % 3 when 0 then '1' when 1 then '3' else '4' end || lpad(cast(c_custkey as varchar), 7, '0')"
_KIND = "case c_custkey % 3 when 0 then 'medical' when 1 then 'dental' else 'pharmacy' end"


@query(f"""select c_custkey, code, substr(code, 1, 2) prefecture_code, case substr(code, 3, 1) when '1' then 'medical' when '3' then 'dental' when '4' then 'pharmacy' end category,
substr(code, 4, 7) local_code, substr(code, 1, 4) prefix from (select c_custkey, {_CODE} code from customer)""")
def facility_code(spark, sf_dir):
    parts = codes.code_parts(F.col("code"))
    return _customers(spark, sf_dir).select("c_custkey", "code", parts.alias("p")).select("c_custkey", "code", "p.*")


@query(f"""select c_custkey, case when regexp_full_match(d, '[0-9]{{2}}[134][0-9]{{7}}') then d end code, length(d) n_digits from (
select c_custkey, regexp_replace(case c_custkey % 3 when 0 then substr(code, 1, 2) || '-' || substr(code, 3) when 1 then ' ' || code || '号' else '9' || code end, '[^0-9]', '', 'g') d
from (select c_custkey, {_CODE} code from customer))""")
def code_validate(spark, sf_dir):
    k, code = F.col("c_custkey") % 3, F.col("code")
    noisy = F.when(k == 0, F.concat(code.substr(1, 2), F.lit("-"), code.substr(3, 99))).when(k == 1, F.concat(F.lit(" "), code, F.lit("号"))).otherwise(F.concat(F.lit("9"), code))
    rows = _customers(spark, sf_dir).select("c_custkey", noisy.alias("s"))
    return rows.select("c_custkey", codes.extract_code(F.col("s")).alias("code"), F.length(text.digits(F.col("s"))).cast("long").alias("n_digits"))


@query(f"""with f as (select {_CODE} code, cast(max(o_orderdate) as date) as_of from customer join orders on o_custkey = c_custkey group by 1)
select substr(code, 1, 4) prefix, count(*) n, max(as_of) as_of from f group by 1""")
def shard_summary(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").cast("date").alias("as_of"))
    c = _customers(spark, sf_dir)
    return merge.shards(c.join(o, c["c_custkey"] == o["o_custkey"]).select("code", "as_of"))


@query(f"""with c as (select c_custkey, {_CODE} code, c_name from customer), o as (select o_custkey, count(*) n, max(o_totalprice) top from orders group by 1)
select code, c_name, coalesce(n, 0) n, top from c left join o on o_custkey = c_custkey where code = (select code from c where c_custkey = 7) and substr(code, 1, 4) = (select substr(code, 1, 4) from c where c_custkey = 7)""")
def point_lookup(spark, sf_dir):
    """The filter on the code's prefix is what prunes partitions of a published register."""
    c = _customers(spark, sf_dir).withColumn("prefix", F.substring("code", 1, codes.PREFIX))
    wanted = c.where("c_custkey = 7").select(F.col("code").alias("w"), F.col("prefix").alias("p"))
    found = c.join(wanted, (F.col("prefix") == F.col("p")) & (F.col("code") == F.col("w")), "left_semi")
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.max("o_totalprice").alias("top"))
    return found.join(o, F.col("c_custkey") == F.col("o_custkey"), "left").select("code", "c_name", F.coalesce("n", F.lit(0).cast("long")).alias("n"), "top")


@query("""select distinct substr(sha256(cast(to_json([p_brand, p_type]) as varchar)), 1, 16) standard_id, p_brand abbreviation, p_type standard_name from part""")
def standard_catalog(spark, sf_dir):
    return merge.catalog(table(spark, sf_dir, "part").select(F.col("p_brand").alias("abbreviation"), F.col("p_type").alias("standard_name")))


@query("""select user_id code, arg_max(event_type, row(length(event_type), -event_id)) name, arg_min(props, case when props is not null then event_id end) address,
max(ts) as_of, arg_min(event_type, event_id) category from events group by 1""")
def merge_records(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("code"), F.col("event_id").alias("ord"), F.col("event_type").alias("name"), F.col("props").alias("address"), F.col("event_type").alias("category"), F.lit("01").alias("prefecture_code"), F.lit("0").alias("local_code"), F.col("ts").alias("as_of"))
    return merge.merge_facilities(e).select("code", "name", "address", "as_of", "category")


@query("""with first as (select user_id, min(event_id) f from events group by 1), k as (select user_id, event_type, min(event_id) o from events group by 1, 2)
select user_id code, o ord, event_type abbreviation from k""")
def distinct_filings(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("code"), F.col("event_id").alias("ord"), F.lit(0).alias("pos"), F.col("event_type").alias("abbreviation"), F.lit(None).cast("string").alias("standard_name"), F.lit("").alias("acceptance_number"), F.lit(None).cast("date").alias("effective_from"))
    return merge.distinct_filings(e).select("code", "ord", "abbreviation")


@query("""select n_nationkey source_id, n_name, coalesce(f.n, 0) facility_count, d.as_of from nation left join (select c_nationkey, count(distinct c_custkey) n from customer group by 1) f on c_nationkey = n_nationkey
left join (select c_nationkey k, cast(max(o_orderdate) as date) as_of from customer join orders on o_custkey = c_custkey group by 1) d on d.k = n_nationkey""")
def source_manifest(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("source_id"), "n_name")
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("source_id"), F.col("c_custkey").alias("code"))
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").cast("date").alias("as_of"))
    d = c.join(o, F.col("code") == F.col("o_custkey")).groupBy("source_id").agg(F.max("as_of").alias("as_of")).select("source_id", "as_of", F.lit("u").alias("url"), F.lit("s").alias("sha256"))
    return manifests.source_manifest(n, c, d).select("source_id", "n_name", "facility_count", "as_of")


@query("select (select count(*) from customer) facility_count, (select count(*) from orders) standard_count, (select cast(max(o_orderdate) as date) from orders) as_of")
def global_manifest(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    f = table(spark, sf_dir, "customer").join(o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").cast("date").alias("as_of")), "c_custkey", "left")
    return manifests.global_manifest(f, o).select("facility_count", "standard_count", "as_of")


_LOG = """with b as (select o_custkey code, o_orderkey pos, o_orderpriority sid, case when o_orderkey % 5 = 0 then null when o_orderkey % 7 = 0 then '' else o_orderstatus || cast(o_orderkey % 4 as varchar) end abbr from orders),
e as (select 1 + user_id % (select max(c_custkey) from customer) code, event_id id, case when event_type = 'click' or event_id % 4 = 0 then 'remove' else 'upsert' end action, cast(ts as date) published,
case event_id % 3 when 0 then '1-URGENT' when 1 then '2-HIGH' else 'x' || cast(event_id % 9 as varchar) end sid, case event_id % 6 when 0 then null when 1 then '' else 'O' || cast(event_id % 4 as varchar) end abbr from events),
n as (select *, row_number() over (partition by code order by published, case when action = 'remove' then 0 else 1 end, id) seq from e),
l as (select code, pos, sid, abbr, 0 seq, 'upsert' action from b union all select code, 0, sid, abbr, seq, action from n)
select code, pos, sid, abbr, cast(seq as integer) seq from (select *, max(seq) over (partition by code, sid) m, case when abbr is null or abbr = '' then seq else max(seq) over (partition by code, abbr) end a from l)
where action <> 'remove' and seq = m and seq = a"""


def _layers(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    abbr = F.when(k % 5 == 0, F.lit(None)).when(k % 7 == 0, "").otherwise(F.concat("o_orderstatus", (k % 4).cast("string")))
    base = o.select(F.col("o_custkey").alias("code"), k.alias("pos"), F.col("o_orderpriority").alias("standard_id"), abbr.alias("abbreviation"))
    e, i = table(spark, sf_dir, "events"), F.col("event_id")
    most = table(spark, sf_dir, "customer").agg(F.max("c_custkey").alias("most"))
    act = F.when((F.col("event_type") == "click") | (i % 4 == 0), "remove").otherwise("upsert")
    sid = F.when(i % 3 == 0, "1-URGENT").when(i % 3 == 1, "2-HIGH").otherwise(F.concat(F.lit("x"), (i % 9).cast("string")))
    name = F.when(i % 6 == 0, F.lit(None)).when(i % 6 == 1, "").otherwise(F.concat(F.lit("O"), (i % 4).cast("string")))
    events = e.crossJoin(most).select((1 + F.col("user_id") % F.col("most")).alias("code"), i.alias("id"), act.alias("action"), F.col("ts").cast("date").alias("published_at"), sid.alias("standard_id"), name.alias("abbreviation"))  # most is one row
    return base, events


@query(_LOG)
def change_overlay(spark, sf_dir):
    base, events = _layers(spark, sf_dir)
    return replay.replay(base, events).select("code", "pos", F.col("standard_id").alias("sid"), F.col("abbreviation").alias("abbr"), "seq")


def _shared(spark) -> str:
    """The folder that driver and executors share."""
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


_MARKED = _LOG.replace("0 seq, 'upsert' action from b", "0 seq, 'upsert' action, null published, null id from b").replace("seq, action from n)", "seq, action, published, id from n)").replace("cast(seq as integer) seq from", "published, id from")


@query(_MARKED)
def incremental_overlay(spark, sf_dir):
    """change_overlay from a state that took the events in batches, out of order and some of them twice; each batch reads and writes
    the buckets of its codes."""
    base, events = _layers(spark, sf_dir)
    state, third = ReplayState(spark, f"{_shared(spark)}/replay-{uuid.uuid4().hex}", buckets=16), F.col("id") % 3
    for batch in (third == 1, third < 2, third == 2):
        state.merge(events.where(batch))
    return state.current(base).select("code", "pos", F.col("standard_id").alias("sid"), F.col("abbreviation").alias("abbr"), F.col("published_at").alias("published"), "id")


@query("""select coalesce(s_suppkey, c_custkey) code, coalesce(s_name, c_name) name, coalesce(case when s_suppkey % 2 = 0 then 'addr' || cast(s_suppkey as varchar) end, c_mktsegment) address
from customer full outer join supplier on s_suppkey = c_custkey""")
def facility_overlay(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("code"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("address"), F.lit("medical").alias("category"))
    k = F.col("s_suppkey")
    s = table(spark, sf_dir, "supplier").select(k.alias("code"), F.col("s_name").alias("name"), F.when(k % 2 == 0, F.concat(F.lit("addr"), k.cast("string"))).alias("address"), F.lit("medical").alias("category"))
    return replay.overlay_facilities(c, s).drop("category")


@query("""select c_custkey code, c_name name from customer where not exists (select 1 from supplier where s_suppkey = c_custkey) union all select s_suppkey, s_name from supplier""")
def search_overlay(spark, sf_dir):
    c, s = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    return replay.overlay_index(c.select(F.col("c_custkey").alias("code"), F.col("c_name").alias("name")), s.select(F.col("s_suppkey").alias("code"), F.col("s_name").alias("name")))


@query("""with m as (select c_custkey code, c_name name, lower(replace(replace(c_name, '#', ''), '-', '')) norm from customer), f as (select * from m where contains(norm, '00012'))
select code, name, (select count(*) from f) total from f order by not starts_with(norm, '00012'), name, code limit 20""")
def name_search(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("code"), F.col("c_name").alias("name"), F.lower(F.translate("c_name", "#-", "")).alias("name_norm"))
    found = search.matches(c, "00012")
    top = search.ranked(found, "00012", 20)
    return top.crossJoin(found.agg(F.count("*").alias("total"))).select("code", "name", "total")  # the total is one row


@query("""select event_id, user_id, last_value(case when event_id % 4 = 0 then props end ignore nulls) over w filled from events window w as (partition by user_id order by event_id rows between unbounded preceding and current row)""")
def fill_down(spark, sf_dir):
    from sakuin.operators.sheets import fill_down as fill

    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.when(F.col("event_id") % 4 == 0, F.col("props")).alias("filled"))
    return fill(e, ["user_id"], "event_id", ["filled"])


@query("""select conv_id, turn, cast(sum(case when role = 'user' then 1 else 0 end) over (partition by conv_id order by turn) as bigint) segment from conversations""")
def segment_records(spark, sf_dir):
    from sakuin.operators.positioned import segments

    return segments(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role"), ["conv_id"], "turn", F.col("role") == "user", "segment").select("conv_id", "turn", "segment")


@query("""with p as (select p_partkey, string_split(p_name, ' ') names, string_split(p_type, ' ') dates from part), i as (select p_partkey, names, dates, unnest(generate_series(1, len(names))) k from p)
select p_partkey, k - 1 pos, names[k] name, case when len(dates) = len(names) then dates[k] when len(dates) = 1 then dates[1] end effective from i""")
def zip_explode(spark, sf_dir):
    from sakuin.operators.sheets import paired

    p = table(spark, sf_dir, "part").select("p_partkey", F.split("p_name", " ").alias("names"), F.split("p_type", " ").alias("dates"))
    rows = p.select("p_partkey", "dates", F.size("names").alias("n"), F.posexplode("names").alias("pos", "name"))
    return rows.select("p_partkey", F.col("pos").cast("long").alias("pos"), "name", paired(F.col("dates"), F.col("n"), F.col("pos"), broadcast_one=True).alias("effective"))


@query("""select o_orderkey, s, case when regexp_full_match(s, '[0-9]{4,5}([.][0-9]+)?') and cast(s as double) between 20000 and 80000 then date '1899-12-30' + cast(floor(cast(s as double)) as integer) end as_date
from (select o_orderkey, case o_orderkey % 4 when 0 then cast(19990 + o_orderkey % 70000 as varchar) when 1 then cast(40000 + o_orderkey % 9000 as varchar) || '.5' when 2 then cast(o_orderkey % 100 as varchar) else '4' || cast(o_orderkey % 10000 as varchar) || 'x' end s from orders)""")
def excel_serial(spark, sf_dir):
    k = F.col("o_orderkey")
    s = F.when(k % 4 == 0, (19990 + k % 70000).cast("string")).when(k % 4 == 1, F.concat((40000 + k % 9000).cast("string"), F.lit(".5"))).when(k % 4 == 2, (k % 100).cast("string")).otherwise(F.concat(F.lit("4"), (k % 10000).cast("string"), F.lit("x")))
    return table(spark, sf_dir, "orders").select("o_orderkey", s.alias("s")).select("o_orderkey", "s", dates.serial_date(F.col("s")).alias("as_date"))


def _era_text(k):
    y = F.when(k % 5 == 0, "元").otherwise((1 + k % 9).cast("string"))
    era = F.when(k % 3 == 0, "令和").when(k % 3 == 1, "平成").otherwise("昭和")
    return F.concat(era, y, F.lit("年"), (1 + k % 13).cast("string"), F.lit("月"), (1 + k % 31).cast("string"), F.lit("日"))


@query("""select o_orderkey, try_cast(printf('%04d-%02d-%02d', case o_orderkey % 3 when 0 then 2018 when 1 then 1988 else 1925 end + case when o_orderkey % 5 = 0 then 1 else 1 + o_orderkey % 9 end, 1 + o_orderkey % 13, 1 + o_orderkey % 31) as date) as_date,
try_cast(printf('%04d-%02d-%02d', 2018 + o_orderkey % 20, 1 + o_orderkey % 12, 1 + o_orderkey % 31) as date) short_date, try_cast(printf('%04d-%02d-%02d', 1950 + o_orderkey % 99, 1 + o_orderkey % 12, 1 + o_orderkey % 31) as date) western_date from orders""")
def era_dates(spark, sf_dir):
    k = F.col("o_orderkey")
    short = F.concat(F.lit("R"), (k % 20).cast("string"), F.lit("."), (1 + k % 12).cast("string"), F.lit("."), (1 + k % 31).cast("string"))
    western = F.concat(F.lit("掲載 "), (1950 + k % 99).cast("string"), F.lit("/"), (1 + k % 12).cast("string"), F.lit("/"), (1 + k % 31).cast("string"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", _era_text(k).alias("a"), short.alias("b"), western.alias("c"))
    return rows.select("o_orderkey", *[dates.parse_date(F.col(c)).alias(n) for c, n in (("a", "as_date"), ("b", "short_date"), ("c", "western_date"))])


@query("""with t as (select o_orderkey, list_filter([try_cast(printf('%04d-%02d-%02d', 2018 + 1 + o_orderkey % 9, 1 + o_orderkey % 12, 1 + o_orderkey % 31) as date), try_cast(printf('%04d-%02d-%02d', 2000 + o_orderkey % 30, 1 + o_orderkey % 13, 1 + o_orderkey % 28) as date)], lambda x: x is not null) d from orders)
select o_orderkey, cast(len(d) as bigint) n, list_max(d) latest from t""")
def dates_in_text(spark, sf_dir):
    k = F.col("o_orderkey")
    first = F.concat(F.lit("令和"), (1 + k % 9).cast("string"), F.lit("年"), (1 + k % 12).cast("string"), F.lit("月"), (1 + k % 31).cast("string"), F.lit("日から "))
    second = F.concat((2000 + k % 30).cast("string"), F.lit("-"), (1 + k % 13).cast("string"), F.lit("-"), (1 + k % 28).cast("string"), F.lit(" まで"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", dates.dates_in_text(F.concat(first, second)).alias("d"))
    return rows.select("o_orderkey", F.size("d").cast("long").alias("n"), dates.max_date(F.col("d")).alias("latest"))


@query(r"""select page_id, u.h link, u.h like '%.html' is_page from pages, lateral (select unnest(regexp_extract_all(coalesce(html, ''), 'href="([^"]*)"', 1)) h) u where regexp_matches(u.h, '^/[A-Za-z]')""")
def link_discovery(spark, sf_dir):
    found = F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit('href="([^"]*)"'), F.lit(1)))
    return table(spark, sf_dir, "pages").select("page_id", found.alias("link")).where(F.col("link").rlike("^/[A-Za-z]")).withColumn("is_page", F.col("link").endswith(".html"))


@query("""with o as (select o_orderkey, c_nationkey, case when o_orderkey % 10 = 0 then null else date_trunc('month', o_orderdate)::date end as_of from orders join customer on c_custkey = o_custkey)
select o_orderkey, c_nationkey source_id from (select *, max(as_of) over (partition by c_nationkey) latest from o) where coalesce(as_of, latest) = latest""")
def latest_only(spark, sf_dir):
    from sakuin.operators.discovery import latest_only as latest

    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    as_of = F.when(F.col("o_orderkey") % 10 != 0, F.trunc("o_orderdate", "month"))
    return latest(o.select("o_orderkey", F.col("c_nationkey").alias("source_id"), as_of.alias("as_of"))).select("o_orderkey", "source_id")


@query("""select event_id, user_id from events where cast(ts as date) > (select cast(min(ts) as date) + 10 from events)""")
def after_base(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("published_at", F.col("ts").cast("date"))
    base = e.agg(F.date_add(F.min("published_at"), 10).alias("base"))
    return e.crossJoin(base).where("published_at > base").select("event_id", "user_id")  # the base is one row


@query("""with p as (select page_id ord, regexp_extract(coalesce(url, ''), '^[^/]*//([^/?#]*)', 1) u, case when page_id % 3 = 0 then null when page_id % 3 = 1 then 'medical' else 'dental' end category, case when page_id % 11 = 0 then 'remove' else 'upsert' end action from pages)
select u url, arg_min(category, case when category is not null then ord end) category, case when max(case when action = 'remove' then 1 else 0 end) = 1 then 'remove' else 'upsert' end action, min(ord) page from p group by 1""")
def dedup_documents(spark, sf_dir):
    i = F.col("page_id")
    p = table(spark, sf_dir, "pages").select(i.alias("ord"), i.alias("page"), F.regexp_extract(F.coalesce("url", F.lit("")), "^[^/]*//([^/?#]*)", 1).alias("url"), F.when(i % 3 == 0, F.lit(None)).when(i % 3 == 1, "medical").otherwise("dental").alias("category"), F.when(i % 11 == 0, "remove").otherwise("upsert").alias("action"))
    return merge.documents(p)


@query(r"""with t as (select doc_id, regexp_replace(lower(coalesce(text, '')) || case doc_id % 5 when 0 then ' 医科' when 1 then '_shika' when 2 then '調剤薬局' when 3 then ' 歯科 薬局' else '' end, '[\s　]+', '', 'g') x from documents),
h as (select doc_id, regexp_matches(x, '歯科|しか|shika|sika') d, regexp_matches(x, '薬局|調剤|ちょうざい|yakkyoku|chouzai|chozai|pharmacy') p, regexp_matches(x, '医科|いか|(?:^|[_\-.])ika(?:[_\-.]|$)|medical') m from t)
select doc_id, case when cast(d as int) + cast(p as int) + cast(m as int) = 1 then case when d then 'dental' when p then 'pharmacy' else 'medical' end end category from h""")
def category_infer(spark, sf_dir):
    i = F.col("doc_id") % 5
    tail = F.when(i == 0, " 医科").when(i == 1, "_shika").when(i == 2, "調剤薬局").when(i == 3, " 歯科 薬局").otherwise("")
    return table(spark, sf_dir, "documents").select("doc_id", text.category(F.concat(F.coalesce("text", F.lit("")), tail)).alias("category"))


@query("""with s as (select s_suppkey, 'at ' || (select n_name from nation where n_nationkey = s_nationkey) || case when s_suppkey % 4 = 0 then ' or ' || (select n_name from nation where n_nationkey = (s_nationkey + 3) % 25) else '' end ctx from supplier)
select s_suppkey, min(n_nationkey) first_code, case when count(n_nationkey) = 1 then min(n_nationkey) end only_code, count(n_nationkey) hits from s left join nation on contains(ctx, n_name) group by 1""")
def prefecture_infer(spark, sf_dir):
    """The first name that a context holds, and the only one. The dimension is a fixed list, so it becomes one array column."""
    from sakuin.operators.sheets import names_in

    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    s = table(spark, sf_dir, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).withColumnRenamed("n_name", "a").drop("n_nationkey")
    other = n.select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("b"))
    s = s.join(other, (F.col("s_nationkey") + 3) % 25 == F.col("k"))
    context = F.concat(F.lit("at "), "a", F.when(F.col("s_suppkey") % 4 == 0, F.concat(F.lit(" or "), "b")).otherwise(""))
    names = n.agg(F.array_sort(F.collect_list(F.struct(F.col("n_nationkey").alias("code"), F.col("n_name").alias("name")))).alias("names"))
    found = s.select("s_suppkey", context.alias("context")).crossJoin(names).select("s_suppkey", names_in(F.col("context"), F.col("names")).alias("c"))  # names are one row
    size = F.size("c")
    return found.select("s_suppkey", F.when(size > 0, F.col("c")[0]).alias("first_code"), F.when(size == 1, F.col("c")[0]).alias("only_code"), size.cast("long").alias("hits"))


@query("""with r as (select l_orderkey % 1000 code, 'u' || cast(l_suppkey % 50 as varchar) url, 's' || cast(min(l_suppkey % 7) as varchar) source_id, 0 kind, 0 seq from lineitem group by 1, 2),
e as (select user_id % 1000 code, 'u' || cast(event_id % 50 as varchar) url, 'e' || event_type source_id, 1 kind, row_number() over (partition by user_id % 1000 order by cast(ts as date), case when event_id % 4 = 0 then 0 else 1 end, event_id) seq from events)
select code, url, arg_max(source_id, row(kind, seq)) source_id, max(kind) kind from (select * from r union all select * from e) group by 1, 2""")
def provenance_union(spark, sf_dir):
    base = table(spark, sf_dir, "lineitem").groupBy((F.col("l_orderkey") % 1000).alias("code"), F.concat(F.lit("u"), (F.col("l_suppkey") % 50).cast("string")).alias("url")).agg(F.concat(F.lit("s"), F.min(F.col("l_suppkey") % 7).cast("string")).alias("source_id"))
    i = F.col("event_id")
    e = table(spark, sf_dir, "events").select((F.col("user_id") % 1000).alias("code"), F.concat(F.lit("u"), (i % 50).cast("string")).alias("url"), F.concat(F.lit("e"), "event_type").alias("source_id"), F.col("ts").cast("date").alias("published_at"), F.when(i % 4 == 0, "remove").otherwise("upsert").alias("action"), i.alias("id"))
    return replay.provenance(base, e).select("code", "url", "source_id", "kind")


@query("select n_nationkey, n_name from nation where exists (select 1 from supplier where s_nationkey = n_nationkey and s_acctbal > 5000)")
def semi_sources(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").where("s_acctbal > 5000")
    return table(spark, sf_dir, "nation").join(s, F.col("n_nationkey") == F.col("s_nationkey"), "left_semi").select("n_nationkey", "n_name")


@query("""select n_nationkey source_id, coalesce(max(cast(o_orderdate as date)), date '1990-01-01') latest from nation left join customer on c_nationkey = n_nationkey left join orders on o_custkey = c_custkey group by 1""")
def update_summary(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("source_id"), F.lit("1990-01-01").cast("date").alias("base_as_of"))
    c = table(spark, sf_dir, "customer")
    d = c.join(table(spark, sf_dir, "orders"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_nationkey").alias("source_id"), F.col("o_orderdate").cast("date").alias("published_at"))
    return manifests.latest_published(n, d).select("source_id", "latest")


#: The same under the name that it had beside a form that read one customer in 40.
QUERIES["update_summary_all"], ORACLE["update_summary_all"] = update_summary, ORACLE["update_summary"]


@query("""select 'minimum' gate, 'facilities' subject, count(*) found, 1000 least, count(*) >= 1000 passed from customer
union all select 'documents', cast(n_nationkey as varchar), count(distinct o_orderkey), 1, count(distinct o_orderkey) >= 1 from nation left join customer on c_nationkey = n_nationkey left join orders on o_custkey = c_custkey group by n_nationkey
union all select 'source', cast(n_nationkey as varchar), count(distinct c_custkey), 1, count(distinct c_custkey) >= 1 from nation left join customer on c_nationkey = n_nationkey group by n_nationkey
union all select 'category', k, count(c_custkey), 1, count(c_custkey) >= 1 from (values ('medical'), ('dental'), ('pharmacy')) v(k) left join customer on case c_custkey % 3 when 0 then 'medical' when 1 then 'dental' else 'pharmacy' end = k group by k""".replace("1000 least", "cast(1000 as bigint) least"))
def quality_gates(spark, sf_dir):
    c = _customers(spark, sf_dir)
    fs = c.select(F.col("c_nationkey").cast("string").alias("source_id"), "code")
    d = c.join(table(spark, sf_dir, "orders"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_nationkey").cast("string").alias("source_id"), F.col("o_orderkey").alias("url"))
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("source_id"))
    return manifests.gates(c, fs, d, n, minimum=1000)


@query("""select l_orderkey document_url, sum(l_linenumber) accepted, sum(case when l_returnflag = 'R' and l_linenumber > 1 then l_linenumber - 1 else l_linenumber end) parsed,
sum(case when l_returnflag = 'R' and l_linenumber > 1 then l_linenumber - 1 else l_linenumber end) >= 0.9 * sum(l_linenumber) passed from lineitem group by 1""".replace("sum(l_linenumber) accepted", "cast(sum(l_linenumber) as bigint) accepted").replace("end) parsed", "end)::bigint parsed"))
def parse_rates(spark, sf_dir):
    n = F.col("l_linenumber")
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("document_url"), n.alias("accepted"), F.when((F.col("l_returnflag") == "R") & (n > 1), n - 1).otherwise(n).alias("parsed"))
    return manifests.parse_rates(rows)


@query(r"""select doc_id, trim(regexp_replace(nfc_normalize(coalesce(text, '')), '\s+', ' ', 'g')) normalized, regexp_replace(trim(regexp_replace(nfc_normalize(coalesce(text, '')), '\s+', ' ', 'g')), '[\s:：・()（）［］【】]', '', 'g') compacted from documents""")
def normalize_text(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", text.normalize_text(F.col("text")).alias("normalized"))
    return rows.select("doc_id", "normalized", text.compact(F.col("normalized")).alias("compacted"))


@query("select n_nationkey, n_name, row_number() over (order by n_name, n_nationkey) as position from nation")
def locale_sort(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    return n.select("n_nationkey", "n_name", F.row_number().over(Window.orderBy(F.collate("n_name", "ja"), "n_nationkey")).cast("long").alias("position"))  # a fixed dimension


@query("""select p_partkey, case when regexp_matches(u, '^https:') then regexp_extract(u, '(20[0-9]{2})([0-9]{2})([0-9]{2})', 1) || '-' || regexp_extract(u, '(20[0-9]{2})([0-9]{2})([0-9]{2})', 2) || '-' || regexp_extract(u, '(20[0-9]{2})([0-9]{2})([0-9]{2})', 3) end published, k category, regexp_matches(u, 'jitai') removes
from (select p_partkey, case p_partkey % 3 when 0 then 'medical' when 1 then 'dental' else 'pharmacy' end k, 'https://a.mhlw.go.jp/x/' || case when p_partkey % 4 = 0 then 'jitai' else 'shinki' end || '_z_' || case p_partkey % 3 when 0 then 'ika' when 1 then 'shika' else 'yakkyoku' end || '_' || cast(20200101 + p_partkey % 28 as varchar) || '.pdf' u from part)""")
def url_facts(spark, sf_dir):
    k = F.col("p_partkey")
    u = F.concat(F.lit("https://a.mhlw.go.jp/x/"), F.when(k % 4 == 0, "jitai").otherwise("shinki"), F.lit("_z_"), F.when(k % 3 == 0, "ika").when(k % 3 == 1, "shika").otherwise("yakkyoku"), F.lit("_"), (20200101 + k % 28).cast("string"), F.lit(".pdf"))
    rows, empty = table(spark, sf_dir, "part").select("p_partkey", u.alias("u")), F.lit("")
    return rows.select("p_partkey", links.date_from_url(F.col("u")).alias("published"), links.category_from_url(F.col("u")).alias("category"), (links.action(empty, F.col("u"), empty, empty) == "remove").alias("removes"))
