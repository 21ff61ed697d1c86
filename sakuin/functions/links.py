"""What document addresses tell: format, category, date, prefecture, action, label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sakuin.functions.text import category

HOST_SUFFIX = ".mhlw.go.jp"
# Words of notices that take something back, and of pages that list no filings.
REMOVES = "失効|辞退|廃止|取下げ|取り下げ"
EXCLUDED = "訪看|訪問看護|はり|きゅう|あん摩|柔道整復|コード表|略称|記号一覧|記載要領|PDFファイル内を検索する方法|検索方法"


def is_workbook(url: Column) -> Column:
    return url.rlike("(?i)\\.(?:xlsx|xlsm|zip)(?:\\z|[?#])")


def is_notice(url: Column) -> Column:
    return url.rlike("(?i)\\.pdf(?:\\z|[?#])")


def is_allowed(url: Column, suffix: str = HOST_SUFFIX) -> Column:
    return F.coalesce((F.call_function("try_parse_url", url, F.lit("PROTOCOL")) == "https") & F.call_function("try_parse_url", url, F.lit("HOST")).endswith(suffix), F.lit(False))


def path_of(url: Column) -> Column:
    return F.coalesce(F.call_function("try_parse_url", url, F.lit("PATH")), F.lit(""))


def _first(*found: Column) -> Column:
    return F.coalesce(*[F.nullif(f, F.lit("")) for f in found])


def category_from_url(url: Column) -> Column:
    path = path_of(url)
    number = _first(F.regexp_extract(path, "/[0-9]{2}_(01|03|04)_", 1), F.regexp_extract(path, "(?i)[-_](01|03|04)\\.pdf\\z", 1))
    return F.coalesce(category(url), F.when(number == "01", "medical").when(number == "03", "dental").when(number == "04", "pharmacy"))


def date_from_url(url: Column) -> Column:
    """ISO text as the address has it, without a calendar check: yyyymmdd, /yymmdd-, or an era year of one digit with mmdd."""
    path = path_of(url)
    western, short, era = "(20[0-9]{2})([0-9]{2})([0-9]{2})", "/(2[0-9])([0-9]{2})([0-9]{2})-", "(?:^|[_-])(0?[0-9])([0-9]{2})([0-9]{2})(?:[_.-]|\\z)"
    part = lambda p, g: F.regexp_extract(path, p, g)
    return (
        F.when(path.rlike(western), F.concat_ws("-", part(western, 1), part(western, 2), part(western, 3)))
        .when(path.rlike(short), F.concat(F.lit("20"), F.concat_ws("-", part(short, 1), part(short, 2), part(short, 3))))
        .when(path.rlike(era), F.concat_ws("-", (part(era, 1).try_cast("int") + 2018).cast("string"), part(era, 2), part(era, 3)))
    )


def prefecture_from_url(url: Column) -> Column:
    path = path_of(url)
    return _first(F.regexp_extract(path, "-(?:21|22)-([0-9]{2})-(?:01|03|04)", 1), F.regexp_extract(path, "/([0-9]{2})_(?:01|03|04)_", 1), F.regexp_extract(path, "(?i)_([0-9]{2})[a-z]+_(?:ika|shika|yakkyoku)_", 1))


def before_base_month(url: Column, base: Column) -> Column:
    pattern = "(20[0-9]{2})\\.([0-9]{1,2})-[12]_"
    path = path_of(url)
    month = F.concat_ws("-", F.regexp_extract(path, pattern, 1), F.lpad(F.regexp_extract(path, pattern, 2), 2, "0"))
    return path.rlike(pattern) & (month < F.date_format(base, "yyyy-MM"))


def action(anchor: Column, url: Column, nearby: Column, context: Column) -> Column:
    """remove or upsert; what stands closest to the link decides."""
    fresh = "新規|変更"
    return (
        F.when(F.concat_ws(" ", anchor, url).rlike(REMOVES) | url.rlike("(?i)jitai|sikkou|shikkou"), "remove")
        .when(anchor.rlike(fresh), "upsert")
        .when(nearby.rlike(REMOVES), "remove")
        .when(nearby.rlike(fresh), "upsert")
        .when(context.rlike(REMOVES), "remove")
        .otherwise("upsert")
    )


def label(url: Column) -> Column:
    """Decoded last segment of the path; the address itself where there is none or it can't be decoded."""
    last = F.element_at(F.split(path_of(url), "/"), -1)
    return F.coalesce(F.nullif(F.try_url_decode(last), F.lit("")), url)


def page_link(url: Column, page: Column) -> Column:
    return F.when(page > 0, F.concat(url, F.lit("#page="), page.cast("string"))).otherwise(url)


def search_link(base: str, text: Column) -> Column:
    return F.when(text == "", F.lit(base)).otherwise(F.concat(F.lit(f"{base}?q="), F.url_encode(text)))


def facility_link(base: str, code: Column) -> Column:
    return F.concat(F.lit(f"{base}/"), F.url_encode(code))
