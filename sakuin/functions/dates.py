"""Calendar dates in register text: western, era and abbreviated era forms, and spreadsheet serials."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Year before the first year of each era.
ERAS = {"令和": 2018, "平成": 1988, "昭和": 1925}

# The forms that dates are written in.
_ERA = "(令和|平成|昭和)\\s*(元|[0-9]{1,2})\\s*年\\s*([0-9]{1,2})\\s*月\\s*([0-9]{1,2})\\s*日"
_WESTERN = "(?:^|[^0-9])([0-9]{4})[年/\\-.]([0-9]{1,2})[月/\\-.]([0-9]{1,2})日?(?:[^0-9]|\\z)"
_SHORT = "(?i)(?:R|R\\.|R-)\\s*([0-9]{1,2})[年./\\-]\\s*([0-9]{1,2})[月./\\-]\\s*([0-9]{1,2})日?"
_ANY_ERA = "(?:令和|平成|昭和)\\s*(?:元|[0-9]{1,2})\\s*年\\s*[0-9]{1,2}\\s*月\\s*[0-9]{1,2}\\s*日"
_ANY_WESTERN = "[0-9]{4}[年/\\-.][0-9]{1,2}[月/\\-.][0-9]{1,2}日?"
_ANY_SHORT = "[Rr]\\.?\\s*[0-9]{1,2}[年./\\-]\\s*[0-9]{1,2}[月./\\-]\\s*[0-9]{1,2}日?"


def calendar_date(year: Column, month: Column, day: Column) -> Column:
    """The date, or null if there is no such day."""
    return F.call_function("try_to_date", F.format_string("%04d-%02d-%02d", year, month, day))


def _let(value: Column, use) -> Column:
    """use(value), with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _written(piece: Column) -> Column:
    """The date that a piece of text in one of the forms holds. Four digits are a western year; an era is named; else it is Reiwa."""
    base = F.lit(ERAS["令和"])
    for era, before in ERAS.items():
        base = F.when(F.startswith(piece, F.lit(era)), F.lit(before)).otherwise(base)
    number = lambda n, k: F.get(n, F.lit(k)).try_cast("int")
    year = lambda n: F.when(F.length(F.get(n, F.lit(0))) == 4, number(n, 0)).otherwise(base + F.when(F.get(n, F.lit(0)) == "元", F.lit(1)).otherwise(number(n, 0)))
    return _let(F.regexp_extract_all(piece, F.lit("元|[0-9]+"), F.lit(0)), lambda n: calendar_date(year(n), number(n, 1), number(n, 2)))


def parse_date(normalized: Column) -> Column:
    """The first form that occurs decides: western, era, abbreviated era; a day that doesn't exist gives null. Each form is looked for
    once, and only while none was found."""
    forms = [F.nullif(F.regexp_extract(normalized, pattern, 0), F.lit("")) for pattern in (_WESTERN, _ERA, _SHORT)]
    return _let(F.coalesce(*forms), lambda piece: F.when(piece.isNotNull(), _written(piece)))


def _all(text: Column, pattern: str) -> Column:
    return F.filter(F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), parse_date), lambda d: d.isNotNull())


def as_of_dates(normalized: Column) -> Column:
    """Era dates that the text says it is current at."""
    return _all(normalized, f"{_ANY_ERA}\\s*現在")


def dates_in_text(normalized: Column) -> Column:
    return _all(normalized, f"{_ANY_ERA}|{_ANY_SHORT}|{_ANY_WESTERN}")


def max_date(dates: Column) -> Column:
    return F.array_max(dates)


def serial_date(c: Column) -> Column:
    """Spreadsheet day number 20000 to 80000, a fraction is cut; else null."""
    number = F.regexp_extract(c, "^([0-9]{4,5})(?:\\.[0-9]+)?\\z", 1).try_cast("int")
    low, high = F.lit(20000), c.try_cast("double") <= 80000
    return F.when((number >= low) & high, F.date_add(F.lit("1899-12-30").cast("date"), number))


def cell_dates(c: Column) -> Column:
    """Dates of a spreadsheet cell in the order of the text: a serial, or era and western dates."""
    text = F.coalesce(c, F.lit(""))
    serial = serial_date(F.trim(text))
    return F.when(serial.isNotNull(), F.array(serial)).otherwise(_all(text, f"{_ANY_ERA}|{_ANY_WESTERN}"))


NOTHING = "—"


def long_date(c: Column) -> Column:
    """A date, or text that holds one, in words; other text as it is, nothing as a dash."""
    raw = c.cast("string")
    return F.coalesce(F.date_format(F.call_function("try_to_date", raw), "yyyy年M月d日"), F.nullif(raw, F.lit("")), F.lit(NOTHING))


def tokyo_time(c: Column) -> Column:
    """A moment, or text that holds one (without a zone: of the session's), as Tokyo's clock shows it; other text as it is, nothing as a dash."""
    raw = c.cast("string")
    there = F.convert_timezone(None, F.lit("Asia/Tokyo"), F.call_function("try_to_timestamp", raw).cast("timestamp_ntz"))
    return F.coalesce(F.date_format(there, "yyyy/MM/dd HH:mm"), F.nullif(raw, F.lit("")), F.lit(NOTHING))


def grouped_number(c: Column) -> Column:
    """A whole number with its thousands apart; nothing as a dash."""
    return F.coalesce(F.format_number(c, 0), F.lit(NOTHING))
