"""Text normalisation as columns. Only NFKC needs Python; everything else stays in the JVM."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: White space as registers use it: Unicode white space and the byte order mark.
WHITE = "(?U)[\\s\\uFEFF]"

# Keywords of the three facility categories.
DENTAL = "歯科|しか|shika|sika"
PHARMACY = "薬局|調剤|ちょうざい|yakkyoku|chouzai|chozai|pharmacy"
MEDICAL = "医科|いか|(?:^|[_\\-.])ika(?:[_\\-.]|\\z)|medical"

# Circled digits as optical recognition reads them.
CIRCLED, PLAIN = "⓪①②③④⑤⑥⑦⑧⑨．。，", "0123456789..,"


@F.pandas_udf(StringType())
def nfkc(values: pd.Series) -> pd.Series:
    return values.map(lambda v: v if v is None or v.isascii() else unicodedata.normalize("NFKC", v))


def squeeze(c: Column) -> Column:
    """White space runs become one space, ends are trimmed; null becomes empty."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), f"{WHITE}+", " "))


def normalize_text(c: Column) -> Column:
    return squeeze(nfkc(c))


def compact(normalized: Column) -> Column:
    """Without white space, colons, middle dots and brackets. Takes normalised text; square brackets are ASCII by then and stay."""
    return F.regexp_replace(normalized, "(?U)[\\s:：・()（）［］【】]", "")


def digits(normalized: Column) -> Column:
    return F.regexp_replace(normalized, "[^0-9]", "")


def category(normalized: Column) -> Column:
    """medical, dental or pharmacy if keywords of just one of them occur, else null."""
    text = F.regexp_replace(F.lower(normalized), f"{WHITE}+", "")
    hits = [(name, text.rlike(pattern)) for name, pattern in (("dental", DENTAL), ("pharmacy", PHARMACY), ("medical", MEDICAL))]
    one = sum((h.cast("int") for _, h in hits), F.lit(0)) == 1
    return F.when(one, F.when(hits[0][1], "dental").when(hits[1][1], "pharmacy").otherwise("medical"))


def facility_name(c: Column) -> Column:
    """The form that names are searched in: NFKC, lower case, no white space, middle dots, dashes, long-vowel marks or brackets."""
    return F.regexp_replace(F.lower(nfkc(F.coalesce(c, F.lit("")))), "(?U)[\\s\\uFEFF・･\\-‐‑‒–—―ーｰ()（）［］\\[\\]【】]+", "")


def ocr_text(c: Column) -> Column:
    return F.translate(c, CIRCLED, PLAIN)


def utf16_length(c: Column) -> Column:
    """Length in UTF-16 units, so that a supplementary character counts as two."""
    return (F.octet_length(F.encode(c, "UTF-16BE")) / 2).cast("int")


def split_names(c: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), "\\r?\\n"), squeeze), lambda x: x != "")


# Postal codes, acceptance numbers with the look-alikes of optical recognition, and lines that name no filing.
POSTAL = "〒\\s*[0-9]{3}\\s*[-ー－]?\\s*[0-9]{4}"
ACCEPTANCE = "[（(]([^（）()]+)[）)]\\s*[第策笠]\\s*([^第策笠（）()\\s]*?)\\s*[号旨旭三]"
NO_NAME = ("[：:]", "^(?:病床|病棟|区分|届出を行う点数|看護|配置|有\\z|無\\z)", "^[0-9①-⑳]")


def clean_address(normalized: Column) -> Column:
    text = F.regexp_replace(F.regexp_replace(normalized, POSTAL, ""), f"{WHITE}+", "")
    return F.nullif(F.regexp_replace(text, "^[|_]+", ""), F.lit(""))


def acceptance(normalized: Column) -> Column:
    """struct(abbreviation, acceptance_number) of a bracketed abbreviation with its number, tolerant of look-alikes; else null."""
    number = F.concat(F.lit("第"), F.regexp_replace(F.regexp_extract(normalized, ACCEPTANCE, 2), f"{WHITE}+", ""), F.lit("号"))
    return F.when(normalized.rlike(ACCEPTANCE), F.struct(squeeze(F.regexp_extract(normalized, ACCEPTANCE, 1)).alias("abbreviation"), number.alias("acceptance_number")))


def is_standard_name(normalized: Column) -> Column:
    good = normalized != ""
    for pattern in NO_NAME:
        good &= ~normalized.rlike(pattern)
    return good


def category_label(c: Column) -> Column:
    return F.when(c == "medical", "医科").when(c == "dental", "歯科").when(c == "pharmacy", "薬局")
