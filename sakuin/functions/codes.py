"""Facility codes and content keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The category's digit in a facility code.
CATEGORY_DIGITS = {"medical": "1", "dental": "3", "pharmacy": "4"}
PREFIX = 4


def category_digit(category: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, digit in CATEGORY_DIGITS.items():
        out = F.when(category == name, F.lit(digit)).otherwise(out)
    return out


def category_of(code: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, digit in CATEGORY_DIGITS.items():
        out = F.when(F.substring(code, 3, 1) == digit, F.lit(name)).otherwise(out)
    return out


def full_code(prefecture: Column, category: Column, local: Column) -> Column:
    return F.concat(prefecture, category_digit(category), F.lpad(local, 7, "0"))


def code_parts(code: Column) -> Column:
    return F.struct(F.substring(code, 1, 2).alias("prefecture_code"), category_of(code).alias("category"), F.substring(code, 4, 7).alias("local_code"), F.substring(code, 1, PREFIX).alias("prefix"))


def extract_code(normalized: Column) -> Column:
    """The ten digits of a facility code in normalised text, or null."""
    number = F.regexp_replace(normalized, "[^0-9]", "")
    return F.when(number.rlike("^[0-9]{2}[134][0-9]{7}\\z"), number)


def required_code(normalized: Column) -> Column:
    return F.coalesce(extract_code(normalized), F.raise_error(F.concat(F.lit("not a facility code: "), F.coalesce(normalized, F.lit("null")))))


def sheet_code(normalized: Column) -> Column:
    """struct(local_code, full_code) of a sheet's code cell: ten digits of a prefecture up to 49, or up to seven local digits; else null."""
    number = F.regexp_replace(normalized, "[^0-9]", "")
    whole = number.rlike("^[0-4][0-9][134][0-9]{7}\\z")
    local = F.when(whole, F.substring(number, 4, 7)).when((number != "") & (F.length(number) <= 7), F.lpad(number, 7, "0"))
    return F.when(local.isNotNull(), F.struct(local.alias("local_code"), F.when(whole, number).alias("full_code")))


# The shapes that notices print codes in.
_SEPARATOR = "\\s*[,，.\\-－・]\\s*"
_PRINTED = f"^(?:[0-9]{{1,3}}{_SEPARATOR}[0-9]{{3,4}}{_SEPARATOR}[0-9]|[0-9]{{3}}\\s+[0-9]{{3}}\\s*[.．]\\s*[0-9]|[0-9]{{2}}\\s*[-－]\\s*[0-9]{{5}}|[0-9]{{7}}|[0-9]{{10}})\\z"


def printed_code(normalized: Column) -> Column:
    """struct(local_code, full_code) of a code as printed on notices; a leading bracket or any other shape gives null."""
    number = F.regexp_replace(normalized, "[^0-9]", "")
    whole = number.rlike("^[0-9]{2}[134][0-9]{7}\\z")
    local = F.when(whole, F.substring(number, 4, 7)).when(F.length(number) == 7, number)
    return F.when(normalized.rlike(_PRINTED) & local.isNotNull(), F.struct(local.alias("local_code"), F.when(whole, number).alias("full_code")))


def standard_id(abbreviation: Column, name: Column) -> Column:
    return F.substring(F.sha2(F.to_json(F.array(abbreviation, name)), 256), 1, 16)


def _inside(*values: Column) -> Column:
    json = F.to_json(F.array(*values))
    return json.substr(F.lit(2), F.length(json) - 2)


def event_id(document_sha: Column, page: Column, code: Column, action: Column, abbreviation: Column, name: Column, acceptance: Column, effective: Column) -> Column:
    """Key of a change event; the page is a number in the hashed array and all else are strings or null."""
    array = F.concat(F.lit("["), _inside(document_sha), F.lit(","), page.cast("string"), F.lit(","), _inside(code, action, abbreviation, name, acceptance, effective), F.lit("]"))
    return F.substring(F.sha2(array, 256), 1, 24)
