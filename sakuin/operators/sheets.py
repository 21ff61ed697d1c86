"""Spreadsheet rows to facility records: header detection, fill-down, filings of a cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sakuin.functions import codes, dates, text
from sakuin.operators import merge, search
from sakuin.operators.tables import kept

# Header cells, compacted, that name each field.
HEADERS = {
    "code": "^(?!併設)(?:保険)?(?:医療機関|薬局)(?:番号|コード)\\z",
    "prefecture_code": "^都道府県コード\\z",
    "category": "^区分\\z",
    "name": "(?:保険)?(?:医療機関|薬局)(?:名称|名)\\z",
    "address": "(?:医療機関|薬局)?所在地(?:住所)?\\z",
    "standard_name": "(?:受理)?(?:届出|施設基準)(?:項目)?(?:名称|名)\\z",
    "abbreviation": "受理(?:記号|略称)\\z",
    "acceptance": "(?:届出)?受理番号\\z",
    "effective_from": "算定開始(?:年月日|日)\\z",
}
SHEET = ["document_url", "workbook", "sheet"]
MERGE = "merge"  # joins by sheet: tables with a row a sheet grow with the input, while sizes estimated from files stay below the broadcast limit


def fill_down(rows: DataFrame, partition: list[str], order: str, columns: list[str]) -> DataFrame:
    """Each column's last value at or above the row; independent of the others."""
    window = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumns({c: F.last(c, ignorenulls=True).over(window) for c in columns})


def paired(values: Column, n: Column, pos: Column, broadcast_one: bool) -> Column:
    """The value for position pos of n: by position where counts agree; a single one for all (or, without broadcast_one, only if
    n is 1); else null."""
    one = (F.size(values) == 1) if broadcast_one else ((F.size(values) == 1) & (n == 1))
    return F.when(F.size(values) == n, F.get(values, pos)).when(one, F.get(values, F.lit(0)))


def names_in(context: Column, names: Column) -> Column:
    """Codes of those (code, name) whose name the context holds, in the array's order."""
    return F.transform(F.filter(names, lambda x: F.contains(context, x["name"])), lambda x: x["code"])


_ACCEPTANCE = "[（(]([^（）()\\r\\n]+)[）)]\\s*(第\\s*[^第（(\\r\\n]*?号)?"


def filings(rows: DataFrame) -> DataFrame:
    """One row per filing of a sheet row: pos, abbreviation, standard_name, acceptance_number, effective_from.

    rows: the text columns c_acceptance, c_standard_name, c_abbreviation and c_effective_from. Every bracketed acceptance is a
    filing, and names and dates go with them by position; without one, the plain columns are one filing, or none if both number
    and name are empty.
    """
    cell = lambda c: F.coalesce(F.col(c), F.lit(""))
    all_ = lambda g: F.regexp_extract_all(cell("c_acceptance"), F.lit(_ACCEPTANCE), F.lit(g))
    rows = rows.withColumns({"x_abbr": all_(1), "x_number": all_(2), "x_names": text.split_names(text.nfkc(cell("c_standard_name"))), "x_dates": dates.cell_dates(cell("c_effective_from"))})
    plain_number, plain_abbr = text.normalize_text(cell("c_acceptance")), text.normalize_text(cell("c_abbreviation"))
    rows = rows.withColumns({"x_plain": plain_number, "x_plain_abbr": F.nullif(plain_abbr, F.lit(""))})
    n = F.size("x_abbr")
    indexes = F.when(n > 0, F.sequence(F.lit(0), n - 1)).when((F.col("x_plain") != "") | (F.size("x_names") > 0), F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))
    rows = rows.withColumn("x_n", n).withColumn("pos", F.explode(indexes))
    pos, bracketed = F.col("pos"), F.col("x_n") > 0
    tidy = lambda c: F.nullif(text.squeeze(c), F.lit(""))
    return rows.withColumns({
        "abbreviation": F.when(bracketed, tidy(F.get("x_abbr", pos))).otherwise(F.col("x_plain_abbr")),
        "standard_name": F.when(bracketed, paired(F.col("x_names"), F.col("x_n"), pos, broadcast_one=False)).otherwise(F.get("x_names", F.lit(0))),
        "acceptance_number": F.when(bracketed, text.squeeze(F.get("x_number", pos))).otherwise(F.col("x_plain")),
        "effective_from": F.when(bracketed, paired(F.col("x_dates"), F.col("x_n"), pos, broadcast_one=True)).otherwise(F.get("x_dates", F.lit(0))),
    }).drop("x_abbr", "x_number", "x_names", "x_dates", "x_plain", "x_plain_abbr", "x_n")


def header_columns(cells: DataFrame) -> DataFrame:
    """Per sheet: header_row and the column of each field.

    cells: SHEET, row_number, column, value (normalised). A header may be stacked over up to three rows; of the first 50 rows
    and columns, the first row with cells counts that has a code, a name and an acceptance number or filing name; per field its first column.
    """
    near = cells.where("row_number <= 50 and column <= 50")
    cell = [*SHEET, "column"]
    spread = near.select(*SHEET, "column", "value", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("up"), "row_number").withColumn("at", F.col("row_number") + F.col("up"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_number", "value"))), lambda x: x["value"]), "")
    stacked = spread.groupBy(*cell, "at").agg(text.compact(joined).alias("header"), F.min("up").alias("up"))
    fields = stacked.groupBy(*SHEET, "at").agg(F.min("up").alias("up"), *[F.min(F.when(F.col("header").rlike(p), F.col("column"))).alias(f) for f, p in HEADERS.items()]).where("up = 0")
    good = fields.where("code is not null and name is not null and (acceptance is not null or standard_name is not null)")
    first = good.groupBy(*SHEET).agg(F.min_by(F.struct("at", *HEADERS), "at").alias("h"))
    return first.select(*SHEET, F.col("h.at").alias("header_row"), *[F.col(f"h.{f}").alias(f"col_{f}") for f in HEADERS])


def records(rows: DataFrame, documents: DataFrame, prefectures: list[tuple[str, str]], bureau_prefectures: dict[str, list[str]] | None = None) -> tuple[DataFrame, DataFrame]:
    """(filings, quarantine) of sheet rows.

    rows: SHEET, row_number, cells map<int,string>; documents: document_url, source_id, bureau_name, page_url, as_of, category_hint,
    context, sha256. filings has code, ord, pos, the facility's and the filing's columns. quarantine has sheets without a header and
    rows whose prefecture or category stays unknown.
    """
    cells = rows.select(*SHEET, "row_number", F.explode("cells").alias("column", "raw")).withColumn("value", text.normalize_text(F.col("raw"))).where("value <> ''")
    heads = header_columns(cells)
    lines = cells.where("row_number <= 20").groupBy(*SHEET, "row_number").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("column", "value"))), lambda x: x["value"]), " ").alias("line"))
    tops = lines.groupBy(*SHEET).agg(F.transform(F.array_sort(F.collect_list(F.struct("row_number", "line"))), lambda x: x["line"]).alias("lines"))
    meta = rows.select(*SHEET).distinct().join(tops.hint(MERGE), SHEET, "left").join(documents.hint(MERGE), "document_url").withColumn("lines", F.coalesce("lines", F.array().cast("array<string>")))
    names = F.array(*[F.struct(F.lit(c).alias("code"), F.lit(n).alias("name")) for c, n in prefectures])
    only = {k: v[0] for k, v in (bureau_prefectures or {}).items() if len(v) == 1}
    fallback = F.create_map(*[F.lit(x) for kv in only.items() for x in kv])[F.col("source_id")] if only else F.lit(None).cast("string")
    context = text.normalize_text(F.concat_ws(" ", "context", "workbook", "sheet", F.array_join("lines", " ")))
    title = text.normalize_text(F.concat_ws(" ", "workbook", "sheet", F.array_join(F.slice("lines", 1, 2), " ")))
    meta = meta.withColumns({"x_context": context, "x_title": title})
    meta = meta.withColumns({"prefecture_hint": F.coalesce(F.get(names_in(F.col("x_context"), names), F.lit(0)), fallback), "category_hint": F.coalesce(text.category(F.col("x_title")), "category_hint")}).drop("x_context", "x_title", "lines")

    body = rows.join(heads.hint(MERGE), SHEET).where("row_number > header_row")
    body = body.select(*SHEET, "row_number", *[F.coalesce(F.try_element_at("cells", F.col(f"col_{f}")), F.lit("")).alias(f"c_{f}") for f in HEADERS])
    body = body.withColumns({f"n_{f}": text.normalize_text(F.col(f"c_{f}")) for f in ("code", "name", "address", "category", "prefecture_code")})
    own = {"code": codes.sheet_code(F.col("n_code")), "name": F.nullif("n_name", F.lit("")), "address": F.nullif("n_address", F.lit(""))}
    filled = fill_down(body.withColumns({f"f_{k}": v for k, v in own.items()}), SHEET, "row_number", [f"f_{k}" for k in own])
    listed = filings(filled.where("f_code is not null and f_name is not null")).join(meta.hint(MERGE), SHEET)

    digits = text.digits(F.col("n_prefecture_code"))
    whole = F.col("f_code.full_code")
    category = F.when(whole.isNotNull(), codes.category_of(whole)).otherwise(F.coalesce(text.category(F.col("n_category")), "category_hint"))
    prefecture = F.when(whole.isNotNull(), F.substring(whole, 1, 2)).when(digits.rlike("^[0-9]{1,2}\\z"), F.lpad(digits, 2, "0")).otherwise(F.col("prefecture_hint"))
    out = listed.withColumns({"category": category, "prefecture_code": prefecture})
    unknown = F.col("category").isNull() | F.col("prefecture_code").isNull()
    code = F.coalesce(whole, codes.full_code(F.col("prefecture_code"), F.col("category"), F.col("f_code.local_code")))
    good = out.where(~unknown).select(
        code.alias("code"), F.struct(*SHEET, "row_number").alias("ord_key"), "pos", F.col("f_name").alias("name"), F.col("f_address").alias("address"), "category", "prefecture_code",
        F.col("f_code.local_code").alias("local_code"), "abbreviation", "standard_name", "acceptance_number", "effective_from", "as_of", "source_id", "bureau_name", "page_url", "document_url", F.col("sha256").alias("document_sha256"), "workbook", F.col("sheet").alias("worksheet"), F.col("row_number").alias("ord"),
    )
    no_head = rows.select(*SHEET).distinct().join(heads.hint(MERGE), SHEET, "left_anti").select(*SHEET, F.lit(None).cast("int").alias("row_number"), F.lit("no header row").alias("problem"))
    bad = out.where(unknown).select(*SHEET, "row_number", F.lit("prefecture or category unknown").alias("problem")).distinct()
    return good, no_head.unionByName(bad)


def workbook_records(found: DataFrame, collation: str | None = "ja") -> DataFrame:
    """One record for each code of a workbook: name (the longest), address (the first), category, prefecture_code, local_code, as_of,
    standards (distinct, in Japanese order of abbreviation, name, acceptance number and date) and worksheets, in order.

    found: filings as records gives them. What the merge over workbooks makes of it has the order of rows instead.
    """
    found = kept(found)  # three aggregates read it
    book = ["document_url", "document_sha256", "workbook", "code"]
    order = F.struct("ord_key", "pos")
    merged = found.groupBy(*book).agg(
        merge.longest(F.col("name"), order).alias("name"), merge.first_value(F.col("address"), order).alias("address"), F.max("as_of").alias("as_of"),
        *[F.min_by(c, order).alias(c) for c in ("category", "prefecture_code", "local_code")], F.array_sort(F.collect_set("worksheet")).alias("worksheets"),
    )
    once = merge.distinct_filings(found.select(*book, F.col("ord_key").alias("ord"), "pos", *merge.FILING), by=tuple(book))
    key = F.concat_ws("\0", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in merge.FILING])
    listed = once.withColumn("key", key).groupBy(*book).agg(search.in_order(F.struct(*merge.FILING), "key", "ord", "pos", collation=collation).alias("standards"))
    return merged.join(listed.hint(MERGE), book)
