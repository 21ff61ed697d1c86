"""Benchmark decontamination: spaced seeds over words find candidate alignments, verified with room for substitutions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sakuin.llm.shared import durable

#: Of one span. Any 13 aligned words with at most two substitutions hold a hit of one of them (tests try all cases).
MASKS = ("11110011", "11010111")
WINDOW = 13
SUBSTITUTIONS = 2
LEAST = 5  # benchmark items with fewer words are too short to tell
BLOCK = 100_000  # benchmark seeds that are broadcast, at most: a row has a key, an id and up to 25 word hashes, so some 25 MB; more are joined by key
SLOTS = 1 << 22  # bytes of the table of seeds that tells which places of a text can hit, at most
_TOKENS = "filter(split(lower(text), '[^\\\\p{L}\\\\p{N}]+'), w -> w != '')"


def _key(mask: str, number: int, h: Column, i: Column) -> Column:
    return F.xxhash64(F.lit(number), *[F.get(h, i + k) for k, c in enumerate(mask) if c == "1"])


def _hashed(rows: DataFrame, *keep: str) -> DataFrame:
    """Word hashes of (text): words are runs of letters and digits, lower-cased; null text has none."""
    words = rows.select(*keep, F.coalesce("text", F.lit("")).alias("text")).selectExpr(*keep, f"{_TOKENS} words")
    return words.selectExpr(*keep, "transform(words, w -> xxhash64(w)) h")


def _places(mask: str, h: Column) -> Column:
    return F.when(F.size(h) >= len(mask), F.sequence(F.lit(0), F.size(h) - len(mask))).otherwise(F.array().cast("array<int>"))


def _entry(mask: str, number: int, reach: int):
    """A benchmark item's seed at a place, with the words around it that a window over the seed can hold."""
    first = lambda i: F.greatest(i - reach, F.lit(0))
    return lambda i: F.struct(_key(mask, number, F.col("ih"), i).alias("key"), (i - first(i)).alias("ioff"), F.slice("ih", first(i) + 1, i - first(i) + reach + 1).alias("inear"))


def _can_hit(mask: str, number: int, table: bytes):
    """Whether any benchmark seed falls into the slot of a text's seed."""
    slot = lambda i: F.pmod(_key(mask, number, F.col("h"), i), F.lit(len(table))).cast("int")
    return lambda i: F.call_function("substring", F.lit(table), slot(i) + 1, F.lit(1)) == F.lit(b"\x01")


def _place(mask: str, number: int, reach: int):
    """A text's seed at a place, with the words around it that a window over the seed can hold."""
    first = lambda i: F.greatest(i - reach, F.lit(0))
    return lambda i: F.struct(_key(mask, number, F.col("h"), i).alias("key"), (i - first(i)).alias("off"), F.slice("h", first(i) + 1, i - first(i) + reach + 1).alias("near"))


def _slots(keys: DataFrame, slots: int) -> bytes:
    """One byte a slot: 1 where a key falls. It comes to the driver as bitmaps of 32,768 slots."""
    at = (F.pmod("key", F.lit(slots)) + 1).alias("at")
    maps = keys.select(at).groupBy(F.expr("bitmap_bucket_number(at)").alias("b")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(at))").alias("bits"))
    bits, table = [bytes(b >> k & 1 for k in range(8)) for b in range(256)], bytearray(slots)
    for r in maps.collect():
        part = b"".join(bits[b] for b in r["bits"])
        start = (r["b"] - 1) << 15
        table[start : start + len(part)] = part[: slots - start]
    return bytes(table)


def overlaps(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, window: int = WINDOW, substitutions: int = SUBSTITUTIONS, block: int = BLOCK) -> DataFrame:
    """Pairs (doc_id, item_id) that overlap, with the most equal words in any window.

    A document and an item overlap if, at some alignment, `window` consecutive words of both agree but for at most
    `substitutions` words. An item with fewer words than `window` must occur whole and exact; one with fewer than
    LEAST words never overlaps. Words of all of a text count. The masks need one span.

    Every window that counts holds a seed, so a hit needs only the words that a window over its seed can hold, on both sides: a
    row has a fixed size whatever the length of items and texts. A table of one byte a slot tells which places of a text can hit
    at all; only those leave the text's row. Up to `block` seeds of the benchmark are broadcast, and documents are never shuffled;
    more are joined by key. Null ids are kept and null texts match nothing. Rows with the same ids count as one pair. Other
    columns are ignored; an empty table on either side gives an empty result.
    """
    span, reach = len(masks[0]), window - 1
    items = _hashed(benchmark, "item_id").where(f"size(h) >= {LEAST}").withColumnRenamed("h", "ih")
    short = sorted(r[0] for r in items.selectExpr("size(ih) n").where(f"n < {span}").distinct().collect())  # at most span - LEAST lengths
    seeds = [(k, m) for k, m in enumerate(masks)] + [(len(masks) + k, "1" * n) for k, n in enumerate(short)]

    keys = None
    for number, mask in seeds:
        fits = F.size("ih") >= span if number < len(masks) else F.size("ih") == len(mask)
        at = F.transform(_places(mask, F.col("ih")), _entry(mask, number, reach))
        made = items.where(fits).select("item_id", F.size("ih").alias("n"), F.explode(at).alias("x")).select("item_id", "n", "x.*")
        keys = made if keys is None else keys.unionByName(made)
    keys = durable(keys, "seeds")
    total = keys.count()
    table = _slots(keys, min(SLOTS, 1 << max(12, (16 * total).bit_length())))

    rows, h = _hashed(docs, "doc_id"), F.col("h")
    arrays = [F.transform(F.filter(_places(mask, h), _can_hit(mask, number, table)), _place(mask, number, reach)) for number, mask in seeds]
    # The outer explode keeps the optimizer from testing the arrays twice, once below the hashes.
    places = rows.select("doc_id", F.explode_outer(F.concat(*arrays)).alias("x")).select("doc_id", "x.*")
    hits = places.join(F.broadcast(keys) if total <= block else keys, "key")
    equal = "transform(sequence(0, size(inear) - 1), j -> case when get(near, off - ioff + j) = inear[j] then 1 else 0 end)"
    most = "array_max(transform(sequence(0, size(eq) - width), s -> cast(aggregate(slice(eq, s + 1, width), 0, (a, e) -> a + e) as bigint)))"
    checked = hits.selectExpr("doc_id", "item_id", "n", f"least({window}, n) width", f"{equal} eq").selectExpr("doc_id", "item_id", "cast(n as bigint) n_words", "width", f"{most} matched")
    checked = checked.where(f"matched >= width - case when n_words >= {window} then {substitutions} else 0 end")
    return checked.groupBy("doc_id", "item_id").agg(F.max("matched").alias("matched"), F.max("n_words").alias("n_words"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that overlap no benchmark item. Those without a doc_id can't be told apart: they all go if one of them overlaps."""
    bad = overlaps(docs, benchmark).select("doc_id").distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["doc_id"]), "left_anti")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return overlaps(docs, benchmark)


OP5_SQL = r"""
with d as (select doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') w from documents),
b as (select item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') w from benchmark),
dw as (select doc_id, unnest(w) word, generate_subscripts(w, 1) p from d),
bw as (select item_id, len(w) n, unnest(w) word, generate_subscripts(w, 1) j from b where len(w) >= 5),
m as (select distinct doc_id, item_id, n, p - j diag, j from dw join bw using (word)),
c as (select doc_id, item_id, n, count(*) over (partition by doc_id, item_id, diag order by j range between current row and 12 following) k from m)
select doc_id, item_id, cast(max(k) as bigint) matched, cast(max(n) as bigint) n_words from c
where k >= case when n >= 13 then 11 else n end group by doc_id, item_id
"""
