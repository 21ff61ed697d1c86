"""MinHash fingerprints of whole texts, and near duplicates from bands of them.

A fingerprint holds, for each of 128 universal hash functions, 16 bits of the least hash over a text's 5-word shingles; the share
of places in which two fingerprints agree estimates the Jaccard similarity of their shingles. Near duplicates agree in all places
of one band at least; such pairs are measured from the texts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sakuin.llm.jaccard_join import components, shingle_set
from sakuin.llm.shared import durable

PLACES = 128
BAND = 4  # places of a band: at a similarity of 0.75, a pair shares one of 32 bands but for 5 in a million
NUM, DEN = 3, 4  # pairs link at this similarity or more
PART = 1 << 22  # characters of text whose shingles are hashed together
CELLS = 1 << 16  # shingles that one pass of a hash function takes

_RANDOM = np.random.default_rng(128)
_FACTORS = _RANDOM.integers(0, 1 << 63, PLACES, np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _RANDOM.integers(0, 1 << 63, PLACES, np.uint64) * np.uint64(2)


def least_hashes(sets: list[np.ndarray]) -> np.ndarray:
    """(sets x 128) least 32-bit hashes; a set without shingles has the greatest number everywhere.

    A function is h(x) = (a * x + b mod 2^64) div 2^32 with odd a; each runs over the shingles of many sets at once.
    """
    out = np.full((len(sets), PLACES), 0xFFFFFFFF, np.uint32)
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    every = np.concatenate(sets) if len(sets) else np.empty(0, np.uint64)
    for at in range(0, len(every), CELLS):
        x, own = every[at : at + CELLS], owner[at : at + CELLS]
        heads = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        rows, h = own[heads], np.empty_like(x)
        for k in range(PLACES):
            np.multiply(x, _FACTORS[k], out=h)
            np.add(h, _OFFSETS[k], out=h)
            least = (np.minimum.reduceat(h, heads) >> np.uint64(32)).astype(np.uint32)
            out[rows, k] = np.minimum(out[rows, k], least)
    return out


def prints(least: np.ndarray, sets: list[np.ndarray]) -> list[bytes]:
    """The fingerprints: 16 bits of each least hash; none for a set without shingles."""
    return [row.tobytes() if len(s) else b"" for row, s in zip((least & np.uint32(0xFFFF)).astype("<u2"), sets, strict=True)]


def likeness(a: bytes, b: bytes) -> float:
    """Share of places in which two fingerprints agree; two empty ones are alike."""
    if not a or not b:
        return float(a == b)
    return float(np.mean(np.frombuffer(a, "<u2") == np.frombuffer(b, "<u2")))


def edited(text: str, following: str) -> str:
    """The text with its last quarter of code points replaced by as many first ones of another, or by all that it has."""
    m = len(text) // 4
    return text[: len(text) - m] + following[:m]


def _judged(pairs: list[tuple[int | None, str, str]]) -> pa.RecordBatch:
    """Rows of results for (doc_id, text, text of the next document)."""
    texts, changed, after = [t for _, t, _ in pairs], [edited(t, u) for _, t, u in pairs], [u for _, _, u in pairs]
    own, new = [shingle_set(t) for t in texts], [shingle_set(t) for t in changed]
    same = [np.intersect1d(a, b, assume_unique=True) for a, b in zip(own, new, strict=True)]  # three quarters of both, hashed once
    both = least_hashes(same)
    rest = lambda sets: [np.setdiff1d(a, s, assume_unique=True) for a, s in zip(sets, same, strict=True)]
    mine = prints(np.minimum(both, least_hashes(rest(own))), own)
    theirs = prints(np.minimum(both, least_hashes(rest(new))), new)
    following = mine[1:]
    if after:  # rows are in order, so but for the last one the next document's fingerprint is there
        last = shingle_set(after[-1])
        following = [*following, prints(least_hashes([last]), [last])[0]]
    near = [[likeness(a, b) for a, b in zip(mine, other, strict=True)] for other in (theirs, following)]
    marks = [hashlib.sha256(t.encode()).digest() for t in changed]
    cols = [pa.array([i for i, _, _ in pairs], pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array(marks, pa.binary()), pa.array(mine, pa.binary()), pa.array(theirs, pa.binary()), *[pa.array(x, pa.float64()) for x in near]]
    n = len(pairs)
    return pa.RecordBatch.from_arrays([*cols, pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())], names=_NAMES)


_RESULT = "doc_id long, n_chars long, edited binary, print binary, edited_print binary, near_edited double, near_next double"
_EDGE = "part int, first binary, last binary"
_NAMES = [c.split()[0] for c in f"{_RESULT}, {_EDGE}".split(", ")]


def _squeeze(batches):
    """(doc_id, tag, text) with texts compressed, as the only shuffle of whole texts moves them."""
    press = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([press.compress(t.as_py() or b"") for t in batch.column(2)], pa.binary())], names=["doc_id", "tag", "packed"])


def _walk(batches):
    """A range of documents in order: results of all but the last, and a row with the first and the last one's texts."""
    unpack = zstandard.ZstdDecompressor()
    part, first, held, ready, size = TaskContext.get().partitionId(), None, None, [], 0
    for batch in batches:
        for i, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            packed = packed.as_py()
            text = unpack.decompress(packed).decode()
            if held is None:
                first = packed
            else:
                ready.append((held[0], held[1], text))
                size += len(text)
                if size >= PART:
                    yield _judged(ready)
                    ready, size = [], 0
            held = i, text, packed
    if ready:
        yield _judged(ready)
    if held is not None:
        own = [pa.array([held[0]], pa.int64()), *[pa.nulls(1, t) for t in (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64())]]
        yield pa.RecordBatch.from_arrays([*own, pa.array([part], pa.int32()), pa.array([first], pa.binary()), pa.array([held[2]], pa.binary())], names=_NAMES)


def _join_edges(batches):
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        for i, last, first in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            yield _judged([(i, unpack.decompress(last).decode(), unpack.decompress(first).decode())]).select(_NAMES[:7])


def fingerprints(docs: DataFrame) -> DataFrame:
    """A row for each document: n_chars, the hash of its edited text, both fingerprints (binary), and how like its fingerprint is to
    the edited text's and to the next document's.

    Documents are dealt by ranges of doc_id in one shuffle; each range is walked in order, and the ends of ranges meet in a join with as
    many rows as there are ranges. Null texts are empty. Rows with one doc_id follow each other in order of a hash of their texts, a
    null doc_id comes first, and the last document is followed by the first, which may be itself. Other columns are ignored; an
    empty table gives none.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    packed = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("tag"), text.alias("text")).mapInArrow(_squeeze, "doc_id long, tag long, packed binary")
    by = [F.asc_nulls_first("doc_id"), F.asc("tag")]
    dealt = packed.repartitionByRange(*by, F.monotonically_increasing_id()).sortWithinPartitions(*by).select("doc_id", "packed")
    walked = durable(dealt.mapInArrow(_walk, f"{_RESULT}, {_EDGE}"), "fingerprints")
    ends = walked.where("part is not null")
    parts = sorted(r[0] for r in ends.select("part").collect())  # one number a range
    if not parts:
        return walked.select(*_NAMES[:7])
    follows = spark.createDataFrame(list(zip(parts, [*parts[1:], parts[0]], strict=True)), "part int, next int")
    pairs = ends.select("part", "doc_id", "last").join(follows, "part").join(ends.select(F.col("part").alias("next"), "first"), "next").select("doc_id", "last", "first")
    return walked.where("part is null").select(*_NAMES[:7]).unionByName(pairs.mapInArrow(_join_edges, _RESULT))


def likeness_of(a: Column, b: Column) -> Column:
    """likeness of two fingerprints as a column."""
    places = F.sequence(F.lit(1), F.lit(2 * PLACES - 1), F.lit(2))
    agree = F.aggregate(places, F.lit(0), lambda n, i: n + (F.substring(a, i, F.lit(2)) == F.substring(b, i, F.lit(2))).cast("int")) / F.lit(float(PLACES))
    return F.when((F.octet_length(a) == 0) | (F.octet_length(b) == 0), (a == b).cast("double")).otherwise(agree)


def near_duplicates(docs: DataFrame, printed: DataFrame | None = None, num: int = NUM, den: int = DEN) -> DataFrame:
    """doc_id, class_id and n_links of every row: documents in one class are joined by links, pairs at a similarity of num / den or more.

    printed: doc_id, print of the same rows (see fingerprints), where they are there already. Documents of one fingerprint are
    one representative. Representatives that agree in a band meet that band's smallest id, and the pairs are measured from their
    texts; those that don't link with it meet the smallest among themselves, and so on until none is left, so a bucket of near
    copies costs as many pairs as it has members. Two members of which one links with the smallest and one doesn't are left to the other
    bands that they share: like the bands themselves, this can miss a link, and never makes a wrong one.
    n_links: the links found with other fingerprints, the document's and those of the same fingerprint. Texts without shingles,
    and rows without doc_id, link with nothing. Rows of one doc_id are linked. An empty table gives none; other columns are ignored.
    """
    printed = durable((fingerprints(docs) if printed is None else printed).select("doc_id", "print"), "prints")
    able = printed.where("octet_length(print) > 0 and doc_id is not null")
    marked = able.withColumn("mark", F.xxhash64("print"))
    reps = durable(marked.groupBy("mark", "print").agg(F.min("doc_id").alias("rep")), "reps")
    bands = F.array(*[F.xxhash64(F.lit(k), F.substring("print", 2 * BAND * k + 1, 2 * BAND)) for k in range(PLACES // BAND)])
    open_ = durable(reps.select("rep", F.explode(F.array_distinct(bands)).alias("band")), "bands")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    links, known = None, None
    while True:
        buckets = durable(open_.groupBy("band").agg(F.min("rep").alias("lead"), F.max("rep").alias("last")).where("lead < last").select("band", "lead"), "buckets")
        members = durable(open_.join(buckets, "band").where("rep > lead"), "members")
        if members.isEmpty():
            break
        fresh = members.select("rep", "lead").distinct()
        if known is not None:
            fresh = fresh.join(known, ["rep", "lead"], "left_anti")
        judged = durable(_measured(durable(fresh, "fresh"), texts, num, den), "judged")
        known = judged if known is None else known.unionByName(judged)
        found = judged.where("linked").select(F.col("rep").alias("a"), F.col("lead").alias("b"))
        links = found if links is None else links.unionByName(found)
        open_ = durable(members.join(known, ["rep", "lead"]).where("not linked").select("rep", "band"), "bands")
    none = docs.sparkSession.createDataFrame([], "a long, b long")
    links = none if links is None else links
    # of one doc_id with several fingerprints, and of rows that share one, all are linked
    named = marked.join(reps, ["mark", "print"]).select("doc_id", "rep")
    twice = named.where("doc_id <> rep").distinct()
    edges = links.unionByName(twice.selectExpr("doc_id a", "rep b"))
    found = components(edges)
    count = links.unionByName(links.selectExpr("b a", "a b")).groupBy("a").agg(F.count("*").alias("n"))
    rows = printed.join(marked.select("doc_id", "print", "mark").distinct().join(reps, ["mark", "print"]).select("doc_id", "print", "rep"), ["doc_id", "print"], "left")
    rows = rows.join(found, rows["doc_id"] == found["node"], "left").join(count, rows["rep"] == count["a"], "left")
    return rows.select("doc_id", F.coalesce("component", "doc_id").alias("class_id"), F.coalesce("n", F.lit(0).cast("long")).alias("n_links"))


def _measured(pairs: DataFrame, texts: DataFrame, num: int, den: int) -> DataFrame:
    """(rep, lead, linked) of pairs, from the texts' exact shingles. Of several texts under an id, the pair's best similarity counts."""

    def measure(batches):
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                s, t = shingle_set(x), shingle_set(y)
                both = len(np.intersect1d(s, t, assume_unique=True))
                linked.append(both > 0 and den * both >= num * (len(s) + len(t) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], names=["rep", "lead", "linked"])

    ids = pairs.select(F.col("rep").alias("id")).union(pairs.select("lead")).distinct()
    some = durable(texts.join(ids, "id"), "texts")
    first = pairs.join(some.select(F.col("id").alias("rep"), F.col("text").alias("ta")), "rep")
    both = first.join(some.select(F.col("id").alias("lead"), F.col("text").alias("tb")), "lead").select("rep", "lead", "ta", "tb")
    return both.mapInArrow(measure, "rep long, lead long, linked boolean").groupBy("rep", "lead").agg(F.max("linked").alias("linked"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    text = lambda c: F.lower(F.hex(c))
    return found.select("doc_id", "n_chars", text("edited").alias("edited_sha256"), text("print").alias("fingerprint"), text("edited_print").alias("edited_fingerprint"), "near_edited", "near_next")
