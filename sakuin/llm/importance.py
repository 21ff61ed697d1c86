"""Drawing the documents that look most like a target: importance weights over hashed runs of words.

Documents become a sparse matrix, documents by buckets, kept as blocks of compressed sparse rows. Its column sums are the corpus's
distribution, those of the target's matrix the target's; the gain of a bucket is the logarithm of their ratio, and the product of
the matrix with the gains weighs each document. Noise added to the weights makes the highest ones a draw without replacement.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sakuin.llm.shared import durable

RUN = 1  # words of the longest run that is a feature
BUCKETS = 10_000
SEED = 2024
WORDS = 20  # documents with fewer are not drawn
PERCENT = 10
CELLS = 1 << 13  # cells and
ROWS = 512  # rows of a block
GROUP_BYTES = 4 << 20  # of a row group: readers decode one at a time, however many blocks a task reads
KNOWN = 1 << 20  # words whose bucket a task remembers

#: Bytes of words (0-9, a-z, all beyond ASCII), A-Z as a-z, everything else as a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_BLOCKS = "doc_id array<long>, words array<long>, start array<long>, bucket array<int>, n array<long>"


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def buckets_of(text: bytes, run: int, buckets: int, known: dict[bytes, int]) -> tuple[int, np.ndarray, np.ndarray]:
    """The number of words, and the distinct buckets of a text's features with their counts."""
    found = words(text)
    counts: Counter = Counter(found)
    if run > 1:
        for size in range(2, run + 1):
            counts.update(b" ".join(found[i : i + size]) for i in range(len(found) - size + 1))
    cells = np.empty(len(counts), np.int64)
    for i, feature in enumerate(counts):
        b = known.get(feature)
        if b is None:
            if len(known) >= KNOWN:
                known.clear()
            b = known[feature] = zlib.crc32(feature) % buckets
        cells[i] = b
    where, inverse = np.unique(cells, return_inverse=True)
    sums = np.zeros(len(where), np.int64)
    np.add.at(sums, inverse, np.fromiter(counts.values(), np.int64, len(counts)))
    return len(found), where, sums


def blocks(docs: DataFrame, run: int = RUN, buckets: int = BUCKETS) -> DataFrame:
    """The matrix of all rows as blocks: doc_id and words (both per row), start (of each row's cells, and the end), bucket and n (per
    cell). docs: doc_id, text; null text is empty and has an empty row."""

    def pack(batches):
        known: dict[bytes, int] = {}
        ids, sizes, starts, cols, counts = [], [], [0], [], []

        def block():
            flat = lambda x, kind: pa.array([x], pa.list_(kind))
            out = pa.RecordBatch.from_arrays([flat(ids, pa.int64()), flat(sizes, pa.int64()), flat(starts, pa.int64()), flat(np.concatenate(cols) if cols else [], pa.int32()), flat(np.concatenate(counts) if counts else [], pa.int64())], names=["doc_id", "words", "start", "bucket", "n"])
            for x in (ids, sizes, cols, counts):
                x.clear()
            starts[:] = [0]
            return out

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                size, where, n = buckets_of(text.as_py() or b"", run, buckets, known)
                ids.append(i), sizes.append(size), cols.append(where), counts.append(n), starts.append(starts[-1] + len(where))
                if starts[-1] >= CELLS or len(ids) >= ROWS:
                    yield block()
        if ids:
            yield block()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(pack, _BLOCKS)


def column_sums(matrix: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs: a task sums its blocks, and a row for each bucket and task is shuffled."""

    def add(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            np.add.at(total, batch.column(0).flatten().to_numpy(), batch.column(1).flatten().to_numpy())
        where = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(where, pa.int32()), pa.array(total[where])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for b, n in matrix.select("bucket", "n").mapInArrow(add, "bucket int, n long").groupBy("bucket").agg(F.sum("n")).collect():  # one row a bucket
        out[b] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of the ratio of both distributions, each with one more in every bucket."""
    size, s, t = len(corpus), float(corpus.sum() + len(corpus)), float(target.sum() + len(corpus))
    return np.array([math.floor(1000 * math.log((float(target[b] + 1) * s) / (float(corpus[b] + 1) * t))) for b in range(size)], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weights(matrix: DataFrame, gain: np.ndarray, run: int = RUN, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score): the product of the matrix with the gains, and with the noise of each id."""

    def multiply(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                ids, size, start, cols, n = (batch.column(c)[k].values for c in range(5))
                size, start = size.to_numpy(), start.to_numpy()
                sums = np.concatenate([[0], np.cumsum(gain[cols.to_numpy()] * n.to_numpy())])
                weight = sums[start[1:]] - sums[start[:-1]]
                features = sum(np.maximum(size - j, 0) for j in range(run))
                more = np.array([noise(i, seed) for i in ids.to_pylist()], np.int64)
                yield pa.RecordBatch.from_arrays([ids, pa.array(size), pa.array(features), pa.array(weight), pa.array(weight + more)], names=["doc_id", "n_words", "n_features", "weight", "score"])

    return matrix.mapInArrow(multiply, "doc_id long, n_words long, n_features long, weight long, score long")


def ranked(scored: DataFrame, percent: int = PERCENT, least: int = WORDS) -> DataFrame:
    """All rows with rank: 1, 2, 3... for the highest scores among the rows with enough words (ties: the smaller doc_id), as many as
    so many percent of these; null for all others.

    Rows are dealt by ranges of score and id, so places within a range and the ranges' sizes give ranks without one sort of all.
    """
    able = F.col("n_words") >= least
    by = [F.desc("score"), F.asc_nulls_first("doc_id")]
    placed = scored.where(able).repartitionByRange(*by, F.monotonically_increasing_id()).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id())
    placed = durable(placed.withColumn("part", F.shiftright("at", 33)), "ranges")
    sizes = sorted(placed.groupBy("part").count().collect())  # one row a range
    wanted, before, offsets = percent * sum(n for _, n in sizes) // 100, 0, []
    for part, n in sizes:
        offsets.append((part, before))
        before += n
    first = scored.sparkSession.createDataFrame(offsets, "part long, before long")
    rank = F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1) + 1
    drawn = placed.join(first, "part").withColumn("rank", F.when(rank <= wanted, rank)).drop("at", "part", "before")
    return drawn.unionByName(scored.where(~able).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, run: int = RUN, buckets: int = BUCKETS, percent: int = PERCENT, least: int = WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row of docs; target: text.

    Null and empty texts have no features and weigh 0. Rows with one doc_id share their noise, and equal rows have neighbouring ranks
    in any order; a null id hashes as the empty text and comes first among ties. An empty corpus gives an empty table; an empty
    target is a uniform one. Other columns are ignored.
    """
    matrix = durable(blocks(docs, run, buckets), "blocks", {"parquet.block.size": GROUP_BYTES})
    goal = column_sums(blocks(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), run, buckets), buckets)
    scored = durable(weights(matrix, gains(column_sums(matrix, buckets), goal), run, seed), "scored")
    return ranked(scored, percent, least).select("doc_id", "n_features", "weight", "score", "rank")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: crc32 by its table, which a rule makes; hashed once for each distinct word.
OP12_SQL = f"""
with crc as (select list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i: xor(c >> 1, (c & 1) * 3988292384), b)) t),
texts as (select 0 as side, doc_id, text from documents union all select 1, null, text from benchmark),
words as materialized (
    select side, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) w from texts),
keys as materialized (
    select w, xor(list_reduce(list_transform(range(cast(length(hex(encode(w))) as bigint) // 2), lambda i: cast(concat('0x', substr(hex(encode(w)), 2 * i + 1, 2)) as bigint)),
                              lambda c, b: xor(c >> 8, t[cast(xor(c, b) & 255 as integer) + 1]), 4294967295::bigint), 4294967295::bigint) % {BUCKETS} as bucket
    from (select distinct w from words), crc),
cells as materialized (select side, doc_id, bucket from words join keys using (w)),
sums as (select bucket, count(*) filter (side = 0) s, count(*) filter (side = 1) t from cells group by bucket),
total as (select count(*) filter (side = 0) s, count(*) filter (side = 1) t from cells),
gains as (select bucket, cast(floor(1000 * ln((cast(sums.t + 1 as double) * (total.s + {BUCKETS})) / (cast(sums.s + 1 as double) * (total.t + {BUCKETS})))) as bigint) g from sums, total),
sizes as (select doc_id, count(*) n, sum(g) w from cells join gains using (bucket) where side = 0 group by doc_id),
scored as (
    select d.doc_id, coalesce(n, 0) n, cast(coalesce(w, 0) as bigint) w,
           cast(coalesce(w, 0) + floor(-1000 * ln(-ln((cast(concat('0x', substr(sha256('{SEED}:' || d.doc_id), 1, 8)) as bigint) + 0.5::double) / 4294967296::double))) as bigint) score
    from documents d left join sizes using (doc_id)),
drawn as (select doc_id, row_number() over (order by score desc, doc_id) r, count(*) over () m from scored where n >= {WORDS})
select doc_id, n as n_features, w as weight, score, case when r <= {PERCENT} * m // 100 then r end as rank from scored left join drawn using (doc_id)"""
