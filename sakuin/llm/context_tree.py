"""Language-model scoring by context-tree weighting over bytes, each byte decomposed into eight binary decisions.

Under every context of up to DEPTH preceding bytes, each of the 255 decisions has a Krichevsky-Trofimov estimator. The
counts of all training texts are gathered by (context, byte); from the longest contexts up, the weighted probability of a
node is half its own estimate and half the product over its longer contexts. The weights of the trained tree then mix the
estimates of all depths into one probability for each bit; a node that training has never reached gives one half.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sakuin.llm.shared import durable, fold

DEPTH = 5
NODES = 3 << 19  # codes (a context and its byte) whose probabilities are broadcast, most frequent first: 24 MB at most; the others are joined
HEAD = 1 << 17  # tokens whose counts are broadcast, most frequent first; the others are joined
BUCKET_CODES = 1 << 16  # distinct codes of a bucket, on average; the number of buckets grows with the table
SPLIT_CODES = 1 << 23  # distinct codes from which a pair of nearest bytes is split by the third
PART = 1 << 20
END = 0xFF  # ends a text and stands before it; UTF-8 never has this byte

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_NODE = np.array([[1 << k | b >> (8 - k) for k in range(8)] for b in range(256)], np.int64)
_BIT = np.array([[b >> (7 - k) & 1 for k in range(8)] for b in range(256)], bool)


def lowered(text: str | None) -> bytes:
    return (text or "").encode().translate(_LOWER)


def codes_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Each byte with the DEPTH bytes before it (the nearest in the lowest place), and the first code of each text. END ends a
    text and stands before it."""
    sizes, end = np.array([len(t) + 1 for t in texts], np.int64), bytes([END])
    x = np.frombuffer(b"".join(end * DEPTH + t + end for t in texts), np.uint8).astype(np.uint64)
    codes = x.copy()
    for k in range(1, DEPTH + 1):
        codes[k:] |= x[:-k] << np.uint64(8 * k)
    starts = np.cumsum(sizes) - sizes
    keep = np.ones(len(x), bool)
    keep[(starts + DEPTH * np.arange(len(texts)))[:, None] + np.arange(DEPTH)] = False
    return codes[keep].view(np.int64), starts


def _parts(texts: list[bytes]):
    """Runs of texts of about PART bytes."""
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size > PART:
            yield part
            part, size = [], 0
    if part:
        yield part


def _counts(docs: DataFrame) -> DataFrame:
    """(word, code, k): how often words (code null; an empty word is the end of a text) and codes (word null) occur, by batch."""

    def gather(batches):
        for batch in batches:
            texts = [lowered(t) for t in batch.column(0).to_pylist()]
            words = Counter()
            for t in texts:
                words.update(t.split())
            words[b""] += len(texts)
            found = [np.unique(codes_of(part)[0], return_counts=True) for part in _parts(texts)]
            code, at = np.unique(np.concatenate([f[0] for f in found]) if found else np.empty(0, np.int64), return_inverse=True)
            k = np.bincount(at, weights=np.concatenate([f[1] for f in found]), minlength=len(code)).astype(np.int64) if found else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(list(words), pa.binary()), pa.nulls(len(words), pa.int64()), pa.array(list(words.values()), pa.int64())], names=["word", "code", "k"])
            yield pa.RecordBatch.from_arrays([pa.nulls(len(code), pa.binary()), pa.array(code), pa.array(k)], names=["word", "code", "k"])

    return docs.select("text").mapInArrow(gather, "word binary, code long, k long")


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series from x + 8 on, for x > 0."""
    low = np.zeros_like(x)
    for k in range(8):
        low += np.log(x + k)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - low


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a sequence with so many zeros and ones."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - math.log(math.pi) - _log_gamma(zeros + ones + 1.0)


def _sums(key: np.ndarray, *values: np.ndarray):
    order = np.argsort(key, kind="stable")
    key = key[order]
    heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
    return (key[heads], *[np.add.reduceat(v[order], heads) if len(heads) else v[:0] for v in values])


def _key(depth: int, context: np.ndarray, node: np.ndarray) -> np.ndarray:
    return (np.int64(depth) << 56) | (context << 8) | node


def tree_levels(key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, children: np.ndarray | None, depth: int, least: int):
    """From the decisions at `depth` (keys context << 8 | node) up to `least`: arrays of key, zeros, ones and the weight of the own
    estimate; and last the keys one level up with their sums. children: ln of the product over longer contexts."""
    out = []
    while depth >= least:
        own = log_kt(zeros, ones)
        total = own if children is None else np.logaddexp(own, children) - math.log(2)
        weight = np.ones(len(own)) if children is None else np.exp(np.minimum(own - math.log(2) - total, 0.0))
        out.append((_key(depth, key >> 8, key & 255), zeros, ones, weight))
        depth -= 1
        up = ((key >> 8) & ((np.int64(1) << (8 * depth)) - 1)) << 8 | key & 255 if depth >= 0 else key[:0]
        key, zeros, ones, children = _sums(up, zeros, ones, total) if depth >= 0 else (key[:0], zeros[:0], ones[:0], total[:0])
    return out, (key, zeros, ones, children)


def _decisions(table: pa.Table):
    """Of all contexts with some nearest bytes: the levels of decisions at depths DEPTH to 3, and those at depth 2 as summed so far."""
    code, k = table.column("code").to_numpy(), table.column("k").to_numpy().astype(float)
    byte = code & 255
    key, zeros, ones = _sums(((code >> 8)[:, None] << 8 | _NODE[byte]).ravel(), np.where(_BIT[byte], 0, k[:, None]).ravel(), np.where(_BIT[byte], k[:, None], 0).ravel())
    return tree_levels(key, zeros, ones, None, DEPTH, 3)


def _near(table: pa.Table) -> pa.Table:
    """The decisions at depth 2 of some nearest bytes, to be summed over all buckets."""
    _, (key, zeros, ones, children) = _decisions(table)
    return pa.table({"key": key, "zeros": zeros, "ones": ones, "children": children})


def _weighted(batches):
    """Decisions of one depth, summed over their children: the weight of the own estimate and ln of the mixture."""
    for batch in batches:
        key, zeros, ones, children = (batch.column(k).to_numpy() for k in range(4))
        own = log_kt(zeros, ones)
        total = np.logaddexp(own, children) - math.log(2)
        weight = np.exp(np.minimum(own - math.log(2) - total, 0.0))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key, zeros, ones, weight, total)], names=["key", "zeros", "ones", "weight", "total"])


class Tree:
    """Trained weights: sorted keys, probability of a one and weight of the own estimate."""

    def __init__(self, levels: list[tuple[np.ndarray, ...]]):
        key, zeros, ones, weight = (np.concatenate(x) for x in zip(*levels, strict=True)) if levels else (np.empty(0, np.int64),) + (np.empty(0),) * 3
        order = np.argsort(key)
        self.key, self.one, self.weight = key[order], ((ones + 0.5) / (zeros + ones + 1))[order], weight[order]

    def log_probability(self, code: np.ndarray) -> np.ndarray:
        """log10 of each code's byte after its context. What training has never seen there has one half."""
        total, byte, context = np.zeros(len(code)), code & 255, code >> 8
        for k in range(8):
            node, bit = _NODE[byte, k], _BIT[byte, k]
            mixed = np.full(len(code), 0.5)
            for depth in range(DEPTH, -1, -1):
                key = _key(depth, context & ((np.int64(1) << (8 * depth)) - 1), node)
                at = np.minimum(np.searchsorted(self.key, key), max(len(self.key) - 1, 0))
                here = self.key[at] == key if len(self.key) else np.zeros(len(code), bool)
                if here.any():
                    one, weight = self.one[at], self.weight[at]
                    mixed = np.where(here, weight * np.where(bit, one, 1 - one) + (1 - weight) * mixed, mixed)
            total += np.log10(mixed)
        return total


class Known:
    """log10 probabilities of the most frequent codes."""

    def __init__(self, code: np.ndarray, value: np.ndarray):
        order = np.argsort(code)
        self.code, self.value = code[order], value[order]
        self._slots = None

    def __getstate__(self):
        return {**self.__dict__, "_slots": None}

    def score(self, codes: np.ndarray) -> np.ndarray:
        """Each code's value, or NaN where the code is not held; a table of recent codes is in front."""
        if self._slots is None:
            self._slots = np.full(1 << 20, -1, np.int64), np.zeros(1 << 20)
        held, value = self._slots
        slot = ((codes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)
        out, miss = value[slot], np.flatnonzero(held[slot] != codes)
        if len(miss):
            fresh, back = np.unique(codes[miss], return_inverse=True)
            scored = np.full(len(fresh), np.nan)
            if len(self.code):
                at = np.minimum(np.searchsorted(self.code, fresh), len(self.code) - 1)
                scored = np.where(self.code[at] == fresh, self.value[at], np.nan)
            out[miss] = scored[back]
            place = ((fresh.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)
            held[place] = fresh
            value[place] = scored  # of codes in one slot the same one comes last in both
        return out


class Model:
    """The context tree of summed (code, k) as tables.

    Codes with one pair of nearest bytes share a bucket, and with it all decisions of depths 3 and more; in large tables a pair
    is split by the third byte, whose contexts share nothing at these depths. Decisions at depth 2 are summed over all buckets
    and weighted row by row; those of depths 1 and 0, of at most 257 contexts, on the driver. All counts go into the weights.
    """

    def __init__(self, counts: DataFrame):
        self.counts = counts
        n = counts.count()
        self.buckets, self.split = max(1, -(-n // BUCKET_CODES)), min(256, max(1, -(-n // SPLIT_CODES)))
        grown = self._bucketed(counts).groupBy("b").applyInArrow(_near, "key long, zeros double, ones double, children double")
        summed = grown.groupBy("key").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("children").alias("children"))
        self.second = durable(summed.mapInArrow(_weighted, "key long, zeros double, ones double, weight double, total double"), "second")
        up = (F.shiftright("key", 8).bitwiseAND(0xFF) * 256 + F.col("key").bitwiseAND(0xFF)).alias("key")
        first = self.second.groupBy(up).agg(F.sum("zeros"), F.sum("ones"), F.sum("total")).collect()
        levels = []
        if first:
            key, zeros, ones, children = (np.array(x, t) for x, t in zip(zip(*first, strict=True), (np.int64, float, float, float), strict=True))
            order = np.argsort(key)
            levels = tree_levels(key[order], zeros[order], ones[order], children[order], 1, 0)[0]
        self.near = counts.sparkSession.sparkContext.broadcast(levels)

    def _pair(self, key) -> Column:
        return F.pmod(F.xxhash64(F.shiftright(key, 8).bitwiseAND(0xFFFF)), F.lit(self.buckets)) * self.split

    def _bucketed(self, codes: DataFrame) -> DataFrame:
        return codes.withColumn("b", self._pair("code") + F.pmod(F.shiftright("code", 24).bitwiseAND(0xFF), F.lit(self.split)))

    def probabilities(self, codes: DataFrame) -> DataFrame:
        """(code, p): log10 probability of each distinct code, seen in training or not, under the whole tree."""
        near = self.near

        def judge(wanted: pa.Table, table: pa.Table) -> pa.Table:
            code = wanted.column("code").to_numpy()
            if not len(code):
                return pa.table({"code": code, "p": np.empty(0)})
            pairs = table.filter(table.column("weight").is_valid())
            second = [(_key(2, key >> 8, key & 255), *(pairs.column(c).to_numpy() for c in ("zeros", "ones", "weight"))) for key in [pairs.column("code").to_numpy()]]
            deep = _decisions(table.filter(table.column("weight").is_null()))[0]
            return pa.table({"code": code, "p": Tree(near.value + second + deep).log_probability(code)})

        none = F.lit(None).cast("double")
        rows = self._bucketed(self.counts).select("b", "code", "k", none.alias("zeros"), none.alias("ones"), none.alias("weight"))
        parts = F.explode(F.sequence(F.lit(0), F.lit(self.split - 1)))  # each part of a pair reads the pair's decisions
        pairs = self.second.select(self._pair("key").alias("b"), F.col("key").alias("code"), F.lit(0).cast("long").alias("k"), "zeros", "ones", "weight", parts.alias("part"))
        table = rows.unionByName(pairs.withColumn("b", F.col("b") + F.col("part")).drop("part"))
        return self._bucketed(codes.select("code")).groupBy("b").cogroup(table.groupBy("b")).applyInArrow(judge, "code long, p double")


def score_documents(docs: DataFrame, folds: int = 10, held: int = 0) -> DataFrame:
    """Scores of all whole texts under models learned from the documents outside fold `held` of crc32(doc_id).

    Texts are lower-cased (A-Z). score: log10 probability of the text's bytes and an end byte under the context tree.
    base_score: the token unigram model with add-0.1 smoothing. Null text is empty: one end. A null doc_id is in fold 0.
    Repeated rows are scored each for itself. If nothing is left to learn from, every bit costs one bit and base_score is 0.
    Other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text", (fold(F.col("doc_id"), folds) == held).alias("held_out"))
    counts = durable(_counts(docs.where("not held_out")).groupBy("word", "code").agg(F.sum("k").alias("k")), "counts")
    words = counts.where("word is not null").select("word", "k")
    zero = F.lit(0)
    n, v, ends = words.agg(F.coalesce(F.sum("k"), zero), F.count("*"), F.coalesce(F.sum(F.when(F.length("word") == 0, F.col("k"))), zero)).first()
    codes = counts.where("code is not null").select("code", "k")
    model = Model(codes)
    often = model.probabilities(codes.orderBy(F.desc("k"), "code").limit(NODES)).toArrow()
    tree = spark.sparkContext.broadcast(Known(*(often.column(k).to_numpy() for k in range(2))))
    cost = lambda c: math.log10((c + 0.1) / (n + 0.1 * (v + 1)))
    frequent = words.orderBy(F.desc("k"), "word").limit(HEAD).toArrow()
    table = dict(zip(frequent.column("word").to_pylist(), map(cost, frequent.column("k").to_pylist()), strict=True))
    end, end_known = cost(ends), int(ends > 0)
    head = spark.sparkContext.broadcast(table)

    def judge(batches):
        known, held = head.value, tree.value
        for number, batch in enumerate(batches):
            ids, texts = batch.column(0), [lowered(t) for t in batch.column(1).to_pylist()]
            row, score, size, hits, base, tail = [], [], [], [], [], ([], [], [])
            far, done = [(np.empty(0, np.int64),) * 3], 0
            for part in _parts(texts):
                codes, starts = codes_of(part)
                found = held.score(codes)
                left = np.flatnonzero(np.isnan(found))
                found[left] = 0.0
                score.append(np.add.reduceat(found, starts))
                owner, code = np.searchsorted(starts, left, side="right") - 1 + done, codes[left]
                order = np.lexsort((code, owner))
                owner, code = owner[order], code[order]
                heads = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (code[1:] != code[:-1])]) if len(code) else left
                far.append((owner[heads], code[heads], np.diff(np.r_[heads, len(code)])))
                done += len(part)
            for k, t in enumerate(texts):
                tokens = t.split()
                costs = list(map(known.get, tokens))
                missing = costs.count(None)
                name = f"{number}.{k}"
                if missing:
                    rare = Counter(w for w, c in zip(tokens, costs, strict=True) if c is None)
                    tail[0].extend([name] * len(rare)), tail[1].extend(rare), tail[2].extend(rare.values())
                row.append(name), size.append(len(tokens) + 1), hits.append(len(tokens) - missing + end_known)
                base.append(math.fsum(c for c in costs if c is not None) + end)
            n_rows, n_tail = len(row), len(tail[0])
            names = ["row", "doc_id", "held_out", "n_tokens", "hits", "base", "score", "word", "code", "k"]
            empty = lambda n: [pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_()), *[pa.nulls(n, pa.int64())] * 2, *[pa.nulls(n, pa.float64())] * 2]
            yield pa.RecordBatch.from_arrays([pa.array(row, pa.string()), ids, batch.column(2), pa.array(size, pa.int64()), pa.array(hits, pa.int64()), pa.array(base, pa.float64()), pa.array(np.concatenate(score) if score else np.empty(0)), pa.nulls(n_rows, pa.binary()), *[pa.nulls(n_rows, pa.int64())] * 2], names=names)
            yield pa.RecordBatch.from_arrays([pa.array(tail[0], pa.string()), *empty(n_tail), pa.array(tail[1], pa.binary()), pa.nulls(n_tail, pa.int64()), pa.array(tail[2], pa.int64())], names=names)
            owner, code, k = (np.concatenate(x) for x in zip(*far, strict=True))
            for at in range(0, len(code), 1 << 18):
                some = slice(at, at + (1 << 18))
                n_far = len(code[some])
                yield pa.RecordBatch.from_arrays([pa.array(row, pa.string()).take(pa.array(owner[some])), *empty(n_far), pa.nulls(n_far, pa.binary()), pa.array(code[some]), pa.array(k[some])], names=names)

    schema = "row string, doc_id long, held_out boolean, n_tokens long, hits long, base double, score double, word binary, code long, k long"
    scored = durable(docs.select("doc_id", "text", "held_out").mapInArrow(judge, schema).withColumn("task", F.spark_partition_id()), "scored")
    for sent in (tree, head):
        sent.destroy()  # all rows are written; the driver needn't keep the model
    c = F.coalesce("c", F.lit(0))
    rare = scored.where("word is not null").select("task", "row", "word", "k").join(words.withColumnRenamed("k", "c"), "word", "left")
    rare = rare.groupBy("task", "row").agg(F.sum(F.col("k") * F.log10((c + 0.1) / F.lit(n + 0.1 * (v + 1)))).alias("more"), F.sum(F.when(c > 0, F.col("k")).otherwise(0)).alias("also"))
    tail = scored.where("code is not null").select("task", "row", "code", "k")
    far = tail.join(model.probabilities(tail.select("code").distinct()), "code").groupBy("task", "row").agg(F.sum(F.col("k") * F.col("p")).alias("rest"))
    whole = scored.where("word is null and code is null").join(rare, ["task", "row"], "left").join(far, ["task", "row"], "left")
    return whole.select("doc_id", "held_out", "n_tokens", (F.col("hits") + F.coalesce("also", zero)).alias("n_known"), F.lit(int(n)).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), (F.col("score") + F.coalesce("rest", F.lit(0.0))).alias("score"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
