"""Language identification by a small convolutional network over bytes, trained and applied in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sakuin.llm.shared import fold

WINDOW = 256  # bytes
WIDTHS = (2, 4, 6)
FILTERS = 16
EMBED = 6
PER_LANGUAGE = 1500  # training texts of each language, at most (expected number)
LANGUAGES = 200  # languages learned, most frequent first
UNDETERMINED = "und"

#: Bytes as the network sees them: A-Z lower-cased, decimal digits as one.
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[65:91] += 32
_FOLDED[48:58] = 48


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts cut into windows of WINDOW bytes, the last filled up with zeros; and each window's text number."""
    counts = np.array([-(-len(t) // WINDOW) for t in texts], np.int64)
    cells = np.frombuffer(b"".join(t.ljust(int(n) * WINDOW, b"\0") for t, n in zip(texts, counts, strict=True)), np.uint8)
    return _FOLDED[cells].reshape(-1, WINDOW), np.repeat(np.arange(len(texts)), counts)


class ByteCnn:
    """Embedding, filters of several widths with max pooling over the window, one softmax layer."""

    def __init__(self, classes: list[str], seed: int = 7):
        r = np.random.default_rng(seed)
        self.classes = classes
        self.p = {"embed": r.normal(0, 0.5, (256, EMBED)), "out": r.normal(0, 0.1, (FILTERS * len(WIDTHS), len(classes))), "out_bias": np.zeros(len(classes))}
        for w in WIDTHS:
            self.p[f"conv{w}"] = r.normal(0, 1 / np.sqrt(w * EMBED), (w * EMBED, FILTERS))
            self.p[f"bias{w}"] = np.zeros(FILTERS)
        self.least = 0.0  # a score below it fits no language; train sets it
        self._tables = None

    def __getstate__(self):
        return {"classes": self.classes, "p": self.p, "least": self.least, "_tables": None}

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 5, batch: int = 64, rate: float = 4e-3, seed: int = 7) -> ByteCnn:
        """Adam on the cross-entropy, every class with the same total weight."""
        r, p = np.random.default_rng(seed), self.p
        weight = 1 / np.maximum(np.bincount(y, minlength=len(self.classes)), 1)
        weight *= len(y) / max(weight[y].sum(), 1e-9)
        first, second, step = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
        for _ in range(epochs):
            order = r.permutation(len(y))
            for at in range(0, len(y), batch):
                some = order[at : at + batch]
                grads = self._gradients(x[some], y[some], weight[y[some]])
                step += 1
                for k, g in grads.items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        self._tables = None
        return self

    def _gradients(self, x, y, weight):
        p, n = self.p, len(y)
        seen, pooled, where = p["embed"][x].reshape(n, -1), [], []
        for w in WIDTHS:
            patches = np.lib.stride_tricks.sliding_window_view(seen, w * EMBED, axis=1)[:, ::EMBED]
            h = patches @ p[f"conv{w}"]
            at = h.argmax(1)
            where.append((patches, at))
            pooled.append(np.take_along_axis(h, at[:, None], 1)[:, 0] + p[f"bias{w}"])
        pre = np.concatenate(pooled, 1)
        hidden = np.maximum(pre, 0)
        logits = hidden @ p["out"] + p["out_bias"]
        prob = np.exp(logits - logits.max(1, keepdims=True))
        prob /= prob.sum(1, keepdims=True)
        prob[np.arange(n), y] -= 1
        delta = prob * (weight / n)[:, None]
        grads = {"out": hidden.T @ delta, "out_bias": delta.sum(0)}
        back = (delta @ p["out"].T) * (pre > 0)
        embed = np.zeros_like(p["embed"])
        for k, (w, (patches, at)) in enumerate(zip(WIDTHS, where, strict=True)):
            g = back[:, k * FILTERS : (k + 1) * FILTERS]
            best = patches[np.arange(n)[:, None], at]  # n, filters, w * embed
            grads[f"conv{w}"] = np.einsum("nfc,nf->cf", best, g)
            grads[f"bias{w}"] = g.sum(0)
            into = (g[:, :, None] * p[f"conv{w}"].T[None]).reshape(n, FILTERS, w, EMBED)
            symbols = x[np.arange(n)[:, None, None], at[:, :, None] + np.arange(w)]
            np.add.at(embed, symbols, into)
        return grads | {"embed": embed}

    def _lookup(self) -> list[list[np.ndarray]]:
        """For each width, what each pair of neighbouring bytes adds to the filters, by place in the filter."""
        if self._tables is None:
            e = self.p["embed"]
            self._tables = []
            for w in WIDTHS:
                taps = self.p[f"conv{w}"].reshape(w, EMBED, FILTERS)
                self._tables.append([((e @ taps[k])[:, None] + (e @ taps[k + 1])[None]).reshape(65536, FILTERS).astype(np.float32) for k in range(0, w, 2)])
        return self._tables

    def predict(self, x: np.ndarray, chunk: int = 128) -> np.ndarray:
        """Class probabilities of each window."""
        out = np.empty((len(x), len(self.classes)))
        for at in range(0, len(x), chunk):
            part = x[at : at + chunk].astype(np.intp)
            pairs, pooled = part[:, :-1] * 256 + part[:, 1:], []
            for w, tables in zip(WIDTHS, self._lookup(), strict=True):
                n = WINDOW - w + 1
                h = tables[0][pairs[:, :n]]
                for k, table in enumerate(tables[1:], 1):
                    h += table[pairs[:, 2 * k : 2 * k + n]]
                pooled.append(h.max(1) + self.p[f"bias{w}"])
            logits = np.maximum(np.concatenate(pooled, 1), 0) @ self.p["out"] + self.p["out_bias"]
            prob = np.exp(logits - logits.max(1, keepdims=True))
            out[at : at + chunk] = prob / prob.sum(1, keepdims=True)
        return out


def train(labelled: DataFrame, per_language: int = PER_LANGUAGE, languages: int = LANGUAGES) -> ByteCnn:
    """Learn from (text, lang). The sample is bounded: about `per_language` texts of each of at most `languages`
    languages, chosen by a hash of the text, and two windows of each text, at places that the hash gives too. Repeated texts
    count once. Every tenth window is held out: `least` lies a quarter of the way from chance to what nearly all of those that are
    judged right score at least. Without labelled text the network has no class."""
    labelled = labelled.where("lang is not null and text is not null")
    counts = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()
    if not counts:
        return ByteCnn([])
    size = 1 << 30
    share = F.create_map(*[F.lit(v) for r in counts for v in (r["lang"], int(size * min(1.0, per_language / r["count"])))])
    hashed, room = F.xxhash64("text"), F.greatest(F.length("text") - WINDOW, F.lit(0)) + 1
    taken = labelled.where(F.pmod(hashed, F.lit(size)) < share[F.col("lang")])
    rows = taken.select("lang", *[F.expr(f"substring(text, cast(pmod(shiftright(xxhash64(text), {k}), greatest(length(text) - {WINDOW}, 0) + 1) as int) + 1, {WINDOW})").alias(f"w{k}") for k in (7, 29)]).dropDuplicates().limit(2 * per_language * len(counts)).collect()
    names = sorted(r["lang"] for r in counts)
    number, r = {c: k for k, c in enumerate(names)}, np.random.default_rng(3)
    texts, y = [], []
    for row in sorted(rows):
        for w in (row["w7"], row["w29"]):
            if w:
                cut = w.encode()[:WINDOW]
                texts.append(cut[: int(r.integers(6, 128))] if r.random() < 0.3 else cut)
                y.append(number[row["lang"]])
    if not texts:
        return ByteCnn([])
    x, y = windows_of(texts)[0], np.array(y)
    out = np.arange(len(y)) % 10 == 9
    model = ByteCnn(names).fit(x[~out], y[~out])
    seen = model.predict(x[out])
    right = seen[seen.argmax(1) == y[out]].max(1)
    chance = 1 / len(names)
    model.least = float(chance + ((np.quantile(right, 0.01) if len(right) else chance) - chance) / 4)
    return model


def identify(docs: DataFrame, model: ByteCnn) -> DataFrame:
    """Add lang_pred and score to (doc_id, text, ...) from the text alone.

    Every window of a text is judged; the score is the mean probability of the best language over the windows,
    each counted by its bytes. Null text, text without a letter, or a model without classes: `und`, score 0. Repeated rows are
    judged each for itself, an empty table gives an empty result, and other columns pass through (lang_pred and score, in whatever case,
    are replaced).
    """
    docs = docs.select(*[c for c in docs.columns if c.lower() not in ("lang_pred", "score")])
    names = model.classes

    def judge(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            known = [k for k, t in enumerate(texts) if names and t and any(map(str.isalpha, t))]
            pred, score = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            for at in range(0, len(known), 512):
                some = known[at : at + 512]
                coded = [texts[k].encode() for k in some]
                x, owner = windows_of(coded)
                weight = (x != 0).sum(1).clip(1)
                total = np.zeros((len(some), len(names)))
                np.add.at(total, owner, model.predict(x) * weight[:, None])
                total /= total.sum(1, keepdims=True)
                for k, best, p in zip(some, total.argmax(1), total.max(1), strict=True):
                    pred[k], score[k] = names[best], min(1.0, float(p))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())], names=[*batch.schema.names, "lang_pred", "score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(judge, f"{fields}, lang_pred string, score double")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("held_out", fold(F.col("doc_id"), 4) == 2)
    model = train(docs.where("not held_out"))
    return identify(docs.select("doc_id", "held_out", "text"), model).drop("text")
