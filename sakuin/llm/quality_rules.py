"""Quality rules: a decision list of threshold conjunctions learned from labelled text statistics, applied as SQL conditionals."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sakuin.llm.shared import SPACE

SAMPLE = 6000  # labelled documents learned from, at most (expected number)
WINDOW = 8
SYMBOLS = "#*$%&|<>"

#: What rules may test.
FEATURES = {
    "n_words": "double(n_words)",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "capital_share": "n_capitals / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "shout_share": "n_shouts / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
}


def text_statistics(docs: DataFrame) -> DataFrame:
    """Add the statistics to (doc_id, text), all in SQL functions over one row's arrays, without a shuffle.

    Null, empty or blank text has zero everywhere. Windows and words are compared by 64-bit hashes. Repeated rows, and rows of one
    doc_id or none, are counted each for itself; an empty table gives an empty result; other columns are left out, whatever their
    names, but for `text`, which stays.
    """
    count = lambda chars: f"cast(length(regexp_replace(text, '[^{chars}]+', '')) as long)"
    space = SPACE.replace("\\", "\\\\")
    at = ", ".join(f"h[i + {k}]" for k in range(WINDOW))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.selectExpr("doc_id", "text", f"filter(split(text, '{space}'), w -> w != '') words", "filter(split(text, '\\n'), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]') lines")
    rows = rows.selectExpr(
        "doc_id", "cast(size(words) as long) n_words", "cast(length(array_join(words, '')) as long) word_chars",
        f"{count('#*$%&|<>')} n_symbols", "cast(size(lines) as long) n_lines", "cast(size(lines) - size(array_distinct(lines)) as long) n_dup_lines",
        f"{count('A-Z')} n_capitals", f"{count('0-9')} n_digits", f"{count('!?')} n_shouts", "transform(words, w -> xxhash64(w)) h",
    )
    rows = rows.withColumn("windows", F.expr(f"case when n_words >= {WINDOW} then transform(sequence(0, cast(n_words as int) - {WINDOW}), i -> xxhash64({at})) else array() end"))
    twice = "(j > 0 and s[j - 1].x = e.x) or (j < size(s) - 1 and s[j + 1].x = e.x)"
    places = f"transform(array(sort_array(transform(windows, (x, i) -> struct(x as x, i as i)))), s -> sort_array(transform(filter(s, (e, j) -> {twice}), e -> e.i)))[0]"
    covered = f"aggregate({places}, named_struct('last', -{WINDOW}, 'n', 0L), (a, i) -> named_struct('last', i, 'n', a.n + least({WINDOW}, i - a.last)), a -> a.n)"
    return rows.withColumn("n_repeat_words", F.expr(f"case when size(array_distinct(windows)) < size(windows) then {covered} else 0L end")).drop("h", "windows")


Rule = list[tuple[str, str, float]]


class RuleLearner:
    """Sequential covering: each rule grows on two thirds of what is left by the best gain of a further threshold, is pruned
    on the other third from its end, and is kept if it is precise enough there; then what it covers is taken out."""

    def __init__(self, rules: int = 8, conditions: int = 3, cuts: int = 32, precision: float = 0.9, least: int = 4):
        self.rules, self.conditions, self.cuts, self.precision, self.least = rules, conditions, cuts, precision, least

    def _grow(self, x: np.ndarray, bad: np.ndarray, names: list[str]) -> Rule:
        rule, inside = [], np.ones(len(x), bool)
        while len(rule) < self.conditions and bad[inside].sum() < inside.sum():
            p0, n0 = bad[inside].sum(), inside.sum()
            best = (1e-9, None, None)
            for k, name in enumerate(names):
                values = np.unique(x[inside, k])
                cuts = np.unique(np.quantile(values, np.linspace(0, 1, self.cuts + 2)[1:-1])) if len(values) > self.cuts else (values[1:] + values[:-1]) / 2
                for cut in cuts:
                    for op, hit in (("<=", x[:, k] <= cut), (">", x[:, k] > cut)):
                        hit = hit & inside
                        p, n = bad[hit].sum(), hit.sum()
                        if p >= self.least:
                            gain = p * (np.log2(p / n) - np.log2(p0 / n0))
                            if gain > best[0]:
                                best = (gain, (name, op, float(cut)), hit)
            if best[1] is None:
                break
            rule.append(best[1])
            inside = best[2]
        return rule

    @staticmethod
    def covers(rule: Rule, x: np.ndarray, names: list[str]) -> np.ndarray:
        hit = np.ones(len(x), bool)
        for name, op, cut in rule:
            v = x[:, names.index(name)]
            hit &= v <= cut if op == "<=" else v > cut
        return hit

    def fit(self, x: np.ndarray, bad: np.ndarray, names: list[str], seed: int = 5) -> list[Rule]:
        found: list[Rule] = []
        r = np.random.default_rng(seed)
        while len(found) < self.rules and bad.sum() >= 2 * self.least:
            part = r.permutation(len(x)) % 3
            grow, prune = part > 0, part == 0
            rule = self._grow(x[grow], bad[grow], names)
            worth = []
            for n in range(len(rule), 0, -1):
                hit = self.covers(rule[:n], x[prune], names)
                p, all_ = bad[prune][hit].sum(), hit.sum()
                worth.append(((2 * p - all_) / max(all_, 1), p / max(all_, 1), n))
            if not worth:
                break
            _, precision, n = max(worth, key=lambda w: (w[0], -w[2]))
            hit = self.covers(rule[:n], x, names)
            if precision < self.precision or bad[hit].mean() < self.precision:
                break
            found.append(rule[:n])
            x, bad = x[~hit], bad[~hit]
        return found


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[Rule]:
    """Rules for low quality from (doc_id, text) and (doc_id, quality). At most about `sample` labelled documents, chosen by a
    hash of doc_id, are learned from; they alone come to the driver, as statistics. Of several labels of one doc_id the lowest
    counts, for every row with that doc_id; null labels and labels without doc_id are left out. Without labels, or without documents
    that have any, there is no rule. Other columns of either table are ignored."""
    labels = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    share = min(1.0, sample / max(labels.count(), 1))
    taken = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    names = list(FEATURES)
    with_text = docs.select("doc_id", "text").join(F.broadcast(taken.limit(2 * sample)), "doc_id")  # bounded by the sample
    stats = text_statistics(with_text).join(F.broadcast(taken.limit(2 * sample)), "doc_id")
    rows = sorted(stats.selectExpr("quality", *[f"{v} as {k}" for k, v in FEATURES.items()]).limit(4 * sample).collect())
    x = np.array([[r[k] for k in names] for r in rows], float).reshape(-1, len(names))
    return RuleLearner().fit(x, np.array([r["quality"] == 0 for r in rows], bool), names)


def condition(rule: Rule) -> Column:
    out = F.lit(True)
    for name, op, cut in rule:
        value = F.expr(FEATURES[name])
        out = out & (value <= F.lit(cut) if op == "<=" else value > F.lit(cut))
    return out


def judge(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add base_failed, the number of the first rule that fires (null: none) and kept. Rows are judged each for itself, from their
    statistics alone: those of null and empty texts fail the base, repeated rows are judged alike, and an empty table stays empty."""
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    fired = F.lit(None).cast("int")
    for k, rule in reversed(list(enumerate(rules))):
        fired = F.when(condition(rule), F.lit(k)).otherwise(fired)
    return stats.withColumns({"base_failed": failed, "rule": fired}).withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    judged = judge(text_statistics(docs), learn(docs, labels))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
