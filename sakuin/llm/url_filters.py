"""URL filters: longest host and path rule, else gradient-boosted trees on lexical features, as SQL conditionals."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SAMPLE = 4000  # labelled URLs learned from, at most (expected number)
SUFFIXES = 256  # host suffixes that have statistics, most frequent in the sample first
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"), Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))


def host_and_path(pages: DataFrame) -> DataFrame:
    """Add host and path; both are empty for a null url or one without `://`."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    pages = pages.withColumn("rest", F.coalesce(rest, F.lit("")))
    return pages.withColumns({"host": F.translate(F.regexp_extract("rest", "^[^/?#]*", 0), _UPPER, _LOWER), "path": F.regexp_extract("rest", "^[^/?#]*([^?#]*)", 1)}).drop("rest")


def longest_rule(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add rule and rule_verdict of the longest rule that fits host (or a subdomain) and path; of equally long ones the first."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(reversed(rules), key=lambda r: len(r.text)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        name, verdict = F.when(fits, F.lit(r.text)).otherwise(name), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return pages.withColumns({"rule": name, "rule_verdict": verdict})


FOLDS = 5
FEATURES = ("url_length", "host_length", "depth", "digit_share", "entropy", "parameters", "host_labels", "suffix_blocked", "suffix_seen")


def lexical(pages: DataFrame) -> DataFrame:
    """Add the lexical features and the host's last label; null urls count as empty."""
    pages = pages.withColumn("u", F.coalesce("url", F.lit("")))
    pages = pages.withColumn("url_length", F.length("u").cast("double"))
    share = "(length(u) - length(replace(u, c, ''))) / double(length(u))"
    return pages.withColumns({
        "host_length": F.length("host").cast("double"),
        "depth": F.size(F.expr("filter(split(path, '/'), s -> s != '')")).cast("double"),
        "digit_share": F.length(F.regexp_replace("u", "[^0-9]+", "")) / F.greatest(F.col("url_length"), F.lit(1.0)),
        "entropy": F.expr(f"aggregate(array_distinct(filter(split(u, ''), c -> c != '')), 0D, (a, c) -> a - {share} * log2({share}))"),
        "parameters": F.when(F.col("u").contains("?"), F.size(F.split(F.regexp_extract("u", "\\?([^#]*)", 1), "&"))).otherwise(0).cast("double"),
        "host_labels": F.size(F.split("host", "\\.")).cast("double"),
        "suffix": F.regexp_extract("host", "[^.]*$", 0),
    }).drop("u")


class BoostedTrees:
    """Logistic gradient boosting over shallow trees with quantile cuts."""

    def __init__(self, trees: int = 20, depth: int = 3, rate: float = 0.3, cuts: int = 24, least: int = 10):
        self.trees, self.depth, self.rate, self.cuts, self.least = trees, depth, rate, cuts, least
        self.base, self.grown = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        rate = (y.sum() + 1) / (len(y) + 2)
        self.base, self.grown = float(np.log(rate / (1 - rate))), []
        if 0 < y.sum() < len(y):
            score = np.full(len(y), self.base)
            for _ in range(self.trees):
                p = 1 / (1 + np.exp(-score))
                tree = self._grow(x, y - p, p * (1 - p), np.arange(len(y)), self.depth)
                self.grown.append(tree)
                score += self.values(tree, x)
        return self

    def _grow(self, x, g, h, rows, depth):
        total = (g[rows].sum(), h[rows].sum())
        best = (1e-6, None)
        for k in range(x.shape[1]) if depth else ():
            v = x[rows, k]
            for cut in np.unique(np.quantile(v, np.linspace(0, 1, self.cuts + 2)[1:-1])):
                left = v <= cut
                if self.least <= left.sum() <= len(rows) - self.least:
                    a, b = g[rows][left].sum(), h[rows][left].sum()
                    gain = a * a / (b + 1) + (total[0] - a) ** 2 / (total[1] - b + 1) - total[0] ** 2 / (total[1] + 1)
                    if gain > best[0]:
                        best = (gain, (k, float(cut), left))
        if best[1] is None:
            return float(self.rate * total[0] / (total[1] + 1))
        k, cut, left = best[1]
        return (k, cut, self._grow(x, g, h, rows[left], depth - 1), self._grow(x, g, h, rows[~left], depth - 1))

    def values(self, tree, x: np.ndarray) -> np.ndarray:
        if isinstance(tree, float):
            return np.full(len(x), tree)
        k, cut, low, high = tree
        return np.where(x[:, k] <= cut, self.values(low, x), self.values(high, x))

    def column(self, names: tuple[str, ...]) -> Column:
        def of(tree) -> Column:
            return F.lit(tree) if isinstance(tree, float) else F.when(F.col(names[tree[0]]) <= tree[1], of(tree[2])).otherwise(of(tree[3]))

        out = F.lit(self.base)
        for tree in self.grown:
            out = out + of(tree)
        return out


def suffix_statistics(blocked: float, n: float, prior: float) -> tuple[float, float]:
    """Smoothed share of blocked URLs among n, and how many there are to tell by."""
    return (blocked + 5 * prior) / (n + 5), float(np.log1p(n))


@dataclass
class UrlModel:
    trees: BoostedTrees
    suffixes: dict[str, tuple[float, float]]
    prior: float

    def with_suffix(self, pages: DataFrame) -> DataFrame:
        """Add the statistics of each host suffix; an unknown one has the prior share and was seen 0 times."""

        def of(k: int, unknown: float) -> Column:
            known = F.create_map(*[F.lit(x) for s, v in self.suffixes.items() for x in (s, v[k])])[F.col("suffix")] if self.suffixes else F.lit(None)
            return F.coalesce(known, F.lit(unknown))

        return pages.withColumns({"suffix_blocked": of(0, self.prior), "suffix_seen": of(1, 0.0)})

    def score(self) -> Column:
        """Log-odds of a block."""
        return self.trees.column(FEATURES)


def train(labelled: DataFrame, sample: int = SAMPLE, suffixes: int = SUFFIXES) -> UrlModel:
    """Learn from lexical rows with `blocked` (boolean). At most about `sample` URLs, chosen by a hash of the url, come to the
    driver.

    The statistics of a suffix in a training row come from the other folds of the sample, so a row's own label is in none of its
    features; and the rows of one fold count as of an unknown suffix, so that the trees learn to judge those by the rest.
    Without labels all is allowed.
    """
    share = min(1.0, sample / max(labelled.count(), 1))
    taken = labelled.where(F.pmod(F.xxhash64("url"), F.lit(1 << 30)) < int(share * (1 << 30)))
    plain = [f for f in FEATURES if not f.startswith("suffix_")]
    rows = sorted(taken.select("suffix", "blocked", F.crc32(F.col("url").cast("binary")).alias("fold"), *plain).dropDuplicates().limit(2 * sample).collect())
    y = np.array([r["blocked"] for r in rows], float)
    fold = np.array([r["fold"] for r in rows], np.int64) % FOLDS
    prior = float(y.sum() / max(len(y), 1))
    of: dict[str, np.ndarray] = {}
    for r, b, f in zip(rows, y, fold, strict=True):
        sums = of.setdefault(r["suffix"], np.zeros((FOLDS, 2)))
        sums[f] += b, 1
    often = dict(sorted(of.items(), key=lambda kv: (-kv[1][:, 1].sum(), kv[0]))[:suffixes])
    known = {s: suffix_statistics(*v.sum(0), prior) for s, v in often.items()}
    x = []
    for r, f in zip(rows, fold, strict=True):
        v = often.get(r["suffix"])
        own = (prior, 0.0) if f == 0 or v is None else suffix_statistics(*(v.sum(0) - v[f]), prior)
        x.append([r[c] for c in plain] + list(own))
    return UrlModel(BoostedTrees().fit(np.array(x, float).reshape(-1, len(FEATURES)), y), {s: tuple(map(float, v)) for s, v in known.items()}, prior)


def filter_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and block_score of every url. URLs that a rule fits are the labelled ones that the
    trees learn from; the trees judge the others (block at a log-odds above 0). Repeated rows are judged each for itself, and
    repeated URLs are learned from once. An empty table gives an empty result; other columns are ignored."""
    seen = lexical(longest_rule(host_and_path(pages.select("page_id", "url")), rules))
    model = train(seen.where("rule is not null").withColumn("blocked", F.col("rule_verdict") == "block"))
    scored = model.with_suffix(seen).withColumn("block_score", model.score())
    verdict = F.coalesce("rule_verdict", F.when(F.col("block_score") > 0, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "block_score")


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))
