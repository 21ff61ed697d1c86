"""Each operator against brute force on small tables with nulls, ties, repeats, empty and long texts and clashing columns."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sakuin.llm import context_tree, decontamination, jaccard_join, language_id, packing, quality_rules, suffix_dedup, token_rollup, tokens, url_filters, warc
from sakuin.llm.shared import fold

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component_id long, pos string, key int"


def docs_of(spark, texts, langs=None):
    """Rows of (doc_id, text) with columns that clash with the operators' own."""
    rows = [(i, t, (langs or {}).get(i), "s", 0, 7, "p", 1) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def corpus(seed=1, n=60):
    """Random texts with near copies, exact copies, shared passages and odd rows."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choices("abcdeé", k=r.randint(1, 6))) for _ in range(300)]
    passage = " ".join(r.choices(vocabulary, k=18))
    texts = []
    for k in range(n):
        words = r.choices(vocabulary, k=r.choice([1, 3, 5, 8, 40, 120]))
        if k % 7 == 3 and texts:
            words = r.choice(texts)[1].split(" ")
            for _ in range(len(words) // 25):
                words[r.randrange(len(words))] = r.choice(vocabulary)
        if k % 9 == 4 and texts:
            words = r.choice(texts)[1].split(" ")
        if k % 5 == 0:
            words[len(words) // 2 : len(words) // 2] = [passage]
        texts.append((k * 3, " ".join(words)))
    texts += [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "A b C"), (1004, "a B c"), (1005, "x" * 3000), (1006, "x" * 2999), (1007, "é" * 60), (6, texts[2][1]), (9, "another text under one id")]
    r.shuffle(texts)
    return texts


def words_of(t):
    return re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())


def test_crc_fold(spark):
    df = spark.createDataFrame([(i,) for i in [*range(50), None]], "d long").select("d", fold(F.col("d"), 4).alias("f"))
    assert all(r["f"] == (zlib.crc32(str(r["d"]).encode()) % 4 if r["d"] is not None else 0) for r in df.collect())


def test_token_ids_are_those_of_the_tokenizers_library():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokens.tokenizer_path("byte_bpe_50k.json"))
    r, encode = random.Random(2), tokens.encoder()
    texts = ["", " ", "a  b", "\n\n a\t", "it's 'll", "<|endoftext|>", "a <|endoftext|> b", "x\n<|endoftext|><|endoftext|>  <|endoftext", " <|endoftext|>\n\n y", "é　ü 1234 !!", "x" * 5000, *["".join(r.choices("ab 'é\n\t1.　s\x85😀$", k=r.randint(0, 60))) for _ in range(500)]]
    texts += ["".join(r.choices(["<|endoftext|>", "a", " ", "\n", "'s", "1"], k=12)) for _ in range(200)]
    assert encode.ids("a <|endoftext|> b") == [64, 220, 50256, 275]
    assert all(np.frombuffer(encode(t), "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids for t in texts)


def check_packing(got, texts, capacity):
    encode = tokens.encoder()
    expected = Counter()
    for i, t in texts:
        ids = encode(t) + np.array([2], "<u4").tobytes()
        n, start, piece = len(ids) // 4, 0, 0
        length = n % capacity or capacity
        while start < n:
            expected[(i, piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]))] += 1
            start, piece, length = start + length, piece + 1, capacity
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == expected
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by)


def test_packing(spark):
    texts = [*corpus(), (None, "no id"), (2**60 + 1, "big id")]
    got = packing.pack_documents(docs_of(spark, texts), capacity=64, group=20).collect()
    used = check_packing(got, texts, 64)
    least = -(-sum(r["length"] for r in got) // 64)
    assert used <= 1.25 * least + 4
    assert packing.pack_documents(docs_of(spark, texts).limit(0)).count() == 0


def best_fit(sizes, capacity):
    """Number of bins of best fit, largest first."""
    gaps, bins = Counter(), 0
    for s in sorted(sizes.tolist(), reverse=True):
        gap = min((g for g, n in gaps.items() if n and g >= s), default=None)
        if gap is None:
            gap, bins = capacity, bins + 1
        else:
            gaps[gap] -= 1
        gaps[gap - s] += 1
    return bins


@pytest.mark.parametrize("eager", [False, True])
def test_sum_of_squares_is_the_rule(eager):
    r = np.random.default_rng(1)
    sizes = r.integers(1, 13, 200)
    placed = packing.sum_of_squares(sizes, 12, eager)
    load: dict[int, int] = {}
    for s, b in zip(sizes.tolist(), placed.tolist(), strict=True):
        def worth(at, s=s):
            n = Counter(12 - v for v in ({**load, at: load.get(at, 0) + s}).values() if 0 < 12 - v < 12)
            return sum(v * v for v in n.values())

        open_ = [worth(k) for k, v in load.items() if v + s <= 12]
        assert worth(b if b in load else -1) == min(open_ + [worth(-1)] * (eager or not open_))
        load[b] = load.get(b, 0) + s
        assert load[b] <= 12
    assert packing.pack(np.array([5, 5, 2, 12, 7]), 12).max() == 2


def test_packing_is_not_behind_best_fit():
    for seed in range(30):
        r = np.random.default_rng(seed)
        n = int(r.integers(1, 1200))
        sizes = (r.integers(1, 1024, n), r.integers(200, 700, n), np.clip(r.exponential(300, n).astype(int), 1, 1023), r.integers(330, 350, n), np.clip(r.normal(450, 200, n).astype(int), 1, 1023))[seed % 5]
        place = packing.pack(sizes, 1024)
        load = np.bincount(place, weights=sizes)
        assert load.max() <= 1024 and load.min() > 0
        assert len(load) <= best_fit(sizes, 1024), seed


def test_language(spark):
    r = random.Random(3)
    make = {"aa": "lorem ipsum dolor amet sit".split(), "bb": "schnee über strasse und haus".split(), "cc": "été français élève être où".split()}
    texts, langs = [], {}
    for k in range(240):
        lang = r.choice(sorted(make))
        texts.append((k, " ".join(r.choices(make[lang], k=r.randint(3, 90)))))
        langs[k] = lang
    odd = [(900, None), (901, ""), (902, "123 !!"), (903, " ".join(make["bb"] * 3000)), (904, "LOREM IPSUM DOLOR"), (905, texts[0][1])]
    docs = docs_of(spark, texts + odd, langs)
    model = language_id.train(docs.where(fold(F.col("doc_id"), 4) != 2))
    got = {x["doc_id"]: (x["lang_pred"], x["score"]) for x in language_id.identify(docs, model).collect()}
    held = [k for k, _ in texts if zlib.crc32(str(k).encode()) % 4 == 2]
    assert len(got) == 246 and np.mean([got[k][0] == langs[k] for k in held]) > 0.95
    assert [got[k][0] for k in (900, 901, 902, 903, 904)] == ["und", "und", "und", "bb", "aa"]
    assert all(0 <= s <= 1 for _, s in got.values())
    assert 1 / 3 < model.least < 0.9 and sum(got[k][1] >= model.least for k in held) > 0.97 * len(held)
    none = language_id.train(docs.where("false"))
    assert {x["lang_pred"] for x in language_id.identify(docs, none).collect()} == {"und"}


def test_network_gradient():
    """Analytic gradients equal numeric ones."""
    model = language_id.ByteCnn(["a", "b"])
    x, y, w = np.random.default_rng(1).integers(0, 256, (4, 256)).astype(np.uint8), np.array([0, 1, 1, 0]), np.ones(4)

    def loss():
        p = model.predict(x)
        model._tables = None
        return -np.mean(np.log(p[np.arange(4), y]))

    grads = model._gradients(x, y, w)
    for name in ("out", "conv4", "embed"):
        at = np.unravel_index(np.abs(grads[name]).argmax(), grads[name].shape)
        model.p[name][at] += 1e-3
        up = loss()
        model.p[name][at] -= 2e-3
        down = loss()
        model.p[name][at] += 1e-3
        assert grads[name][at] == pytest.approx((up - down) / 2e-3, rel=0.05, abs=1e-5)


def test_quality_statistics(spark):
    texts = [*corpus(4), (5000, "a b\na b\n\n \nA #* |\na b"), (5001, "w x " * 30), (5002, "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8")]
    got = defaultdict(list)
    for r in quality_rules.text_statistics(docs_of(spark, texts)).collect():
        got[r["doc_id"]].append((r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]))
    expected = defaultdict(list)
    for i, t in texts:
        w = [x.decode() for x in words_of(t)]
        seen = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        cover = {k + d for k in range(len(w) - 7) if seen[tuple(w[k : k + 8])] > 1 for d in range(8)}
        lines = [x for x in (t or "").split("\n") if words_of(x)]
        expected[i].append((len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(cover)))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in expected.items()}


def test_quality_of_nothing(spark):
    none = docs_of(spark, []).withColumns({"n_words": F.lit(1), "kept": F.lit("x"), "rule": F.lit(0)})  # names that clash
    labels = spark.createDataFrame([(1, 0), (1, 1), (None, 1), (2, None)], "doc_id long, quality int")
    assert quality_rules.learn(none, labels) == [] and quality_rules.learn(docs_of(spark, [(1, "a b")]), labels.limit(0)) == []
    judged = quality_rules.judge(quality_rules.text_statistics(none), [])
    assert judged.count() == 0 and {"base_failed", "kept", "rule"} <= set(judged.columns)
    rows = docs_of(spark, [(1, None), (1, None), (None, "a b " * 20)]).withColumns({"n_words": F.lit(1), "kept": F.lit("x")})
    got = quality_rules.judge(quality_rules.text_statistics(rows), []).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"], r["base_failed"], r["kept"]) for r in got) == [(0, 40, True, False), (1, 0, True, False), (1, 0, True, False)]


def test_rules_learned_and_applied_alike(spark):
    r = np.random.default_rng(2)
    x = r.random((600, len(quality_rules.FEATURES)))
    names = list(quality_rules.FEATURES)
    bad = (x[:, 2] > 0.7) & (x[:, 5] <= 0.5) | (x[:, 7] > 0.9)
    rules = quality_rules.RuleLearner().fit(x, bad, names)
    assert 1 <= len(rules) <= 8
    hit = np.zeros(600, bool)
    for rule in rules:
        hit |= quality_rules.RuleLearner.covers(rule, x, names)
    assert (hit == bad).mean() > 0.95
    docs = docs_of(spark, [(k, "good text with words " * 9 + str(k)) for k in range(80)] + [(100 + k, "#$ %& ** bad| " * 30 + str(k)) for k in range(80)])
    labels = spark.createDataFrame([(k, 1) for k in range(80)] + [(100 + k, 0) for k in range(80)] + [(None, 0), (7, None), (99999, 0)], "doc_id long, quality int")
    found = quality_rules.learn(docs, labels)
    stats = quality_rules.text_statistics(docs)
    fired = {r["doc_id"]: r["rule"] for r in quality_rules.judge(stats, found).collect()}
    assert found and all((fired[k] is None) == (k < 80) for k in fired)
    assert quality_rules.learn(docs, labels.limit(0)) == []
    assert {r["kept"] for r in quality_rules.judge(stats.where("n_words >= 20 and n_repeat_words = 0"), []).collect()} <= {True}


def sets_of(texts):
    out = {}
    for i, t in texts:
        w = [x.lower() for x in words_of(t)]
        s = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
        out.setdefault(i, []).append(s)
    return out


def families(seed):
    """Leaders of 60 words with members that differ in a few, and families that differ from each other about as much as links allow."""
    r = random.Random(seed)
    word = lambda: "w" + str(r.randrange(10**6))
    out, first = [], [word() for _ in range(60)]
    for f in range(6):
        own = list(first)
        for _ in range(r.choice([1, 2, 3])):
            own[r.randrange(60)] = word()
        for _ in range(6):
            member = list(own)
            for _ in range(r.choice([0, 1, 1, 2])):
                member[r.randrange(60)] = word()
            out.append((5000 + len(out), " ".join(member[r.randrange(3) :] + [word() for _ in range(r.choice([0, 0, 3, 9]))])))
        if f % 2:
            first = own
    return out


@pytest.mark.parametrize(("seed", "long", "block"), [(5, 4096, 4096), (6, 2, 4096), (7, 2, 3), (8, 2, 1)])
def test_jaccard_components(spark, monkeypatch, seed, long, block):
    monkeypatch.setattr(jaccard_join, "LONG", long)
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    texts = corpus(seed, 50) + families(seed) + [(2000 + k, " ".join(f"g{j}" for j in range(40)) + f" tail{k // 2} end{k}") for k in range(12)] + [(None, "no id at all here")]
    got = jaccard_join.similar_groups(docs_of(spark, texts), frequent=64 if seed < 7 else 3).collect()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("sakuin_")]
    sets = sets_of(texts)
    parent = {i: i for i in sets if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, a), (j, b) in itertools.combinations([(i, s) for i, ss in sets.items() if i is not None for s in ss if s], 2):
        if 100 * len(a & b) >= 75 * len(a | b):
            x, y = root(i), root(j)
            parent[max(x, y)] = min(x, y)
    assert Counter((r["doc_id"], r["n_shingles"]) for r in got) == Counter((i, len(s)) for i, ss in sets.items() for s in ss)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None
        elif r["n_shingles"]:
            assert r["component_id"] == root(r["doc_id"]), r
        else:
            assert r["component_id"] == r["doc_id"]


@pytest.mark.parametrize(("seed", "long"), [(1, 4096), (2, 4096), (3, 2), (4, 2)])
def test_links_of_an_id_with_two_texts(spark, monkeypatch, seed, long):
    """u - a - t is a chain whose ends don't link; t has a second text under its id."""
    monkeypatch.setattr(jaccard_join, "LONG", long)
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(10**6)}"
    texts = []
    for f in range(6):
        base, left, right = ([word() for _ in range(n)] for n in (40, 10, 10))
        chain = [left + base, left[5:] + base + right[:5], base + right]
        texts += [(10 * f + k + 1, " ".join(x)) for k, x in enumerate(chain)]
        texts.append((10 * f + (3, 3, 3, 3, 1, 2)[f], " ".join(word() for _ in range(30 + f))))
    sets = sets_of(texts)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, x), (j, y) in itertools.combinations([(i, s) for i, ss in sets.items() for s in ss], 2):
        if 100 * len(x & y) >= 75 * len(x | y):
            parent[max(root(i), root(j))] = min(root(i), root(j))
    expected = {i: root(i) for i in sets}
    assert {expected[10 * f + k] for f in range(6) for k in (1, 2, 3)} == {10 * f + 1 for f in range(6)}
    got = jaccard_join.similar_groups(docs_of(spark, texts)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == expected


def test_groups_of_a_list_meet_in_cells():
    """Pairs of a list are those of its cells together, each found once but for pairs within a group."""
    r = np.random.default_rng(4)
    k = 200
    tok, id_, comp, n = np.zeros(k, np.int64), np.arange(k), r.integers(0, 150, k), r.integers(40, 53, k)
    q, m, home = r.integers(0, 6, k), np.full(k, 12), r.random(k) < 0.7
    whole = set(zip(*(x.tolist() for x in jaccard_join.list_pairs(tok, id_, comp, n, q, m, home, 3, 4)), strict=True))
    group = r.integers(0, 4, k)
    found = []
    for i in range(4):
        for j in range(i, 4):
            some = (group == i) | (group == j)
            own = np.full(some.sum(), -1) if i == j else group[some]
            found += zip(*(x.tolist() for x in jaccard_join.list_pairs(*[x[some] for x in (tok, id_, comp, n, q, m, home)], 3, 4, own)), strict=True)
    assert whole and set(found) == whole and len(found) == len(whole)


def test_long_lists_come_whole():
    tok = np.sort(np.random.default_rng(3).integers(0, 9, 500))
    batches = [pa.record_batch({"tok": tok[a : a + 30], "at": np.arange(a, min(a + 30, 500))}) for a in range(0, 500, 30)]
    tables = list(jaccard_join._by_list(batches, 40, lambda t: t))
    assert np.concatenate([t.column(1).to_numpy() for t in tables]).tolist() == list(range(500)) and len(tables) > 3
    seen = [set(t.column(0).to_pylist()) for t in tables]
    assert all(not a & b for a, b in itertools.combinations(seen, 2))


def test_jaccard_empty(spark):
    assert jaccard_join.similar_groups(docs_of(spark, [(1, "a b c")]).limit(0)).count() == 0


def test_long_text_hashes_like_short_ones():
    words = [f"W{k}" for k in range(300_000)]
    whole = jaccard_join.word_hashes(" ".join(words).encode())
    assert len(whole) == len(words) and np.array_equal(whole[:1000], jaccard_join.word_hashes(" ".join(words[:1000]).lower().encode()))


def test_words_beside_a_giant_word_hash_as_ever(spark, monkeypatch):
    words = [f"W{k}" for k in range(100_000)]
    plain = jaccard_join.word_hashes(" ".join(words).lower().encode())
    blob = random.Random(3).randbytes(3 << 19).hex()  # a word of 3 MB
    for at in (0, 50_000, 100_000):
        got = jaccard_join.word_hashes(" ".join([*words[:at], blob.upper(), *words[at:]]).encode())
        assert np.array_equal(np.delete(got, at), plain)
        assert got[at] == jaccard_join.word_hashes(blob.encode())[0]
    texts = [(1, " ".join([*words, blob])), (2, " ".join(words)), (3, " ".join([*words, blob[: 1 << 20]]))]
    assert {(r["doc_id"], r["component_id"]) for r in jaccard_join.similar_groups(docs_of(spark, texts)).collect()} == {(1, 1), (2, 1), (3, 1)}
    short = [b" ", b"abc  DEFGHIJKLMNOPQRSTUVWXYZ0123456789abcdef g", b"x" * 33, b"\tab " + b"y" * 17 + b"\n"]
    whole = [jaccard_join.word_hashes(t) for t in short]
    monkeypatch.setattr(jaccard_join, "CHUNK", 8)
    monkeypatch.setattr(jaccard_join, "_POWERS", jaccard_join._POWERS[:16])
    monkeypatch.setattr(jaccard_join, "_INVERSES", jaccard_join._INVERSES[:16])
    assert all(np.array_equal(jaccard_join.word_hashes(t), w) for t, w in zip(short, whole, strict=True))


def test_masks_find_every_window():
    for k in (0, 1, 2):
        for gone in itertools.combinations(range(decontamination.WINDOW), k):
            assert any(all(s + o not in gone for o, c in enumerate(m) if c == "1") for m in decontamination.MASKS for s in range(decontamination.WINDOW - len(m) + 1)), gone


def test_decontamination(spark):
    r = random.Random(8)
    word = lambda: "".join(r.choices("abcdefghij", k=4))
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate([15, 30, 40, 13, 9, 6, 5, 3])] + [(50, None), (51, "")]
    texts = []
    for k in range(60):
        w = [word() for _ in range(r.randint(0, 60))]
        i = r.choice(items)[1]
        part = (i or "").split()
        if k % 2 and part:
            for _ in range(r.randint(0, 3)):
                part[r.randrange(len(part))] = word()
            a = r.randint(0, max(0, len(part) - 10))
            w[3:3] = part[a:]
        texts.append((k, ", ".join(w).upper() if k % 3 == 0 else " ".join(w)))
    texts += [(100, None), (101, ""), (None, items[1][1]), (102, " ".join([items[2][1]] * 200)), (103, items[2][1]), (103, "clean")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = {}
    toks = lambda t: [x for x in re.split(r"[\W_]+", (t or "").lower()) if x]
    for (d, t), (i, u) in itertools.product(texts, items):
        a, b = toks(t), toks(u)
        if len(b) < 5:
            continue
        width, best = min(13, len(b)), 0
        for diag in range(-len(b), len(a)):
            eq = [0 <= diag + j < len(a) and a[diag + j] == b[j] for j in range(len(b))]
            best = max(best, max(sum(eq[s : s + width]) for s in range(len(b) - width + 1)))
        if best >= width - (2 if len(b) >= 13 else 0):
            expected[(d, i)] = max(best, expected.get((d, i), 0))
    for block in (100_000, 40):
        got = {(x["doc_id"], x["item_id"]): x["matched"] for x in decontamination.overlaps(docs_of(spark, texts), bench, block=block).collect()}
        assert got == expected
    kept = [x["doc_id"] for x in decontamination.clean(docs_of(spark, texts), bench).collect()]
    assert Counter(kept) == Counter(d for d, _ in texts if d not in {k for k, _ in expected})
    assert decontamination.overlaps(docs_of(spark, texts), bench.limit(0)).count() == 0


def test_urls(spark):
    urls = [None, "", "no scheme", "http://WWW.Example.COM/en/x?y=/z#q", "http://a.example.com/en/", "http://example.com", "http://notexample.com/en/", "https://x.net/es/1", "https://x.net/fr?a=1&b=2", "ftp://h/ä?x", "http://b.org#/en/", "://net/es/"]
    urls += [f"http://h{k}.example.{('com', 'net')[k % 2]}/{('en', 'es', 'fr', 'de')[k % 4]}/{k}?p={k}" for k in range(200)]
    got = {r["page_id"]: r for r in url_filters.filter_urls(spark.createDataFrame([(k, u, "h") for k, u in enumerate(urls)], "page_id long, url string, host string")).collect()}
    for k, u in enumerate(urls):
        rest = u.partition("://")[2] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fits = [x for x in url_filters.RULES if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)]
        best = max(fits, key=lambda x: len(x.text), default=None)
        assert (got[k]["host"], got[k]["path"], got[k]["rule"]) == (host, path, best and best.text)
        assert got[k]["verdict"] == best.verdict if best else got[k]["verdict"] in ("allow", "block")


def test_trees_learn_and_columns_agree(spark):
    r = np.random.default_rng(4)
    x = r.random((500, len(url_filters.FEATURES)))
    y = ((x[:, 0] > 0.5) & (x[:, 3] < 0.6)).astype(float)
    model = url_filters.BoostedTrees().fit(x, y)
    score = model.base + sum(model.values(t, x) for t in model.grown)
    assert ((score > 0) == (y > 0)).mean() > 0.97
    rows = spark.createDataFrame([tuple(map(float, v)) for v in x], ", ".join(f"{f} double" for f in url_filters.FEATURES))
    assert np.allclose(sorted(r[0] for r in rows.select(model.column(url_filters.FEATURES)).collect()), sorted(score))


def test_urls_held_out(spark):
    """Trees learned from three quarters of labelled URLs judge the last quarter, and URLs of a suffix that has no label."""
    r = random.Random(4)
    digits = lambda n: "".join(r.choices("0123456789", k=n))
    letters = lambda n: "".join(r.choices("abcdefgh", k=n))
    make = lambda bad, suffix: f"http://{letters(6)}.{suffix}/{digits(9) if bad else letters(9)}/{letters(4)}" + (f"?a={digits(6)}&b={digits(4)}&c=1" if bad else "")
    rows = [(k, make(k % 2 == 0, ("com", "net")[r.random() < (0.7 if k % 2 else 0.3)]), k % 2 == 0) for k in range(1200)]
    rows += [(2000 + k, make(k % 2 == 0, "org"), k % 2 == 0) for k in range(100)]
    seen = url_filters.lexical(url_filters.host_and_path(spark.createDataFrame(rows, "page_id long, url string, blocked boolean")))
    model = url_filters.train(seen.where("page_id < 900"))
    assert set(model.suffixes) == {"com", "net"}
    got = model.with_suffix(seen).select("page_id", "blocked", (model.score() > 0).alias("said")).where("page_id >= 900").collect()
    assert np.mean([x["blocked"] == x["said"] for x in got if x["page_id"] < 2000]) > 0.95
    assert np.mean([x["blocked"] == x["said"] for x in got if x["page_id"] >= 2000]) > 0.9
    none = url_filters.train(seen.limit(0))
    assert {x["verdict"] for x in url_filters.filter_urls(spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")).collect()} == {"allow"} and not none.suffixes
    assert url_filters.filter_urls(seen.limit(0)).count() == 0


def test_warc_round_trip(spark, tmp_path):
    pages = [(1, "http://a/\r\nx", "same"), (2, "http://b", "same"), (3, None, None), (4, "http://c", ""), (5, "http://d", "é" * 50_000), (6, "http://b/2", "s"), (6, "http://b/3", "same"), (7, "u", "WARC/1.1\r\n\r\n\r\n"), (8, " http://e/%20 \n", "e"), (9, "http://f/%0Ax", "f"), (None, "n", "same"), (None, "n1", "only null"), (None, "n2", "only null")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    path = f"file://{tmp_path}/w"
    warc.write_archives(df, path)
    keeper = {}
    for i, _, h in pages:
        keeper[h or ""] = max((x for x in (i, keeper.get(h or "")) if x is not None), default=None)
    import base64

    order = lambda r: tuple(str(x) for x in r)
    expected = sorted(((i, len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(), "response" if keeper[h or ""] == i else "revisit", None if keeper[h or ""] == i else keeper[h or ""]) for i, _, h in pages), key=order)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    light = warc.read_archives(spark, path, payload=False)
    assert sorted((tuple(r) for r in light.select(columns).collect()), key=order) == expected
    assert Counter(r["target_uri"] for r in light.collect()) == Counter(u for _, u, _ in pages)
    assert [r["page_id"] for r in light.where(F.col("target_uri") == pages[0][1]).collect()] == [1]
    df.write.parquet(f"{tmp_path}/pages.parquet")
    assert sorted((tuple(r) for r in warc.op7_warc(spark, str(tmp_path)).select(columns).collect()), key=order) == expected
    full = warc.read_archives(spark, path)
    assert {(r["page_id"], bytes(r["payload"]).decode()) for r in full.where("record_type = 'response'").collect()} == {(i, h or "") for i, _, h in pages if keeper[h or ""] == i}
    assert {r["page_id"] for r in full.where("target_uri like 'http://b%' and record_type = 'response'").collect()} == {6}
    reader = warc.WarcReader(path, full.schema)
    from pyspark.sql.datasource import EqualTo, GreaterThan

    assert list(reader.pushFilters([EqualTo(("record_type",), "revisit"), GreaterThan(("page_id",), 1)])) == [GreaterThan(("page_id",), 1)]
    rows = [r for p in reader.partitions() for r in reader.read(p)]
    assert rows and all(r[0] == "revisit" for r in rows)
    broken = tmp_path / "w" / "broken.warc.gz"
    broken.write_bytes(warc.member(warc.record(1, "u", "some text", 9, hashlib.sha1(b"other text").hexdigest(), None)))
    with pytest.raises(Exception, match="differs from its digest"):
        warc.read_archives(spark, path).collect()
    broken.unlink()
    foreign = tmp_path / "w" / "z.warc.gz"
    import gzip

    foreign.write_bytes(gzip.compress(b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n") + gzip.compress(b"WARC/1.0\r\nWARC-Type: metadata\r\nContent-Length: 0\r\n\r\n\r\n\r\n"))
    assert light.where("record_type in ('warcinfo', 'metadata')").count() == 2


def test_rollup(spark, tmp_path):
    rollup = token_rollup.TokenRollup(spark, f"file://{tmp_path}/r")
    row = "struct<source:string,lang:string,tokenizer:string,n_tokens:bigint>"
    batch = lambda *rows: spark.createDataFrame(list(rows), f"before {row}, after {row}")
    assert rollup.totals().count() == 0
    a, b, c = ("s", "en", "v1", 10), ("s", None, "v1", 5), ("s", "en", "v2", 12)
    assert rollup.apply("1", batch((None, a), (None, a), (None, b)))
    assert not rollup.apply("1", batch((None, a)))
    assert rollup.apply("2", batch((a, c), (b, None), (None, ("t", "en", "v1", None))))
    want = {("s", "en", "v1", 1, 10), ("s", "en", "v2", 1, 12), ("t", "en", "v1", 1, 0)}
    assert {tuple(r) for r in rollup.totals().collect()} == want
    rollup.compact()
    assert {tuple(r) for r in rollup.totals().collect()} == want and not rollup.apply("2", batch((None, a)))
    rollup.apply("3", batch((c, None)))
    assert {tuple(r) for r in rollup.totals().collect()} == want - {("s", "en", "v2", 1, 12)}


def test_rollup_survives_failures(spark, tmp_path, monkeypatch):
    row = "struct<source:string,lang:string,tokenizer:string,n_tokens:bigint>"
    batch = spark.createDataFrame([(None, ("s", "en", "v1", 10))], f"before {row}, after {row}")
    rollup = token_rollup.TokenRollup(spark, f"file://{tmp_path}/r")
    stage = token_rollup.TokenRollup._stage

    def die(self, *args):
        raise RuntimeError("driver lost")

    def die_late(self, *args):
        stage(self, *args)
        raise RuntimeError("driver lost")

    for broken in (die, die_late):  # before and after the staged file, never with a commit
        monkeypatch.setattr(token_rollup.TokenRollup, "_stage", broken)
        with pytest.raises(RuntimeError):
            rollup.apply("1", batch)
        assert rollup.totals().count() == 0
    monkeypatch.setattr(token_rollup.TokenRollup, "_stage", stage)
    assert rollup.apply("1", batch) and not rollup.apply("1", batch)
    assert not rollup._decide("1", {"folder": "deltas/of-a-second-writer"})
    assert [r["n_tokens"] for r in rollup.totals().collect()] == [10]
    assert rollup.apply("2", batch)
    total = token_rollup.TokenRollup._sum

    def meanwhile(self, folders):  # another batch comes in while the compaction runs
        monkeypatch.setattr(token_rollup.TokenRollup, "_sum", total)
        assert self.apply("3", batch)
        return total(self, folders)

    monkeypatch.setattr(token_rollup.TokenRollup, "_sum", meanwhile)
    rollup.compact()
    assert [tuple(r)[3:] for r in rollup.totals().collect()] == [(3, 30)]
    rollup.compact()
    assert [tuple(r)[3:] for r in rollup.totals().collect()] == [(3, 30)] and len(rollup.entries()[0]) == 1
    assert not rollup.compact()


@pytest.mark.parametrize("second_first", [False, True])
def test_overlapping_compactions(spark, tmp_path, monkeypatch, second_first):
    """One folds {1, 2}; meanwhile 3 comes and another folds {1, 2, 3}. Whichever is decided first, each batch counts once."""
    row = "struct<source:string,lang:string,tokenizer:string,n_tokens:bigint>"
    batch = lambda n: spark.createDataFrame([(None, ("s", "en", "v1", n))], f"before {row}, after {row}")
    rollup = token_rollup.TokenRollup(spark, f"file://{tmp_path}/r")
    rollup.apply("1", batch(10)), rollup.apply("2", batch(20))
    total, decide = token_rollup.TokenRollup._sum, token_rollup.TokenRollup._decide
    other = token_rollup.TokenRollup(spark, rollup.path)
    results = []

    def meanwhile(self, *args):
        monkeypatch.setattr(token_rollup.TokenRollup, "_sum", total)
        monkeypatch.setattr(token_rollup.TokenRollup, "_decide", decide)
        other.apply("3", batch(40))
        results.append(other.compact())
        return (total if second_first else decide)(self, *args)

    monkeypatch.setattr(token_rollup.TokenRollup, "_sum" if second_first else "_decide", meanwhile)
    assert not rollup.compact() and results == [True]
    want = [("s", "en", "v1", 3, 70)]
    assert [tuple(r) for r in rollup.totals().collect()] == want
    assert not any(rollup.apply(k, batch(1)) for k in "123")
    for k in range(3):  # folded files go with the compaction after the next; ids stay decided
        rollup.apply(f"more {k}", batch(1))
        assert rollup.compact()
    assert [tuple(r)[3:] for r in rollup.totals().collect()] == [(6, 73)]
    assert len(list((tmp_path / "r" / "deltas").iterdir())) == 3 and len([p for p in (tmp_path / "r" / "live").iterdir() if not p.name.startswith(".")]) == 3
    assert not any(rollup.apply(k, batch(1)) for k in ("1", "2", "3", "more 0"))


def test_a_lost_attempt_is_swept(spark, tmp_path):
    row = "struct<source:string,lang:string,tokenizer:string,n_tokens:bigint>"
    batch = spark.createDataFrame([(None, ("s", "en", "v1", 10))], f"before {row}, after {row}")
    rollup = token_rollup.TokenRollup(spark, f"file://{tmp_path}/r")
    rollup._put("live/lost", {"batch": "1", "name": "live/lost", "folder": "deltas/lost"})  # its driver died before the decision
    assert rollup.totals().count() == 0
    assert rollup.apply("1", batch) and rollup.apply("2", batch)
    assert [tuple(r)[3:] for r in rollup.totals().collect()] == [(2, 20)]
    assert rollup.compact() and not rollup._exists("live/lost")
    assert [tuple(r)[3:] for r in rollup.totals().collect()] == [(2, 20)]


def test_token_counts_query(spark, tmp_path):
    """The whole query against sums by source and language."""
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokens.tokenizer_path("byte_bpe_50k.json"))
    texts = [*corpus(), (2000, "a <|endoftext|> b")]
    rows = [(i, t, (None, "aa", "bb")[k % 3], f"s{k % 2}" if k % 5 else None) for k, (i, t) in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    expected = defaultdict(lambda: [0, 0])
    for _, t, lang, source in rows:
        n = len(plain.encode(t, add_special_tokens=False).ids) if t else 0
        if n:
            expected[(source, lang, token_rollup.BPE)][0] += 1
            expected[(source, lang, token_rollup.BPE)][1] += n
    got = token_rollup.op8_token_counts(spark, str(tmp_path)).collect()
    assert {(r["source"], r["lang"], r["tokenizer"]): [r["n_docs"], r["n_tokens"]] for r in got} == expected


def ctw(training, texts, depth):
    """Direct recursion over explicit counts."""
    counts = defaultdict(lambda: [0, 0])
    pad = b"\xff" * depth

    def bits(data):
        data = pad + data + b"\xff"
        for k in range(depth, len(data)):
            node = 1
            for j in range(8):
                bit = data[k] >> (7 - j) & 1
                yield [(data[k - d : k], node) for d in range(depth + 1)], bit
                node = node << 1 | bit

    children = defaultdict(set)
    for t in training:
        for path, bit in bits(t):
            for d, key in enumerate(path):
                counts[key][bit] += 1
                if d:
                    children[path[d - 1]].add(key)
    kt = lambda n: math.lgamma(n[0] + 0.5) + math.lgamma(n[1] + 0.5) - math.log(math.pi) - math.lgamma(sum(n) + 1)
    memo = {}

    def weigh(key):
        if key not in memo:
            own = kt(counts[key])
            below = sum(weigh(c) for c in children[key])
            memo[key] = own if len(key[0]) == depth else np.logaddexp(own, below) - math.log(2)
        return memo[key]

    def score(t):
        total = 0.0
        for path, bit in bits(t):
            p = 0.5
            for key in reversed(path):
                own = (counts[key][bit] + 0.5) / (sum(counts[key]) + 1) if key in counts else 0.5
                w = 1.0 if len(key[0]) == depth else math.exp(kt(counts[key]) - math.log(2) - weigh(key)) if key in counts else 0.5
                p = w * own + (1 - w) * p
            total += math.log10(p)
        return total

    return [score(t) for t in texts]


def test_context_tree(spark):
    texts = corpus(9, 30)
    got = context_tree.score_documents(docs_of(spark, texts), folds=10).collect()
    low = [(i, context_tree.lowered(t)) for i, t in texts]
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    training = [t for i, t in low if not held(i)]
    count = Counter(w for t in training for w in [*t.split(), b""])
    n, v = sum(count.values()), len(count)
    expected = []
    for (i, t), s in zip(low, ctw(training, [t for _, t in low], context_tree.DEPTH), strict=True):
        words = [*t.split(), b""]
        expected.append((i, held(i), len(words), sum(count[w] > 0 for w in words), n, sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words), s))
    got = sorted(tuple(r) for r in got)
    for a, b in zip(got, sorted(expected), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=1e-6) and a[6] == pytest.approx(b[6], rel=1e-4), (a, b)


def test_rare_tokens_are_joined(spark, monkeypatch):
    texts = corpus(9, 30)
    whole = sorted((r["doc_id"], r["n_known"], round(r["base_score"], 6)) for r in context_tree.score_documents(docs_of(spark, texts)).collect())
    monkeypatch.setattr(context_tree, "HEAD", 3)
    assert sorted((r["doc_id"], r["n_known"], round(r["base_score"], 6)) for r in context_tree.score_documents(docs_of(spark, texts)).collect()) == whole


@pytest.mark.parametrize(("nodes", "per_bucket", "per_split"), [(0, 1 << 16, 1 << 23), (5, 300, 900), (1000, 1000, 20)])
def test_codes_beyond_the_broadcast_are_joined(spark, monkeypatch, nodes, per_bucket, per_split):
    monkeypatch.setattr(context_tree, "NODES", nodes)
    monkeypatch.setattr(context_tree, "BUCKET_CODES", per_bucket)
    monkeypatch.setattr(context_tree, "SPLIT_CODES", per_split)
    texts = [*corpus(9, 30), (499, "zero \0 byte"), (500, None), (501, "zq Ωж never seen"), (502, "zq Ωж never seen")]
    got = sorted((r["doc_id"] or 0, r["score"]) for r in context_tree.score_documents(docs_of(spark, texts)).collect())
    low = [(i, context_tree.lowered(t)) for i, t in texts]
    training = [t for i, t in low if zlib.crc32(str(i).encode()) % 10]
    expected = sorted((i or 0, s) for (i, _), s in zip(low, ctw(training, [t for _, t in low], context_tree.DEPTH), strict=True))
    assert [i for i, _ in got] == [i for i, _ in expected]
    assert [s for _, s in got] == pytest.approx([s for _, s in expected], rel=1e-9)


def test_nothing_to_learn_from(spark):
    assert [r["score"] for r in context_tree.score_documents(docs_of(spark, [(1, "ab")]), folds=1).collect()] == pytest.approx([24 * math.log10(0.5)])


def removed(texts):
    first = {}
    for i, t in sorted(((i, (t or "").encode()) for i, t in texts if i is not None), key=lambda x: x[0]):
        for k in range(len(t) - 49):
            first.setdefault(t[k : k + 50], i)
    out = []
    for i, t in texts:
        t = (t or "").encode()
        cover = bytearray(len(t))
        for k in range(len(t) - 49):
            if i is not None and first[t[k : k + 50]] < i:
                cover[k : k + 50] = b"\1" * 50
        kept = bytes(c for c, m in zip(t, cover, strict=True) if not m)
        out.append((i, len(t), sum(cover), len(re.findall(b"\1+", bytes(cover))), hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_dedup(spark, monkeypatch):
    passage = corpus(11, 50)[3][1] * 3
    r = random.Random(2)
    odd = "".join(r.choices("qwertz ", k=400))
    long_ones = [(4000, "first " + odd + passage), (4001, odd[:200] + " other " + passage[:120] + odd[:70]), (4001, "nothing in common " * 30), (4001, odd[:200] + " other"), (4002, odd), (4002, "x" + odd)]
    texts = [*corpus(11, 50), *long_ones, (3000, "ab" * 400), (3001, "ba" * 300 + "c"), (3002, "é" * 90), (None, "x" * 200), (3003, "\0" * 120), (3004, "q" + "\0" * 130)]
    for size in (24 << 20, 2000):
        monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", size)
        monkeypatch.setattr(suffix_dedup, "HELD", 50 if size == 2000 else 1 << 18)
        monkeypatch.setattr(suffix_dedup, "SPOOL", 10 if size == 2000 else 1 << 20)
        monkeypatch.setattr(suffix_dedup, "CHUNK", 5 if size == 2000 else 1 << 20)
        got = suffix_dedup.digests(docs_of(spark, texts)).collect()
        assert Counter(tuple(r) for r in got) == Counter(removed(texts))
    assert suffix_dedup.digests(docs_of(spark, texts).limit(0)).count() == 0


@pytest.mark.parametrize("chunk", [1 << 20, 64, 7, 1])
def test_column_wise_construction(monkeypatch, chunk):
    monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
    for seed, letters in ((5, 3), (6, 2), (7, 200)):
        r = np.random.default_rng(seed)
        rows = r.integers(1, letters, (80, 14)).astype(np.uint8)
        rows[40:60] = rows[3]  # a group that spans chunks
        doc, valid = r.integers(0, 9, 80), r.random((80, 6)) < 0.7
        got = suffix_dedup.common_starts((rows[:, c] for c in reversed(range(14))), 14, lambda x, c, valid=valid: valid[x, c], doc, 8, 6)
        for i, c in itertools.product(range(80), range(6)):
            want = valid[i, c] and any(valid[j, c] and doc[j] < doc[i] and (rows[j, c : c + 8] == rows[i, c : c + 8]).all() for j in range(80))
            assert bool(got[i] >> c & 1) == want


def test_tags_are_those_of_spark(spark):
    texts = ["", "a", "é" * 100, "x" * 5000]
    got = {r["t"]: r["h"] for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.xxhash64("t").alias("h")).collect()}
    assert got == {t: suffix_dedup.tag_of(t.encode()) for t in texts}


def test_long_texts_are_cut_into_parts(monkeypatch):
    cells = np.random.default_rng(6).integers(97, 100, 5000).astype(np.uint8)
    whole = suffix_dedup.minimisers(cells, 4)
    monkeypatch.setattr(suffix_dedup, "_PART", 700)
    parts = suffix_dedup.minimisers(cells, 4)
    spread = lambda m: {(s + k, p, h) for s, n, p, h in zip(*(x.tolist() for x in m), strict=True) for k in range(n)}
    assert spread(whole) == spread(parts)


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    texts = [(i, t) for i, t in corpus(12, 40) if i not in (6, 9)]
    docs = docs_of(spark, texts, {i: "aa" for i, _ in texts})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    item = next(t for i, t in sorted(texts) if t and len(t.split()) > 40)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stage = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near duplicates", "repeated passages", "benchmark", "packing"]
    kept = stage["language"](spark, docs, str(tmp_path))
    assert {r["doc_id"] for r in kept.collect()} == {i for i, t in texts if t and any(map(str.isalpha, t))}
    kept = corpus_pipeline.durable(kept, "t")
    groups = {r["doc_id"]: r["component_id"] for r in jaccard_join.similar_groups(kept).collect()}
    one = corpus_pipeline.durable(stage["near duplicates"](spark, kept, str(tmp_path)), "t")
    assert sorted(r["doc_id"] for r in one.collect()) == sorted(set(groups.values()))
    cut = corpus_pipeline.durable(stage["repeated passages"](spark, one, str(tmp_path)), "t")
    assert cut.schema.names == docs.schema.names
    sizes = {r[0]: r[1] - r[2] for r in removed([(r["doc_id"], r["text"]) for r in one.collect()])}
    assert all(len(r["text"].encode()) <= sizes[r["doc_id"]] and len(r["text"]) == r["n_chars"] for r in cut.collect())
    clean = corpus_pipeline.durable(stage["benchmark"](spark, cut, str(tmp_path)), "t")
    assert clean.count() < cut.count()
    check_packing(stage["packing"](spark, clean, str(tmp_path)).collect(), [(r["doc_id"], r["text"]) for r in clean.collect()], 1024)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    for name, f in corpus_pipeline.STAGES:
        empty = f(spark, docs.limit(0), str(tmp_path))
        assert empty.count() == 0 and (name == "packing" or empty.columns == docs.columns)


def test_pipeline_stages_with_clashing_columns(spark, tmp_path):
    import corpus_pipeline

    passage = "a passage that more than one of these documents holds and that is long enough to be cut out "
    texts = [(1, "one " + passage + "end of it"), (2, passage + "two and more words"), (2, "nothing in common with any other text of this table at all"), (3, "one " + passage + "end of it"), (None, passage), (4, None)]
    names = ["marks", "whole", "id", "out", "Score", "LANG_pred", "tag", "copies"]
    rows = [(i, t, "aa", "s", len(t or ""), *[f"{c}{k}" for c in names]) for k, (i, t) in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in names))
    spark.createDataFrame([(1, "no text of the table holds this benchmark item whatever")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, str(tmp_path))
        assert got.columns == docs.columns
        assert {r["marks"]: r["copies"] for r in got.collect()}.items() <= {f"marks{k}": f"copies{k}" for k in range(6)}.items(), name
    cut = {r["marks"]: r["text"] for r in corpus_pipeline.passage_stage(spark, docs, str(tmp_path)).collect()}
    assert "marks3" not in cut and "marks5" not in cut and cut["marks2"] == texts[2][1] and cut["marks4"] == passage
    assert len(cut["marks1"]) < 30 and cut["marks1"].endswith("two and more words")
