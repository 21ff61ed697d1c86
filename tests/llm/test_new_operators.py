"""Fingerprints, importance resampling and clustering against brute force on small tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sakuin.llm import centroids, importance, jaccard_join, minhash
from test_llm import corpus, docs_of

# ---- centroid clustering


def lloyd(rows, clusters, rounds, seed=3, dimensions=4):
    """Plain rounds over all pairs."""
    kept = [(i, [math.floor(1024 * float(np.float32(v))) for v in x]) for i, x in rows if x is not None and len(x) == dimensions and all(v is not None and math.isfinite(v) for v in x)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cs = [x for _, x in order[:clusters]]
    nearest = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), j) for j, c in enumerate(cs))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, x in kept:
            groups[nearest(x)[1]].append(x)
        cs = [[sum(v) // len(groups[j]) for v in zip(*groups[j], strict=True)] if groups[j] else c for j, c in enumerate(cs)]
    return Counter((i, nearest(x)[1], nearest(x)[0]) for i, x in kept), cs


def vectors_of(spark, rows):
    schema = "vec_id long, embedding array<float>, x int, cluster string, part int"
    return spark.createDataFrame([(i, x, 1, "c", 0) for i, x in rows], schema).repartition(3)


@pytest.mark.parametrize(("seed", "clusters", "bounds", "grid"), [(1, 8, None, False), (2, 3, 2, True), (3, 12, 3, True), (4, 5, 9, False)])
def test_clusters_equal_plain_rounds(spark, seed, clusters, bounds, grid):
    r = random.Random(seed)
    value = (lambda: float(r.randint(-2, 2))) if grid else lambda: r.gauss(0, 1)  # a grid has many ties
    rows = [(i, [value() for _ in range(4)]) for i in range(120)]
    rows += [(i, list(rows[i][1])) for i in range(10)] + [(None, [0.5] * 4), (500, None), (501, [1.0] * 3), (502, [1.0, None, 1.0, 1.0]), (503, [float("nan")] * 4), (504, [float("inf"), 0.0, 0.0, 0.0]), (505, [])]
    found, cs, report = centroids.cluster(vectors_of(spark, rows), 4, clusters, 10, bounds=bounds)
    want, final = lloyd(rows, clusters, 10)
    assert Counter(tuple(x) for x in found.collect()) == want
    assert cs.tolist() == final
    assert all(x["width"] >= 2 for x in report)
    totals = centroids.with_totals(found, cs).collect()
    sums = Counter()
    for (_, c, d), n in want.items():
        sums[c] += d * n
    assert all(x["cluster_inertia"] == sums[x["cluster"]] and x["inertia"] == sum(sums.values()) for x in totals)
    assert all(x["centroid_sha256"] == hashlib.sha256(",".join(map(str, final[x["cluster"]])).encode()).hexdigest() for x in totals)


def test_bounds_spare_distances_and_certify_exactly():
    r = np.random.default_rng(5)
    centers = r.integers(-3000, 3000, (16, 8))
    x = (centers[r.integers(0, 16, 4000)] + r.integers(-400, 400, (4000, 8))).astype(np.int64)
    at = x[r.choice(4000, 16, replace=False)].copy()
    held, moves, measured = None, None, []
    for _ in range(9):
        *held, _, some = centroids.assign(x, at, 4, held, moves)
        measured.append(some)
        d = ((x[:, None] - at[None]) ** 2).sum(axis=2)
        assert (held[0] == d.argmin(axis=1)).all()
        assert (held[1] >= np.sqrt(d.min(axis=1))).all()
        others = np.sort(np.where(np.arange(16)[None] == held[0][:, None], 1 << 60, d), axis=1)
        assert (np.minimum.accumulate(held[3][:, ::-1], axis=1)[:, -1] <= np.sqrt(others[:, 0])).all()
        new = np.array([x[held[0] == c].sum(axis=0) // max(1, (held[0] == c).sum()) if (held[0] == c).any() else at[c] for c in range(16)])
        moves, at = np.sqrt(((new - at) ** 2).sum(axis=1).astype(float)) * (1 + 2.0**-40), new
    assert measured[0] == 16 * 4000
    assert sum(measured[1:]) < 0.5 * 8 * 16 * 4000


def test_few_and_no_vectors(spark):
    for rows in ([], [(1, None)]):
        found, cs, _ = centroids.cluster(vectors_of(spark, rows), 4, 3)
        out = centroids.with_totals(found, cs)
        assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
        assert not out.collect()
    one = [(7, [1e30, -1e30, 0.0, 2.0])]
    found, cs, _ = centroids.cluster(vectors_of(spark, one), 4, 3)
    assert [tuple(r) for r in found.collect()] == [(7, 0, 0)]
    assert cs.tolist() == [[centroids.LIMIT, -centroids.LIMIT, 0, 2048]]
    assert len(centroids.cluster(vectors_of(spark, [*one, (8, [0.0] * 4)]), 4, 3)[0].collect()) == 2


# ---- importance resampling


def resampled(docs, target, run, buckets, percent, least, seed):
    def features(text):
        found = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode())
        runs = [b" ".join(found[i : i + k]) for k in range(1, run + 1) for i in range(len(found) - k + 1)]
        return len(found), [zlib.crc32(x) % buckets for x in runs]

    rows = [(i, *features(t)) for i, t in docs]
    s, t = Counter(b for _, _, f in rows for b in f), Counter(b for x in target for b in features(x)[1])
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (sum(s.values()) + buckets) / ((s[b] + 1) * (sum(t.values()) + buckets)))) for b in s}
    out = []
    for i, n, f in rows:
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in f)
        out.append((i, n, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((x for x in out if x[1] >= least), key=lambda x: (-x[4], -1 if x[0] is None else x[0]))
    drawn = able[: percent * len(able) // 100]
    return Counter(tuple(x[k] for k in (0, 2, 3, 4)) for x in out), [(x[0], x[2], x[3], x[4]) for x in drawn]


@pytest.mark.parametrize(("run", "buckets", "percent", "least", "cells"), [(1, 10_000, 10, 20, 1 << 18), (2, 50, 40, 3, 60), (3, 1, 100, 0, 1)])
def test_resampling(spark, monkeypatch, run, buckets, percent, least, cells):
    monkeypatch.setattr(importance, "CELLS", cells)
    texts = corpus(3) + [(None, "Ab 12 cd_ef É\x00é"), (2000, "q " * 4000), (2001, "　x")]
    texts += [(2000, "q " * 4000)] * 3  # repeated rows tie
    target = [t for _, t in texts[:9]] + [None, ""]
    goal = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    got = importance.resample(docs_of(spark, texts), goal, run, buckets, percent, least, 11).collect()
    rows, drawn = resampled(texts, target, run, buckets, percent, least, 11)
    assert Counter(tuple(r)[:4] for r in got) == rows
    assert [tuple(r)[:4] for r in sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])] == drawn
    assert sorted(r["rank"] for r in got if r["rank"] is not None) == list(range(1, len(drawn) + 1))


def test_resampling_of_nothing(spark):
    none, goal = docs_of(spark, []), spark.createDataFrame([("a b",)], "text string")
    assert not importance.resample(none, goal).collect()
    docs = docs_of(spark, [(1, "a b"), (2, None)])
    assert {r["doc_id"]: r["n_features"] for r in importance.resample(docs, goal.limit(0), least=0).collect()} == {1: 2, 2: 0}


def test_stored_blocks_are_decoded_in_bounded_parts(spark, tmp_path, monkeypatch):
    """Readers decode up to a row group of nested values at a time, so its cells are bounded, however many a task writes."""
    from pyarrow import parquet

    monkeypatch.setattr("sakuin.llm.shared.shared_dir", lambda _: f"file://{tmp_path}")
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(1999)), lambda i: F.xxhash64(i, "id").cast("string"))).alias("text")).coalesce(1)
    importance.resample(docs, docs.where("doc_id < 3"))
    files = [parquet.ParquetFile(f).metadata for f in tmp_path.glob("blocks-*/*.parquet")]
    groups = [(m.row_group(g).num_rows, m.row_group(g).column(4).num_values) for m in files for g in range(m.num_row_groups)]
    assert sum(n for _, n in groups) > 5_000_000
    assert max(n for _, n in groups) < 3_000_000
    assert max(n / rows for rows, n in groups) <= importance.CELLS + importance.BUCKETS


def test_matrix_blocks_hold_every_cell(spark):
    got = importance.blocks(docs_of(spark, corpus(4)), 2, 97).collect()
    cells = {}
    for b in got:
        assert len(b["start"]) == len(b["doc_id"]) + 1 == len(b["words"]) + 1
        for k, i in enumerate(b["doc_id"]):
            cells.setdefault(i, []).append(dict(zip(b["bucket"][b["start"][k] : b["start"][k + 1]], b["n"][b["start"][k] : b["start"][k + 1]], strict=True)))
    total = Counter()
    for rows in cells.values():
        for r in rows:
            total.update(r)
    sums = importance.column_sums(importance.blocks(docs_of(spark, corpus(4)), 2, 97), 97)
    assert {b: n for b, n in enumerate(sums.tolist()) if n} == dict(total)


# ---- fingerprints


def brute_print(text):
    s = jaccard_join.shingle_set(text)
    if not len(s):
        return b""
    mask = (1 << 64) - 1
    return b"".join((min(((int(a) * int(x) + int(b)) & mask) >> 32 for x in s) & 0xFFFF).to_bytes(2, "little") for a, b in zip(minhash._FACTORS, minhash._OFFSETS, strict=True))


@pytest.mark.parametrize("part", [1 << 22, 300])
def test_fingerprints(spark, monkeypatch, part):
    monkeypatch.setattr(minhash, "PART", part)
    monkeypatch.setattr(minhash, "CELLS", 50)
    texts = [x for x in corpus(6) if x[0] not in (6, 9)] + [(None, "a null id"), (3000, "\U0001f600 é ｱ " * 50), (-5, "below zero")]
    got = {r["doc_id"]: r for r in minhash.fingerprints(docs_of(spark, texts)).collect()}
    order = sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0))
    assert len(got) == len(texts)
    for k, (i, t) in enumerate(order):
        t, u = t or "", order[(k + 1) % len(order)][1] or ""
        m = len(t) // 4
        changed = t[: len(t) - m] + u[:m]
        a, b, c = brute_print(t), brute_print(changed), brute_print(u)
        r = got[i]
        assert (r["n_chars"], r["edited"], bytes(r["print"]), bytes(r["edited_print"])) == (len(t), hashlib.sha256(changed.encode()).digest(), a, b)
        same = lambda x, y: float(x == y) if not x or not y else sum(x[j : j + 2] == y[j : j + 2] for j in range(0, 256, 2)) / 128
        assert (r["near_edited"], r["near_next"]) == (same(a, b), same(a, c))
        assert 0 <= r["near_edited"] <= 1


def test_fingerprints_of_few_and_repeated_rows(spark):
    assert not minhash.fingerprints(docs_of(spark, [])).collect()
    r = minhash.fingerprints(docs_of(spark, [(4, "one two three four five six")])).collect()[0]
    assert r["near_next"] == 1.0
    assert r["edited"] == hashlib.sha256(b"one two three four fi" + b"one tw").digest()
    rows = minhash.fingerprints(docs_of(spark, [(4, "a b c d e f")] * 5 + [(4, None)])).collect()
    assert Counter(bytes(r["print"]) != b"" for r in rows) == {True: 5, False: 1}
    assert len({bytes(r["print"]) for r in rows if r["print"]}) == 1


def test_likeness_estimates_jaccard(spark):
    r = random.Random(8)
    words = ["".join(r.choices("abcdefgh", k=5)) for _ in range(3000)]
    off = []
    for change in (0, 3, 10, 30, 80):
        a = r.choices(words, k=400)
        b = [r.choice(words) if r.random() < change / 400 else w for w in a]
        s, t = (jaccard_join.shingle_set(" ".join(x)) for x in (a, b))
        true = len(np.intersect1d(s, t)) / len(np.union1d(s, t))
        p, q = (minhash.prints(minhash.least_hashes([x]), [x])[0] for x in (s, t))
        off.append(abs(true - minhash.likeness(p, q)))
        col = spark.createDataFrame([(bytearray(p), bytearray(q))], "a binary, b binary").select(minhash.likeness_of(F.col("a"), F.col("b")).alias("x")).first()["x"]
        assert col == minhash.likeness(p, q)
    assert max(off) < 0.16
    assert np.mean(off) < 0.07


def test_near_duplicates(spark):
    r = random.Random(9)
    words = ["".join(r.choices("abcdefgh", k=5)) for _ in range(3000)]
    texts = []
    for family in range(25):
        base = r.choices(words, k=r.choice([12, 60, 200]))
        for copy in range(r.choice([1, 2, 3, 12])):
            t = list(base)
            for _ in range(r.randint(0, max(1, len(t) // 60))):
                t[r.randrange(len(t))] = r.choice(words)
            texts.append((family * 100 + copy, " ".join(t)))
    texts += [(5000, None), (5001, ""), (5002, " "), (5003, "x"), (5004, "X"), (0, "another text of that id which is long enough"), (None, texts[0][1])]
    r.shuffle(texts)
    got = minhash.near_duplicates(docs_of(spark, texts)).collect()
    assert Counter(x["doc_id"] for x in got) == Counter(i for i, _ in texts)
    assert {x["class_id"] for x in got if x["doc_id"] is None} == {None}
    classes = {x["doc_id"]: x["class_id"] for x in got}
    links, hit = 0, 0
    parent = {i: i for i, _ in texts if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets = [(i, set(jaccard_join.shingle_set(t).tolist())) for i, t in texts if i is not None]
    for k, (i, s) in enumerate(sets):
        for j, t in sets[:k]:
            if i == j or (s and t and 4 * len(s & t) >= 3 * len(s | t)):
                links, hit = links + 1, hit + (classes[i] == classes[j])
                parent[max(root(i), root(j))] = min(root(i), root(j))
    assert all(root(i) == root(c) for i, c in classes.items() if i is not None)  # never joined wrongly
    assert hit >= 0.98 * links
    alone = [x for x in got if x["doc_id"] in (5000, 5001, 5002)]
    assert all(x["class_id"] == x["doc_id"] and x["n_links"] == 0 for x in alone)
    assert not minhash.near_duplicates(docs_of(spark, [])).collect()
