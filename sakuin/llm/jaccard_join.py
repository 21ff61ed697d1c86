"""Exact set-similarity join on word shingles, skipping by set relations.

Equal sets are one set. A set whose smallest hashes point to another is compared with that leader; if they link, both are in one
component, and no pair within a component is looked at again. For the rest, an inverted index over prefixes lists the sets of
each shingle by size and position. A link needs a least number of shared prefix shingles, so it shows at a shingle behind which
both sets still have that many; blocks of equal size are skipped up to there. Leaders' pairs are measured first. A member's
answers follow from its leader's: what its leader links with it is joined to already, and the shingles in which it differs from
the leader bound how far its overlap with any other set can be from the leader's; only pairs that the bounds leave open are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sakuin.llm.shared import Tables, bucketed, durable, forget

SHINGLE = 5
SIGNATURE = 8  # smallest hashes of a set that point to a leader
FREQUENT = 1 << 17  # shingles that are put last in the order of all shingles; only speed depends on it
LONG = 4096  # index lists from this length on are split by the sizes of their sets
BLOCK = 4096  # entries of a split list's part; a part with more is dealt to groups, and each two groups meet in a task of their own
CHUNK = 1 << 20  # bytes of text hashed at once
ENTRIES = 1 << 17  # index entries that leave a task together
CELLS = 1 << 20  # pairs of entries that are looked at together, and pairs that are held before equal ones are folded

_SPACES = np.zeros(256, bool)
_SPACES[[32, *range(9, 14)]] = True
_VALUES = np.random.default_rng(11).integers(1, 1 << 63, 256, np.uint64)
_VALUES[65:91] = _VALUES[97:123]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.full(2 * CHUNK, _BASE), dtype=np.uint64)
_INVERSES = np.cumprod(np.full(2 * CHUNK, pow(int(_BASE), -1, 1 << 64), np.uint64), dtype=np.uint64)
_PLACES = np.cumprod(np.full(SHINGLE, 0xD1342543DE82EF95, np.uint64), dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _long_word(word: bytes) -> np.ndarray:
    """The hash of one word of any length: the sum is carried over chunks."""
    total, shift = np.zeros(1, np.uint64), np.ones(1, np.uint64)
    for at in range(0, len(word), CHUNK):
        cells = np.frombuffer(word[at : at + CHUNK], np.uint8)
        total += (_VALUES[cells] * _POWERS[: len(cells)]).sum(keepdims=True, dtype=np.uint64) * _INVERSES[:1] * shift
        shift *= _POWERS[CHUNK - 1]
    return _mix(total)


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word, A-Z as a-z; a text beyond CHUNK is hashed in parts that end at white space."""
    out = []
    while text:
        part, text = text, b""
        if len(part) > CHUNK:
            cut = next((k for k in range(CHUNK, len(part)) if _SPACES[part[k]]), len(part))
            if cut > len(_POWERS):  # a word of over a megabyte goes alone, after the part before it
                start = next((k for k in range(CHUNK, 0, -1) if _SPACES[part[k - 1]]), 0)
                if not start:
                    out.append(_long_word(part[:cut]))
                    text = part[cut:]
                    continue
                cut = start
            part, text = part[:cut], part[cut:]
        cells = np.frombuffer(part, np.uint8)
        gap = np.r_[True, _SPACES[cells], True]
        starts, ends = np.flatnonzero(gap[:-1] & ~gap[1:]), np.flatnonzero(~gap[:-1] & gap[1:])
        sums = np.r_[np.uint64(0), np.cumsum(_VALUES[cells] * _POWERS[: len(cells)], dtype=np.uint64)]
        out.append(_mix((sums[ends] - sums[starts]) * _INVERSES[starts] if len(starts) else np.empty(0, np.uint64)))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's 5-word shingles, or of all its words if it has fewer."""
    words = word_hashes(text.encode()) if text else np.empty(0, np.uint64)
    n = len(words)
    if n < SHINGLE:
        return _mix((words * _PLACES[:n]).sum(keepdims=True, dtype=np.uint64) + np.uint64(n)) if n else words
    total = words[: n - SHINGLE + 1] * _PLACES[0]
    for k in range(1, SHINGLE):
        total = total + words[k : n - SHINGLE + 1 + k] * _PLACES[k]
    return np.unique(_mix(total + np.uint64(SHINGLE)))


def _signed(x) -> pa.Array:
    return pa.array(np.asarray(x, np.uint64).view(np.int64))


def _sketches(docs: DataFrame) -> DataFrame:
    """Rows of documents: doc_id, n, a 128-bit fingerprint of the set and its signature; and, with n null, rows of shingles
    that several different sets of one batch hold: hi (the shingle) and lo (how many)."""

    def scan(batches):
        for batch in batches:
            ids, texts = batch.column(0), (t.as_py() for t in batch.column(1))
            n, hi, lo, sig, seen, pool, size, extra = [], [], [], [], set(), [], 0, []

            def tally(pool=pool, extra=extra):
                if pool:
                    token, count = np.unique(np.concatenate(pool), return_counts=True)
                    extra.append((token[count > 3], count[count > 3]))
                    pool.clear()

            for text in texts:
                s = shingle_set(text)
                mark = xxhash.xxh3_128_intdigest(s.tobytes())
                n.append(len(s)), hi.append(mark >> 64), lo.append(mark & (1 << 64) - 1), sig.append(s[:SIGNATURE].view(np.int64))
                if mark not in seen:
                    seen.add(mark)
                    pool.append(s)
                    size += len(s)
                if size > 2_000_000:
                    tally()
                    size = 0
            tally()
            token, count = (np.concatenate(x) for x in zip(*extra, strict=True)) if extra else (np.empty(0, np.uint64), np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), pa.array(n, pa.int64()), _signed(hi), _signed(lo), pa.array(sig, pa.list_(pa.int64()))], names=["doc_id", "n", "hi", "lo", "sig"])
            k = len(token)
            yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), _signed(token), pa.array(count, pa.int64()), pa.nulls(k, pa.list_(pa.int64()))], names=["doc_id", "n", "hi", "lo", "sig"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, "doc_id long, n long, hi long, lo long, sig array<long>")


def _texts_by_id(docs: DataFrame, reps: DataFrame) -> tuple[DataFrame, str]:
    """The texts that stand for their sets, bucketed by id, and the table's name."""
    ids = reps.select(F.col("rep").alias("id")).distinct()
    return bucketed(docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(ids.hint("merge"), "id"), "id", codec="snappy")


def _verified(pairs: DataFrame, texts: DataFrame, save) -> DataFrame:
    """(a, b) with the exact sizes of intersection and union, from the texts. The texts in question are written once for both sides,
    so that the joins have plain shuffles and a set with very many pairs can be split. pairs: a written table."""

    def measure(batches):
        for batch in batches:
            inter, union = [], []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                s, t = shingle_set(x.as_py()), shingle_set(y.as_py())
                k = len(np.intersect1d(s, t, assume_unique=True))
                inter.append(k), union.append(len(s) + len(t) - k)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(inter, pa.int64()), pa.array(union, pa.int64())], names=["a", "b", "both", "either"])

    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    some = save(texts.join(ids, "id"), "texts")
    first = pairs.select("a", "b").join(some.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
    second = first.join(some.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb")
    return second.mapInArrow(measure, "a long, b long, both long, either long")


def _prefixes(sets: DataFrame, frequent: np.ndarray, num: int, den: int) -> DataFrame:
    """(tok, id, comp, n, df) of each set's prefix in the order of all shingles: the frequent ones last, rarer first. df: a frequent
    shingle's place among them, beyond all lengths of other lists; 0 for others."""
    shared = sets.sparkSession.sparkContext.broadcast(frequent)

    def index(batches):
        known = shared.value
        order = np.argsort(known)
        ranked = known[order]
        toks, ids, comps, ns, dfs = [], [], [], [], []
        held = 0

        def entries():
            out = pa.RecordBatch.from_arrays([_signed(np.concatenate(toks)), *[pa.array(np.concatenate(x)) for x in (ids, comps, ns, dfs)]], names=["tok", "id", "comp", "n", "df"])
            for x in (toks, ids, comps, ns, dfs):
                x.clear()
            return out

        for batch in batches:
            for id_, comp, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                s = shingle_set(text.as_py())
                place = np.zeros(len(s), np.int64)
                if len(ranked) and len(s):
                    at = np.minimum(np.searchsorted(ranked, s), len(ranked) - 1)
                    place = np.where(ranked[at] == s, order[at] + 1, 0)
                    turn = np.argsort(place, kind="stable")
                    s, place = s[turn], place[turn]
                n = len(s)
                p = n - -(-num * n // den) + 1 if n else 0
                toks.append(s[:p].copy()), ids.append(np.full(p, id_, np.int64)), comps.append(np.full(p, comp, np.int64)), ns.append(np.full(p, n, np.int32))
                dfs.append(np.where(place[:p] > 0, place[:p] + _OFTEN, 0))
                held += p
                if held >= ENTRIES:
                    yield entries()
                    held = 0
        if toks:
            yield entries()

    return sets.select("id", "comp", "text").mapInArrow(index, "tok long, id long, comp long, n int, df long")


_OFTEN = 1 << 48


def _by_list(batches, rows: int, work):
    """work on tables of whole index lists, of about `rows` entries; a list that is longer comes as one."""
    held, size = [], 0
    for batch in batches:
        tok = batch.column(0).to_numpy()
        if not len(tok):
            continue
        if size >= rows:
            cut = int(np.searchsorted(tok, tok[-1]))  # the last list may go on
            if cut or held[-1].column(0)[-1].as_py() != tok[0]:
                yield work(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held, size, batch = [], 0, batch.slice(cut)
        held.append(batch)
        size += batch.num_rows
    if held:
        yield work(pa.Table.from_batches(held))


def _shared(table: pa.Table) -> pa.RecordBatch:
    """Entries of the lists that sets of several components are in, with the lists' lengths; frequent shingles stay as they are."""
    tok, comp, often = (table.column(k).to_numpy() for k in (0, 2, 4))
    heads = np.flatnonzero(np.r_[True, tok[1:] != tok[:-1]])
    size = np.diff(np.r_[heads, len(tok)])
    mixed = np.minimum.reduceat(comp, heads) < np.maximum.reduceat(comp, heads)
    keep = np.repeat(mixed, size) | (often > 0)
    cols = [pa.array(table.column(k).to_numpy()[keep]) for k in range(4)] + [pa.array(np.where(often > 0, often, np.repeat(size, size))[keep])]
    return pa.RecordBatch.from_arrays(cols, names=["tok", "id", "comp", "n", "df"])


def need(r, s, num: int, den: int):
    """How many prefix shingles sets of r and s shingles share at least if they link."""
    return np.maximum(1, -(-num * (r + s) // (num + den)) - (-(-num * np.maximum(r, s) // den) - 1))


def list_pairs(tok: np.ndarray, id_: np.ndarray, comp: np.ndarray, n: np.ndarray, q: np.ndarray, m: np.ndarray, home: np.ndarray, num: int, den: int, own: np.ndarray | None = None):
    """Pairs (a < b) of entries of one list and different components that may link. q: the list's place among the m lists of its
    set; a pair shows in the first list that both are in, behind which both have need - 1 more. Of a pair, one at least is at home
    in the list: a guest has come from the next smaller sizes of a split list, where pairs of guests are found. own: the number of an
    entry's group where two groups meet (pairs within either are found elsewhere), -1 where pairs are not so restricted.

    Within a list, entries of one size are a block. Two blocks know what a pair of them needs, and skip all entries whose place is
    too late for it.
    """
    order = np.lexsort((q - m, n, tok))
    own = np.full(len(tok), -1) if own is None else own
    tok, id_, comp, n, room, home, own = tok[order], id_[order], comp[order], n[order].astype(np.int64), (m - q)[order], home[order], own[order]
    heads = np.flatnonzero(np.r_[True, (tok[1:] != tok[:-1]) | (n[1:] != n[:-1])]) if len(tok) else np.empty(0, np.int64)
    ends, size, block_tok = np.r_[heads[1:], len(tok)], n[heads], tok[heads]
    last = np.searchsorted(block_tok, block_tok, side="right")
    best = np.maximum.reduceat(room, heads) if len(heads) else heads
    out, held = [], 0
    x, step = np.arange(len(heads)), 0
    while len(x):
        y = x + step
        wanted = need(size[x], size[y], num, den)
        hit = (best[x] >= wanted) & (best[y] >= wanted) & ((step > 0) | (ends[x] - heads[x] > 1))
        for i, j, w in zip(x[hit].tolist(), y[hit].tolist(), wanted[hit].tolist(), strict=True):
            # room falls within a block
            a = np.arange(heads[i], heads[i] + np.searchsorted(-room[heads[i] : ends[i]], -w, side="right"))
            b = np.arange(heads[j], heads[j] + np.searchsorted(-room[heads[j] : ends[j]], -w, side="right"))
            many = max(1, CELLS // max(1, len(b)))
            for at in range(0, len(a), many):
                some = a[at : at + many]
                good = (comp[some][:, None] != comp[b][None]) & (home[some][:, None] | home[b][None]) & ((own[some][:, None] != own[b][None]) | (own[b][None] < 0))
                if not step:
                    good &= some[:, None] < b[None]
                u, v = np.nonzero(good)
                out.append(np.stack([id_[some[u]], id_[b[v]]], 1))
                held += len(u)
                if held > CELLS:
                    out = [_distinct(out)]
                    held = len(out[0]) // 2  # folded again when twice as many have come
        step += 1
        x = x[x + step < last[x]]
        x = x[num * size[x + step] <= den * size[x]]
    found = _distinct(out)
    return found[:, 0], found[:, 1]


def _distinct(pairs: list[np.ndarray]) -> np.ndarray:
    """Distinct pairs (a < b) of ids."""
    every = np.concatenate(pairs) if pairs else np.empty((0, 2), np.int64)
    if not len(every):
        return every
    low, high = every.min(axis=1), every.max(axis=1)
    order = np.lexsort((high, low))
    low, high = low[order], high[order]
    first = np.r_[True, (low[1:] != low[:-1]) | (high[1:] != high[:-1])]
    return np.stack([low[first], high[first]], 1)


def _candidates(prefixes: DataFrame, num: int, den: int, save, rows: int = 200_000) -> DataFrame:
    """Pairs of sets of different components that share as many prefix shingles as a link needs. Texts of different sizes under one id
    are entries of their own.

    A frequent shingle's entries are dealt by id where its list needn't be seen whole. Where lists are paired, a long one is split
    by powers of den / num: a set is at home among those of its own size and a guest among the next larger ones, so all sets that
    can link with it are met and no list of all sizes comes together. A part with more than BLOCK entries is dealt to groups by id, and
    every two groups, and every group with itself, are a cell that one task pairs.
    """
    dealt = prefixes.withColumn("salt", F.when(F.col("df") > 0, F.col("id")).otherwise(0)).repartition("tok", "salt").sortWithinPartitions("tok").drop("salt")
    shared = dealt.mapInArrow(lambda it: _by_list(it, rows, _shared), "tok long, id long, comp long, n int, df long")
    shared = save(shared.groupBy("id", "n", "tok").agg(F.min("comp").alias("comp"), F.min("df").alias("df")), "shared")
    lists = shared.groupBy("id", "n").agg(F.first("comp").alias("comp"), F.array_sort(F.collect_list(F.struct("df", "tok"))).alias("toks"), F.sum((F.col("df") < LONG).cast("int")).alias("short"))
    lists = save(lists.withColumn("toks", F.transform("toks", lambda t: t["tok"])), "lists")
    save.remove(shared)
    entry = lists.select("id", "comp", "n", F.size("toks").alias("m"), "short", F.posexplode("toks").alias("q", "tok"))
    level = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(den / num)) + 1e-9)
    columns = ["tok", "id", "comp", "n", "q", "m", "home", "own"]
    whole = entry.where("q < short").withColumns({"home": F.lit(True), "own": F.lit(-1)}).select(columns)
    sides = F.array(*[F.struct(F.xxhash64("tok", level + k).alias("t"), F.lit(k == 0).alias("home")) for k in (0, 1)])
    parts = entry.where("q >= short").withColumn("at", F.explode(sides)).select(F.col("at.t").alias("tok"), "id", "comp", "n", "q", "m", "at.home")
    large = save(parts.groupBy("tok").agg(F.count("*").alias("size")).where(F.col("size") > BLOCK), "large")
    groups = F.coalesce(F.ceil(F.col("size") / BLOCK), F.lit(1).cast("long")).cast("int")
    dealt = parts.join(large, "tok", "left").withColumn("groups", groups).withColumn("group", F.pmod(F.xxhash64("id", "n"), F.col("groups")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    cell = F.when(F.col("groups") == 1, F.col("tok")).otherwise(F.xxhash64("tok", F.least("group", "other"), F.greatest("group", "other")))
    dealt = dealt.withColumns({"own": F.when(F.col("group") == F.col("other"), F.lit(-1)).otherwise(F.col("group")), "tok": cell})
    # In a cell of two groups an entry's own group is named; a group met with itself is a cell of its own.
    placed = whole.unionByName(dealt.select(columns))

    def pairs(table: pa.Table) -> pa.RecordBatch:
        cols = [table.column(k).to_numpy() for k in range(8)]
        a, b = list_pairs(*cols[:7], num, den, cols[7])
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    found = placed.repartition("tok").sortWithinPartitions("tok").mapInArrow(lambda it: _by_list(it, rows, pairs), "a long, b long").distinct()
    left, right = (lists.select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("toks").alias(f"t{x}")) for x in "ab")
    wanted = F.greatest(F.lit(1), F.ceil(num * (F.col("na") + F.col("nb")) / (num + den) - 1e-9) - F.ceil(num * F.greatest("na", "nb") / den - 1e-9) + 1)
    return found.join(left, "a").join(right, "b").where(F.size(F.array_intersect("ta", "tb")) >= wanted).select("a", "b").distinct()


def _least_overlap(x: str, y: str, num: int, den: int) -> str:
    """The fewest shingles that linked sets of x and y shingles share."""
    return f"(({num} * ({x} + {y}) + {num + den - 1}) div {num + den})"


def _links(pairs: DataFrame, reps: DataFrame, members: DataFrame, texts: DataFrame, num: int, den: int, save) -> DataFrame:
    """The pairs (a, b) that link, but for those that a link between their leaders implies.

    members: (a, b, both, either) of sets and the leaders that they link with. Where a member has d shingles that its leader
    lacks, and lacks e of the leader's, its overlap with any set is at most d more and e less than the leader's. Pairs without a
    member are measured from texts. For the others the leaders' overlap, or that they were no candidates and so share too little,
    decides within these bounds; what stays open is measured too. Ids with several sets are no members and have no bounds, so
    their pairs are always measured.
    """
    link = f"{den} * both >= {num} * either"
    sizes = reps.groupBy(F.col("rep").alias("id")).agg(F.max("n").alias("n"), F.count("*").alias("sets")).where("sets = 1").drop("sets")
    # Leaders that follow no other and have one set: chosen among distinct ones, so that one with very many members is one row here.
    firm = members.select("b").distinct().join(members.select(F.col("a").alias("b")).distinct(), "b", "left_anti").join(sizes.select(F.col("id").alias("b")), "b", "left_semi")
    leads = members.join(save(firm, "firm"), "b").select(F.col("a").alias("id"), F.col("b").alias("lead"), "both", "either")
    known = sizes.join(leads, "id", "left").selectExpr("id", "n", "lead", "n - both d", "either - n e")
    known = save(known, "known")
    side = lambda x: known.select(F.col("id").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("n", "lead", "d", "e")])
    wide = save(pairs.join(side("a"), "a", "left").join(side("b"), "b", "left"), "wide")
    answers = save(_verified(wide.where("lead_a is null and lead_b is null"), texts, save), "answers")

    derived = wide.where("lead_a is not null or lead_b is not null")
    derived = derived.selectExpr("a", "b", "n_a", "n_b", "coalesce(d_a, 0) + coalesce(d_b, 0) d", "coalesce(e_a, 0) + coalesce(e_b, 0) e", "n_a - coalesce(d_a, 0) + coalesce(e_a, 0) n_u", "n_b - coalesce(d_b, 0) + coalesce(e_b, 0) n_v",
                                 "least(coalesce(lead_a, a), coalesce(lead_b, b)) u", "greatest(coalesce(lead_a, a), coalesce(lead_b, b)) v")
    of = answers.groupBy(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).agg(F.max("both").alias("shared"), F.max(F.expr(link)).alias("linked"))
    wanted, leaders = _least_overlap("n_a", "n_b", num, den), _least_overlap("n_u", "n_v", num, den)
    derived = derived.join(of, ["u", "v"], "left").selectExpr("a", "b", f"{wanted} wanted", f"coalesce(shared, {leaders} - 1) + d most", "shared - e least", "coalesce(linked, false) linked")
    derived = save(derived.where("not linked and coalesce(most >= wanted, true)"), "derived")  # an id with several sets has no bounds
    sure = derived.where("least >= wanted").select("a", "b")
    read = _verified(derived.where("not coalesce(least >= wanted, false)"), texts, save).where(link).select("a", "b")
    return answers.where(link).select("a", "b").unionByName(sure).unionByName(read)


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest id that links reach. Large and small stars in turn until nothing changes."""
    edges = durable(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.selectExpr("v as u", "u as v"))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(lowest, "u").selectExpr("v as u", "m as v").where("u <> v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").selectExpr("case when v = m then u else v end u", "m v").where("u <> v").distinct()
        edges = durable(small, "edges")
        now = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.lit(0))).first()
        if now == state:
            return edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
        state = now


def similar_groups(docs: DataFrame, num: int = 3, den: int = 4, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row, where texts link at a Jaccard similarity of num / den or more.

    Every link between different sets is found or implied by others, so components are exact. Null, empty and blank texts
    have no shingles and link with nothing. Rows with one doc_id count as linked. A row without doc_id links with nothing
    and has no component. Other columns are ignored; an empty table gives an empty result.
    """
    save = Tables()
    link = f"{den} * both >= {num} * either"
    sketches = save(_sketches(docs), "sketches")
    rows = sketches.where("n is not null")
    common = sketches.where("n is null").groupBy("hi").agg(F.sum("lo").alias("k")).where("k >= 8").orderBy(F.desc("k"), "hi").limit(frequent)
    last = np.array([r[0] for r in common.select("hi").collect()], np.int64)[::-1].view(np.uint64)

    linked = rows.where("n > 0 and doc_id is not null")
    reps = save(linked.groupBy("hi", "lo").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig")), "reps")
    texts, name = _texts_by_id(docs, reps)

    points = reps.select("rep", F.size("sig").alias("k"), F.explode("sig").alias("tok"))
    # Written first, so that the join has two plain shuffles (or a broadcast, if few are shared) and a hot shingle can be split.
    leaders = save(points.groupBy("tok").agg(F.min("rep").alias("leader"), F.count("*").alias("m")).where("m > 1").select("tok", "leader"), "leaders")
    votes = points.join(leaders, "tok").where("rep <> leader").groupBy("rep", "leader").agg(F.count("*").alias("votes"), F.max("k").alias("k")).where("votes >= 3 or 2 * votes >= k")
    chosen = save(votes.groupBy("rep").agg(F.expr("max_by(leader, struct(votes, -leader))").alias("b")).withColumnRenamed("rep", "a"), "chosen")
    members = save(_verified(chosen, texts, save).where(link).groupBy("a", "b").agg(F.max("both").alias("both"), F.min("either").alias("either")), "members")
    near = members.select("a", "b")
    known = components(near)
    sets = texts.join(known.withColumnRenamed("node", "id"), "id", "left").select("id", F.coalesce("component", "id").alias("comp"), "text")
    pairs = save(_candidates(_prefixes(sets, last, num, den), num, den, save), "pairs")
    found_links = _links(pairs, reps, members, texts, num, den, save)

    classes = linked.select("doc_id", "hi", "lo").join(reps.select("hi", "lo", "rep"), ["hi", "lo"])
    twice = classes.where("doc_id <> rep").join(reps.select(F.col("rep").alias("doc_id")).distinct(), "doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    found = components(near.unionByName(found_links).unionByName(twice))
    forget(docs.sparkSession, name, files=True)  # the classes are written
    save.remove_but(sketches, reps)

    named = rows.select("doc_id", F.col("n").alias("n_shingles"), "hi", "lo").join(reps.select("hi", "lo", "rep"), ["hi", "lo"], "left")
    named = named.join(found, named["rep"] == found["node"], "left")
    own = F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.coalesce("component", "rep")).otherwise(F.col("doc_id"))
    return named.select("doc_id", "n_shingles", own.alias("component_id"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
