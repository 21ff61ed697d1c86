"""Best-fit packing of tokenised documents by the sum-of-squares rule."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sakuin.llm.shared import durable
from sakuin.llm.tokens import encoder

CAPACITY = 1024
END = 2
GROUP = 16_384  # pieces that one task places together, on average
ROUNDS = 64  # lots of sequences that a group packs once more
LOT = 24  # sequences of a lot, beside the emptiest


def sum_of_squares(sizes: np.ndarray, capacity: int, eager: bool = False) -> np.ndarray:
    """Bin number of each item, placed in the given order.

    With n[g] open bins of residual gap g, an item goes where the sum of n[g]^2 over 0 < g < capacity becomes smallest; of equal
    places the tightest one. A new bin is opened where no open one has room, or, if `eager`, also where that is better than all.
    """
    n = np.zeros(capacity + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    out, bins, far = np.empty(len(sizes), np.int64), 0, 1 << 40
    for k, s in enumerate(sizes.tolist()):
        best, gap = far, 0
        if n[s]:
            best, gap = 1 - 2 * int(n[s]), s
        if s < capacity - 1:
            change = np.where(n[s + 1 : capacity] > 0, 2 * (n[1 : capacity - s] - n[s + 1 : capacity]) + 2, far)
            at = int(change.argmin())
            if change[at] < best:
                best, gap = int(change[at]), s + 1 + at
        if not gap or (eager and (2 * int(n[capacity - s]) + 1 if s < capacity else 0) < best):
            place, gap, bins = bins, capacity, bins + 1
        else:
            n[gap] -= 1
            place = stacks[gap].pop()
        out[k] = place
        if gap > s:
            n[gap - s] += 1
            stacks[gap - s].append(place)
    return out


def fill(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins (lists of positions): each takes the largest item that is left and the subset of the others that fills it best."""
    rest, out = sorted(range(len(sizes)), key=lambda k: -sizes[k]), []
    while rest:
        room, reach, before = capacity - sizes[rest[0]], 1, []
        for k in rest[1:]:  # bit g of reach: a subset so far has size g
            before.append(reach)
            reach |= (reach << sizes[k]) & ((1 << room + 1) - 1)
            if reach >> room:
                break
        at, taken = reach.bit_length() - 1, {rest[0]}
        for k, held in zip(reversed(rest[1 : len(before) + 1]), reversed(before), strict=True):
            if not held >> at & 1:
                taken.add(k)
                at -= sizes[k]
        out.append(sorted(taken))
        rest = [k for k in rest if k not in taken]
    return out


def pack(sizes: np.ndarray, capacity: int, rounds: int = ROUNDS, lot: int = LOT) -> np.ndarray:
    """Bin number of each item: all by the sum of squares, largest first; then the items of the emptiest bins and of `lot` others
    are filled anew, lot by lot, as long as that takes no more bins and gathers the room that is left in fewer of them."""
    order = np.argsort(-sizes, kind="stable")
    place = np.empty(len(sizes), np.int64)
    place[order] = sum_of_squares(sizes[order], capacity)
    chance, least = np.random.default_rng(len(sizes)), -(-int(sizes.sum()) // capacity)
    for _ in range(rounds):
        load = np.bincount(place, weights=sizes).astype(np.int64)
        if len(load) <= least:
            break
        some = np.unique(np.r_[np.argsort(load, kind="stable")[:8], chance.integers(0, len(load), lot)])
        items = np.flatnonzero(np.isin(place, some))
        bins = fill(sizes[items].tolist(), capacity)
        room = sum((capacity - int(sizes[items[b]].sum())) ** 2 for b in bins) + (len(some) - len(bins)) * capacity**2
        if len(bins) <= len(some) and room >= int(((capacity - load[some]) ** 2).sum()):
            for number, b in zip(some.tolist(), bins, strict=False):
                place[items[b]] = number
            place = np.unique(place, return_inverse=True)[1]
    return place


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Each document's ids and the end id, cut into pieces of at most `capacity`; where a document is longer,
    its first piece takes the remainder, so that at most one piece of a document is not full."""

    def cut(batches):
        encode, last = encoder(), np.array([end], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encode(text) + last
                n = len(ids) // 4
                start, stop, k = 0, n % capacity or min(n, capacity), 0
                while start < n:
                    rows.append((doc_id, k, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop])))
                    start, stop, k = stop, stop + capacity, k + 1
            cols = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(cut, _PIECES)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, end: int = END, group: int = GROUP) -> DataFrame:
    """Pack all documents into sequences of at most `capacity` tokens.

    Full pieces are sequences of their own. The others are dealt at random into groups of about `group`, and each
    group is packed by `pack`; the group count grows with the table, so a task's share does not. A group leaves
    only a few bins open, so more groups cost almost no room.

    Null or empty text: one piece that holds the end id. Repeated rows are packed each for itself. A null doc_id
    is kept. An empty table gives an empty result. Other columns of `docs` are ignored.
    """
    pieces = durable(token_pieces(docs, capacity, end), "pieces")
    whole = pieces.where(F.col("length") == capacity)
    part = pieces.where(F.col("length") < capacity)
    groups = max(1, -(-part.count() // group))
    packed = "group long, " + _PIECES + ", sequence_id long, offset long"

    def place(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "descending") for c in ("length", "doc_id", "ids_crc32", "piece")])
        sizes = table.column("length").to_numpy()
        place = pack(sizes, capacity)
        order = np.argsort(place, kind="stable")
        before = np.cumsum(sizes[order]) - sizes[order]
        first = np.r_[True, np.diff(place[order]) != 0]
        offset = np.empty(len(sizes), np.int64)
        offset[order] = before - before[first][np.cumsum(first) - 1]
        base = table.column("group").to_numpy() << 32
        return table.append_column("sequence_id", pa.array((base + place) * 2 + 1)).append_column("offset", pa.array(offset))

    dealt = part.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    mixed = dealt.select("group", *pieces.columns).groupBy("group").applyInArrow(place, packed).drop("group")
    alone = whole.withColumns({"sequence_id": F.monotonically_increasing_id() * 2, "offset": F.lit(0).cast("long")})
    return mixed.unionByName(alone)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
