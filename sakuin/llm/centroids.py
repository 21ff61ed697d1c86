"""Exact k-means on integer vectors, with Drake's adaptive bounds.

Each vector keeps an upper bound of the distance to its centroid, lower bounds of the distances to the few centroids that came
next, and one lower bound for all others. When centroids move, bounds move by as much. The centroid is certified where the upper
bound is below all lower bounds; where only the first lower bounds are in question, these centroids alone are measured; and where
even the bound of all others is, the vector is measured against every centroid. Distances are whole numbers and bounds are rounded
outwards, so a certified order is exact, ties included (a tie is never certified).
"""

from __future__ import annotations

import hashlib
import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sakuin.llm.shared import discard, shared_dir

DIMENSIONS = 64
CLUSTERS = 8
ROUNDS = 10
SEED = 3
SCALE = 1024
LIMIT = 1 << 26  # components beyond it (65,536 before scaling) count as it, so that squared distances fit in a long
_STATE = "vec_id long, x array<int>, cluster int, upper float, near array<int>, lower array<float>, distance long"
_SUMS = "part int, members long, rank int, measured long, sums array<long>"


def integers(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, x) of the vectors with exactly so many components, none null or non-finite; x: floor(scale * component)."""
    value = F.col("embedding").cast("array<double>")
    sound = (F.size(value) == dimensions) & F.forall(value, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    bounded = lambda v: F.floor(F.greatest(F.lit(-float(LIMIT)), F.least(F.lit(float(LIMIT)), scale * v))).cast("int")
    return vectors.where(F.coalesce(sound, F.lit(False))).select(F.col("vec_id").cast("long"), F.transform(value, bounded).alias("x"))


def first_centroids(rows: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors whose ids have the smallest hashes; vectors of one id in order of their components."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    return np.array([r["x"] for r in rows.orderBy(mark, "x").limit(clusters).collect()], np.int64)


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def _squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = x - c
    return np.einsum("...i,...i->...", d, d)


def assign(x: np.ndarray, centroids: np.ndarray, width: int, held: tuple | None = None, moves: np.ndarray | None = None):
    """Nearest centroids (ties: the smaller number) and new bounds of whole-number vectors.

    held: cluster, upper, near, lower of the round before, moves: how far each centroid has moved since. Returns cluster, upper, near
    (n x width), lower (n x (width + 1), the last for all others), the highest rank of a lower bound that was in question without
    a full scan, and how many distances were measured.
    """
    n, k = len(x), len(centroids)
    width = min(width, k - 1)
    if held is None:
        cluster, upper = np.zeros(n, np.int32), np.full(n, np.inf, np.float32)
        near, lower = np.zeros((n, width), np.int32), np.full((n, width + 1), -np.inf, np.float32)
    else:
        cluster, upper, near, lower = held
        cluster, near = cluster.copy(), near[:, :width].copy()
        upper = _up(upper.astype(np.float64) + moves[cluster])
        drop = np.concatenate([moves[held[2]], np.full((n, 1), moves.max())], axis=1)
        lower = _down(np.where(np.isinf(lower), lower, lower.astype(np.float64) - drop))
        lower = np.minimum.accumulate(lower[:, ::-1], axis=1)[:, ::-1][:, : width + 1].copy()  # a bound holds for all ranks behind it too
    measured, rank = 0, 0
    rows = np.flatnonzero(upper >= lower[:, 0])
    if held is not None and len(rows):
        upper[rows] = _up(np.sqrt(_squared(x[rows], centroids[cluster[rows]]).astype(np.float64)))
        measured += len(rows)
        rows = rows[upper[rows] >= lower[rows, 0]]
    doubt = (lower[rows] <= upper[rows, None]).sum(axis=1)
    for z in range(1, width + 1):
        some = rows[doubt == z]
        if len(some):
            names = np.sort(np.concatenate([cluster[some, None], near[some, :z]], axis=1), axis=1)
            d = _squared(x[some, None], centroids[names])
            turn = np.argsort(d, axis=1, kind="stable")
            names, d = np.take_along_axis(names, turn, 1), np.sqrt(np.take_along_axis(d, turn, 1).astype(np.float64))
            cluster[some], upper[some], near[some, :z], lower[some, :z] = names[:, 0], _up(d[:, 0]), names[:, 1:], _down(d[:, 1:])
            measured, rank = measured + len(some) * z, z
    some = rows[doubt > width]
    if len(some):
        d = np.stack([_squared(x[some], c) for c in centroids], axis=1)
        turn = np.argsort(d, axis=1, kind="stable").astype(np.int32)
        d = np.sqrt(np.take_along_axis(d, turn, 1).astype(np.float64))
        cluster[some], upper[some], near[some] = turn[:, 0], _up(d[:, 0]), turn[:, 1 : width + 1]
        lower[some, :width] = _down(d[:, 1 : width + 1])
        lower[some, width] = _down(d[:, width + 1]) if width + 1 < k else np.inf
        measured += len(some) * k
    return cluster, upper, near, lower, rank, measured


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, m = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * m + 1, m) if m else np.zeros(n + 1, np.int64), pa.int32()), pa.array(np.ascontiguousarray(values).ravel(), kind))


def _matrix(column: pa.ListArray, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), -1)


def _round(centroids: np.ndarray, width: int, moves: np.ndarray | None, last: bool):
    """A task's work: its vectors with new bounds, and as last rows what it changes in the sums of clusters."""
    k, dimensions = centroids.shape
    names = [c.split()[0] for c in f"{_STATE}, {_SUMS}".split(", ")]
    kinds = [pa.int64(), pa.list_(pa.int32()), pa.int32(), pa.float32(), pa.list_(pa.int32()), pa.list_(pa.float32()), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64())]

    def work(batches):
        members, sums, rank, measured = np.zeros(k, np.int64), np.zeros((k, dimensions), np.int64), 0, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = _matrix(batch.column(1), np.int64)
            held = None
            if moves is not None:
                held = batch.column(2).to_numpy(), batch.column(3).to_numpy(), _matrix(batch.column(4), np.int32), _matrix(batch.column(5), np.float32)
            cluster, upper, near, lower, most, some = assign(x, centroids, width, held, moves)
            rank, measured = max(rank, most), measured + some
            moved = np.ones(n, bool) if held is None else cluster != held[0]
            for c in np.unique(cluster[moved]):
                mine = moved & (cluster == c)
                members[c], sums[c] = members[c] + mine.sum(), sums[c] + x[mine].sum(axis=0)
            if held is not None:
                for c in np.unique(held[0][moved]):
                    mine = moved & (held[0] == c)
                    members[c], sums[c] = members[c] - mine.sum(), sums[c] - x[mine].sum(axis=0)
            distance = pa.array(_squared(x, centroids[cluster])) if last else pa.nulls(n, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cluster, pa.int32()), pa.array(upper), _lists(near, pa.int32()), _lists(lower, pa.float32()), distance, *[pa.nulls(n, t) for t in kinds[7:]]], names=names)
        yield pa.RecordBatch.from_arrays([*[pa.nulls(k, t) for t in kinds[:7]], pa.array(np.arange(k), pa.int32()), pa.array(members), pa.array(np.full(k, rank), pa.int32()), pa.array(np.where(np.arange(k), 0, measured)), _lists(sums, pa.int64())], names=names)

    return work


def cluster(vectors: DataFrame, dimensions: int = DIMENSIONS, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, scale: int = SCALE, bounds: int | None = None) -> tuple[DataFrame, np.ndarray, list[dict]]:
    """(vec_id, cluster, distance) of all kept vectors, the final centroids and, per round, how many distances were measured.

    A round reads the table of the one before and writes its own with the vectors, their bounds and, in rows of its own, what each
    task changes in the sums of clusters: no row moves between tasks, only sums of clusters come to the driver. A table goes when
    the next one is there. bounds: lower bounds of single centroids that a vector holds at first (a quarter of the clusters, four at least);
    from round to round they become as few as were in question, an eighth of the clusters and two at least. Rounds end early when no centroid moves, which changes nothing.

    Null and non-finite components, other lengths and null vectors are left out. Repeated ids and vectors are rows of their own; a
    null id stays null. With fewer vectors than clusters each is a centroid; none give an empty table. Other columns are ignored.
    """
    spark = vectors.sparkSession
    path = f"{shared_dir(spark)}/centroids-{uuid.uuid4().hex}"
    integers(vectors, dimensions, scale).write.parquet(f"{path}/vectors")
    state = spark.read.schema("vec_id long, x array<int>").parquet(f"{path}/vectors")
    centroids = first_centroids(state, clusters, seed)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), centroids, []
    k = len(centroids)
    least = max(2, math.ceil(k / 8))
    width, moves, report = max(bounds or max(4, math.ceil(k / 4)), least), None, []
    members, sums = np.zeros(k, object), np.zeros((k, dimensions), object)
    for turn in range(rounds + 1):
        last = turn == rounds or (moves is not None and not moves.any())
        state.mapInArrow(_round(centroids, width, moves, last), f"{_STATE}, {_SUMS}").write.parquet(f"{path}/{turn}")
        discard(spark, f"{path}/{turn - 1}" if turn else f"{path}/vectors")
        written = spark.read.schema(f"{_STATE}, {_SUMS}").parquet(f"{path}/{turn}")
        state = written.where("part is null").select(*[c.split()[0] for c in _STATE.split(", ")])
        wide = lambda c: F.sum(c.cast("decimal(38,0)"))
        changes = written.where("part is not null").groupBy("part").agg(wide(F.col("members")).alias("members"), F.max("rank").alias("rank"), F.sum("measured").alias("measured"), *[wide(F.col("sums")[i]).alias(f"s{i}") for i in range(dimensions)]).collect()
        for r in changes:
            members[r["part"]] += int(r["members"])
            sums[r["part"]] += np.array([int(r[f"s{i}"]) for i in range(dimensions)], object)
        report.append({"round": turn, "measured": sum(r["measured"] for r in changes), "rows": sum(members), "width": width})
        if last:
            break
        new = np.array([[int(s // n) for s in row] if n else old for row, n, old in zip(sums, members, centroids.tolist(), strict=True)], np.int64)
        moves = np.sqrt(_squared(new, centroids).astype(np.float64)) * (1 + 2.0**-40)
        centroids = new
        width = min(width, max(least, *(r["rank"] for r in changes))) if turn else width
    return state.select("vec_id", "cluster", "distance"), centroids, report


def _by_cluster(values: list) -> Column:
    return F.element_at(F.array(*values), F.col("cluster") + 1)


def with_totals(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The clusters' and the overall sum of squared distances (null beyond a long), and a hash of each row's centroid."""
    if not len(centroids):
        return found.selectExpr("*", "cast(null as long) cluster_inertia", "cast(null as long) inertia", "cast(null as string) centroid_sha256")
    sums = dict(found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect())
    fits = lambda v: F.lit(v if v < 1 << 63 else None).cast("long")
    inertia = [fits(int(sums.get(c, 0))) for c in range(len(centroids))]
    marks = [F.lit(hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for c in centroids.tolist()]
    return found.select("*", _by_cluster(inertia).alias("cluster_inertia"), fits(int(sum(sums.values()))).alias("inertia"), _by_cluster(marks).alias("centroid_sha256"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids, _ = cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return with_totals(found, centroids)


def _sql() -> str:
    """The same by plain rounds over all pairs of vector and centroid."""
    kept = f"len(embedding) = {DIMENSIONS} and list_bool_and(list_transform(embedding, lambda v: v is not null and isfinite(v)))"
    parts = [
        f"v as materialized (select vec_id, list_transform(embedding, lambda v: cast(floor({SCALE} * cast(v as double)) as bigint)) x from embeddings where {kept})",
        f"c0 as materialized (select row_number() over (order by h) - 1 j, x c from (select x, sha256('{SEED}:' || vec_id) h from v order by h limit {CLUSTERS}))",
    ]
    for t in range(ROUNDS + 1):
        parts.append(f"a{t} as materialized (select vec_id, any_value(x) x, min(row(d, j)) m from (select vec_id, x, j, cast(list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as bigint) d from v, c{t}) group by vec_id)")
        if t < ROUNDS:
            parts.append(f"s{t} as (select j, i, cast(sum(y) as bigint) s, count(*) n from (select m[2] j, unnest(x) y, generate_subscripts(x, 1) i from a{t}) group by j, i)")
            parts.append(f"n{t} as (select j, list((s - ((s % n + n) % n)) // n order by i) c from s{t} group by j)")
            parts.append(f"c{t + 1} as materialized (select c{t}.j, coalesce(n{t}.c, c{t}.c) c from c{t} left join n{t} on n{t}.j = c{t}.j)")
    t = ROUNDS
    return f"""with {', '.join(parts)}
select vec_id, cast(m[2] as integer) as cluster, cast(m[1] as bigint) as distance, cast(sum(m[1]) over (partition by m[2]) as bigint) as cluster_inertia,
       cast(sum(m[1]) over () as bigint) as inertia, sha256(array_to_string(c, ',')) as centroid_sha256
from a{t} join c{t} on c{t}.j = m[2]"""


OP13_SQL = _sql()
