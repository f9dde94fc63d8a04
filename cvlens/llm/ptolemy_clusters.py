"""Centroid clustering in whole numbers, with Ptolemaic lower bounds over fixed pivot pairs.

Vectors become whole numbers (``floor(scale * x)``); Lloyd's rounds then are
exact: squared distances and floored means are integers, so neither the order
of the rows nor their partitioning changes a result.

* Pivots: fixed vectors, chosen farthest first from a documented sample
  (``PIVOT_SAMPLE`` rows by hash). The squared distance of every vector to every
  pivot is stored beside the vector, once.
* Bound: for pivots p, s and centroid c Ptolemy's inequality gives
  ``|x c| >= | |x p| |c s| - |x s| |c p| | / |p s|``. The largest over all pairs is
  kept, after each is lowered by more than its rounding error.
* Centroids are checked exactly (64-bit integers) in the order of their bounds,
  until the next bound passes the least distance found. A bound equal to it is
  checked too, so ties go to the smaller number.

Vectors that are null, of another length than ``dims``, or hold null or
non-finite components take no part; neither do those with a scaled component
of 2^27 or more in size, whose squared distances do not fit a long. A null
``vec_id`` is clustered like others but starts no centroid as long as others
can. Repeated rows count each time; equal starting vectors are centroids of
their own, of which the smaller number gets the vectors and the other stays. Fewer
vectors than ``k``: as many centroids as vectors. An empty table gives an
empty result. Columns beside the identifier and the vector are not read.

Scale: one stored table of vectors, one pass a round, per-task sums of ``k``
rows; the driver holds ``k`` centroids and the pivots.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cvlens.llm.common import free_caches, written

PIVOTS = 6
PIVOT_SAMPLE = 256
LARGEST = 1 << 27
BATCH = 4096
# Relative error allowed to products, quotients and roots of doubles; each of the few steps errs by 2^-53 at most.
SLACK = 2.0 ** -44

_INTS = "vec_id long, v array<int>"


def whole_numbers(batch, dims: int, scale: float):
    """(ids, int64 matrix) of the vectors of an Arrow batch (vec_id, vector) that take part."""
    import pyarrow as pa
    import pyarrow.compute as pc
    ids, vectors = batch.column(0), batch.column(1)
    fits = pc.equal(pc.fill_null(pc.list_value_length(vectors), -1), dims)
    ids, vectors = ids.filter(fits), vectors.filter(fits)
    flat = vectors.flatten()
    x = pc.fill_null(flat.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False).reshape(-1, dims)
    with np.errstate(invalid="ignore", over="ignore"):
        x = np.floor(x * scale)
        fine = (np.abs(x) < LARGEST).all(1)
    return ids.filter(pa.array(fine)), x[fine].astype(np.int64)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``x`` to all of ``y``, in integers."""
    return np.stack([((x - row) ** 2).sum(1) for row in y], 1) if len(y) else np.zeros((len(x), 0), np.int64)


def choose_pivots(sample: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Up to ``n`` different rows: the first, then always the one farthest from those chosen."""
    if not len(sample):
        return sample
    chosen, nearest = [0], squared(sample, sample[:1])[:, 0]
    while len(chosen) < n and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squared(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


def lower_bounds(to_pivots: np.ndarray, centroid_pivots: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Squared lower bounds of the distances of vectors to centroids, from their squared pivot distances."""
    a, c = np.sqrt(to_pivots.astype(float)), np.sqrt(centroid_pivots.astype(float))
    between = np.sqrt(squared(pivots, pivots).astype(float))
    low = np.zeros((len(a), len(c)))
    for i, j in combinations(range(len(pivots)), 2):
        u, w = a[:, i, None] * c[None, :, j], a[:, j, None] * c[None, :, i]
        np.maximum(low, (np.abs(u - w) - (u + w) * SLACK) / between[i, j], out=low)
    return low * low * (1 - SLACK)


def assign(x: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest centroid, squared distance, exact distances computed); ties go to the smaller number."""
    low = lower_bounds(to_pivots, squared(centroids, pivots), pivots)
    order = np.argsort(low, 1, kind="stable")
    who = order[:, 0].copy()
    best = ((x - centroids[who]) ** 2).sum(1)
    active, computed = np.arange(len(x)), len(x)
    for step in range(1, len(centroids)):
        active = active[low[active, order[active, step]] <= best[active]]
        if not len(active):
            break
        to = order[active, step]
        d = ((x[active] - centroids[to]) ** 2).sum(1)
        computed += len(active)
        better = (d < best[active]) | ((d == best[active]) & (to < who[active]))
        rows = active[better]
        best[rows], who[rows] = d[better], to[better]
    return who, best, computed


def _matrices(batches, dims: int):
    """(ids, vectors, squared pivot distances) of the stored table, in slices of bounded size."""
    for b in batches:
        for at in range(0, b.num_rows, BATCH):
            s = b.slice(at, BATCH)
            x = s.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.int64)
            yield s.column(0), x, s.column(2).flatten().to_numpy(zero_copy_only=False).reshape(s.num_rows, -1)


def _start(ints: DataFrame, k: int, seed: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``k`` vectors in the order of ``sha256("seed:vec_id")``, and pivots chosen from the ones after."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = ints.withColumn("_h", name).orderBy(F.col("_h").asc_nulls_last(), "v").limit(k + PIVOT_SAMPLE).select("v").collect()
    x = np.array([r.v for r in rows], np.int64).reshape(len(rows), dims)
    return x[:k], choose_pivots(x[k:] if len(x) > k else x)


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: float = 256.0, seed: int = 2,
            id_col: str = "vec_id", col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance) of every vector that takes part, final centroids)."""
    def scaled(batches):
        import pyarrow as pa
        free_caches()
        for b in batches:
            ids, x = whole_numbers(b, dims, scale)
            flat = pa.array(x.astype(np.int32).ravel())
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, dims, dtype=np.int32), flat)], ["vec_id", "v"])

    given = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(col).cast("array<double>").alias("x"))
    ints = given.mapInArrow(scaled, _INTS)
    centroids, pivots = _start(ints, k, seed, dims)

    def measured(batches):
        import pyarrow as pa
        for b in batches:
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.int64)
            d = squared(x, pivots)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.ListArray.from_arrays(
                np.arange(0, d.size + 1, max(1, len(pivots)), dtype=np.int32)[:len(x) + 1], pa.array(d.ravel()))], ["vec_id", "v", "d"])

    points = written(ints.mapInArrow(measured, _INTS + ", d array<long>"), "vectors-pivots")
    for _ in range(rounds if len(centroids) else 0):
        centroids = _means(points, centroids, pivots, dims)

    def last(batches):
        import pyarrow as pa
        for ids, x, d in _matrices(batches, dims):
            who, dist, _ = assign(x, d, centroids, pivots)
            yield pa.RecordBatch.from_arrays([ids, pa.array(who.astype(np.int32)), pa.array(dist)], ["vec_id", "cluster", "distance"])

    return points.mapInArrow(last, "vec_id long, cluster int, distance long"), centroids


def _means(points: DataFrame, centroids: np.ndarray, pivots: np.ndarray, dims: int) -> np.ndarray:
    """The centroids after one round: floored means of the vectors nearest to each; empty ones stay."""
    k = len(centroids)

    def partial(batches):
        import pyarrow as pa
        n, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for _, x, d in _matrices(batches, dims):
            who, _, _ = assign(x, d, centroids, pivots)
            by = np.argsort(who, kind="stable")
            first = np.flatnonzero(np.diff(who[by], prepend=-1))
            sums[who[by][first]] += np.add.reduceat(x[by], first, axis=0)
            n += np.bincount(who, minlength=k)
        own = np.flatnonzero(n)
        flat = pa.array(sums[own].ravel())
        yield pa.RecordBatch.from_arrays([
            pa.array(own.astype(np.int32)), pa.array(n[own]),
            pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, dims, dtype=np.int32), flat)], ["cluster", "n", "s"])

    parts = points.mapInArrow(partial, "cluster int, n long, s array<long>")
    total = (parts.select("cluster", "n", F.posexplode("s").alias("at", "s")).groupBy("cluster", "at")
             .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())
    out = centroids.copy()
    for r in total:  # at most k * dims rows
        out[r.cluster, r.at] = int(r.s) // r.n
    return out


def cluster_digests(vectors: DataFrame, **settings) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector that takes part."""
    found, centroids = cluster(vectors, **settings)
    found = written(found, "clusters")
    spark = vectors.sparkSession
    sums = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    whole = sum(sums.values())
    rows = [(i, sums.get(i, 0), whole, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest())
            for i, c in enumerate(centroids)]
    known = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # one row per centroid: at most k
    return found.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle_sql(k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: int = 2) -> str:
    """DuckDB spelling of ``cluster_digests`` over ``embeddings``."""
    def nearest(r):
        return f"""a{r} AS MATERIALIZED (SELECT rid, vec_id, v, min_by(cluster, d) AS cluster, min(d).q AS distance FROM (
          SELECT rid, vec_id, x.v AS v, c.cluster, struct_pack(q := list_sum(list_transform(range(1, {dims + 1}),
            lambda i: (x.v[i] - c.v[i]) * (x.v[i] - c.v[i])))::BIGINT, c := c.cluster) AS d
          FROM kept x CROSS JOIN c{r} c) GROUP BY rid, vec_id, v)"""
    parts = [f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id,
          list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
        WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims})""",
             f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS cluster, v FROM (
          SELECT v, sha256('{seed}:' || vec_id) AS h FROM kept) ORDER BY h NULLS LAST, v LIMIT {k})"""]
    for r in range(rounds):
        parts.append(nearest(r))
        parts.append(f"""m{r} AS MATERIALIZED (SELECT cluster, list(m ORDER BY i) AS v FROM (
          SELECT cluster, i, (s - ((s % n) + n) % n) // n AS m FROM (
            SELECT cluster, i, sum(v[i])::BIGINT AS s, count(*)::BIGINT AS n FROM a{r}, range(1, {dims + 1}) t(i) GROUP BY cluster, i)) GROUP BY cluster)""")
        parts.append(f"c{r + 1} AS MATERIALIZED (SELECT cluster, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN m{r} m USING (cluster))")
    parts.append(nearest(rounds))
    return f"""WITH {", ".join(parts)}
      SELECT vec_id, a.cluster::INT AS cluster, distance, (sum(distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia,
        (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
      FROM a{rounds} a JOIN c{rounds} c ON a.cluster = c.cluster"""
