"""Approximate nearest neighbours by stable random projections and kd-trees.

Largest inner product becomes nearest distance: each vector gets one more
component, ``sqrt(M^2 - |x|^2)`` (M: the longest vector's length), the query,
scaled to length M, gets 0 there; then ``|q - x|^2 = 2 M^2 - 2 (q . x) M / |q|``.
All points are projected to ``m`` dimensions by Gaussian (2-stable) directions,
so a projected squared distance is the true one times a chi-square variable
with ``m`` degrees of freedom.

The top of the kd-tree, fitted on at most ``SAMPLE`` points, ranges all points
into blocks of about ``block_rows``; a block with more (equal vectors) is dealt
into pieces by a hash of their places. Each piece is a kd-tree over its
projections, in leaves of ``leaf`` points. A query takes a piece's leaves in the
order of their projected lower bounds and verifies all their points by exact
inner products, until the chi-square test holds: a point with projected
distance beyond the next leaf's bound is nearer than the k-th found with
probability at most ``1 - certainty``. A query is first searched in its own block;
with the k-th it found there it goes to those other blocks whose boxes the
same test does not rule out.

Queries are a stated set, dealt in groups. Their number per task is bounded by
``query_group``, a piece's by its size; no point is left out of the index.

Vectors that are null, of another length than the commonest, zero, or hold
null or non-finite components take no part. Rows are told apart by their
place: a query leaves out only its own row, so rows that share its vec_id are
candidates, and each of several rows with a query's vec_id is a query of its
own. Ties go to the smaller vec_id. An empty table, or one with no usable
vector, gives an empty result.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cvlens.llm.common import written
from cvlens.session import ship_package

PROJECTED = 8
LEAF = 64
BLOCK_ROWS = 16_384
QUERY_GROUP = 4_096
SAMPLE = 8_192
CERTAINTY = 0.7
# Leaves that a query verifies between two tests.
STRIDE = 2


@lru_cache(maxsize=8)
def chi_square_quantile(p: float, m: int) -> float:
    """The p-quantile of chi-square with ``m`` degrees of freedom (bisection on the incomplete gamma series)."""
    def cdf(x: float) -> float:
        a, h = m / 2, x / 2
        term = total = 1 / a
        k = a
        while term > total * 1e-15:
            k += 1
            term *= h / k
            total += term
        return total * math.exp(-h + a * math.log(h) - math.lgamma(a))
    lo, hi = 1e-9, m + 40 * math.sqrt(2 * m)
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if cdf(mid) < p else (lo, mid)
    return (lo + hi) / 2


def kd_leaves(points: np.ndarray, leaf: int) -> list[np.ndarray]:
    """Row numbers of a kd-tree's leaves: halves at the median of the widest dimension."""
    out, todo = [], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        if len(rows) <= leaf:
            if len(rows):
                out.append(rows)
            continue
        own = points[rows]
        d = int(np.argmax(own.max(0) - own.min(0)))
        half = len(rows) // 2
        order = np.argpartition(own[:, d], half)
        todo += [rows[order[:half]], rows[order[half:]]]
    return out


def _best(scores: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest scores of each line and their rows, the least last; ties at the edge go to smaller ids."""
    keep = np.argpartition(-scores, k - 1, 1)[:, :k]
    top = np.take_along_axis(scores, keep, 1)
    least = top.min(1, keepdims=True)
    tied = np.flatnonzero(((scores == least).sum(1) > (top == least).sum(1)) & (least[:, 0] > -np.inf))
    if len(tied):
        own = np.where(rows[tied] < 0, np.iinfo(np.int64).max, ids[rows[tied]])
        keep[tied] = np.lexsort((own, -scores[tied]), axis=1)[:, :k]
        top = np.take_along_axis(scores, keep, 1)
    order = np.argsort(-top, 1, kind="stable")
    return np.take_along_axis(top, order, 1), np.take_along_axis(np.take_along_axis(rows, keep, 1), order, 1)


def _directions(dim: int, m: int = PROJECTED, seed: int = 7) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dim + 1, m))


def projected(x: np.ndarray, longest: float, m: int = PROJECTED, seed: int = 7) -> np.ndarray:
    """Stable projections of points, with the component that brings them to the length of the longest."""
    directions = _directions(x.shape[1], m, seed)
    extra = np.sqrt(np.maximum(longest ** 2 - np.einsum("ij,ij->i", x, x), 0.0))
    return x @ directions[:-1] + extra[:, None] * directions[-1]


def projected_queries(q: np.ndarray, size: np.ndarray, longest: float, m: int = PROJECTED, seed: int = 7) -> np.ndarray:
    return (q * (longest / size)[:, None]) @ _directions(q.shape[1], m, seed)[:-1]


def box_bounds(pq: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared lower bounds of each query to each box, built a dimension at a time."""
    bound = np.zeros((len(pq), len(low)))
    for d in range(pq.shape[1]):
        gap = np.maximum(np.maximum(low[None, :, d] - pq[:, None, d], pq[:, None, d] - high[None, :, d]), 0.0)
        bound += gap * gap
    return bound


def search_block(ids: np.ndarray, at: np.ndarray, x: np.ndarray, query_at: np.ndarray, q: np.ndarray, longest: float, k: int,
                 m: int = PROJECTED, leaf: int = LEAF, certainty: float = CERTAINTY, seed: int = 7, floor: np.ndarray | None = None):
    """(query row, vec_id, score) of the k nearest that the test allows, for all queries at once.

    ``at`` and ``query_at`` are the places of points and queries: a query leaves out the point of its own
    place. ``floor``: the k-th score that a query has found elsewhere; what is below it is not returned.
    """
    floor = np.full(len(q), -np.inf) if floor is None else floor
    px = projected(x, longest, m, seed)
    q_norm = np.sqrt(np.einsum("ij,ij->i", q, q))
    pq = projected_queries(q, q_norm, longest, m, seed)
    leaves = kd_leaves(px, leaf)
    bound = box_bounds(pq, np.array([px[r].min(0) for r in leaves]), np.array([px[r].max(0) for r in leaves]))
    width = max(map(len, leaves))
    members = np.full((len(leaves), width), -1)
    for i, r in enumerate(leaves):
        members[i, :len(r)] = r
    boxed = x[members]
    quantile = chi_square_quantile(certainty, m)
    order = np.argsort(bound, 1, kind="stable")
    bound = np.take_along_axis(bound, order, 1)
    best = np.full((len(q), k), -np.inf)
    who = np.full((len(q), k), -1)
    active = np.arange(len(q))
    for step in range(0, len(leaves), STRIDE):
        # points within reach of the next leaf's bound are not nearer than the k-th, but for the given chance
        kth = 2 * longest ** 2 - 2 * np.maximum(best[active, -1], floor[active]) * longest / q_norm[active]
        active = active[~(bound[active, step] > quantile * np.maximum(kth, 0.0))]
        if not len(active):
            break
        rows = members[order[active, step:step + STRIDE]].reshape(len(active), -1)
        dots = np.empty(rows.shape)
        for j in range(rows.shape[1] // width):  # the queries at one leaf together
            leaf_of = order[active, step + j]
            by_leaf = np.argsort(leaf_of, kind="stable")
            edges = np.flatnonzero(np.diff(leaf_of[by_leaf], prepend=-1, append=len(leaves)))
            for a, z in zip(edges[:-1], edges[1:]):
                own = by_leaf[a:z]
                dots[own, j * width:(j + 1) * width] = q[active[own]] @ boxed[leaf_of[own[0]]].T
        dots[(rows < 0) | (at[rows] == query_at[active][:, None])] = -np.inf
        best[active], who[active] = _best(np.concatenate([best[active], dots], 1), np.concatenate([who[active], rows], 1), ids, k)
    row, rank = np.nonzero((best > -np.inf) & (best >= floor[:, None]))
    return row, ids[who[row, rank]], best[row, rank]


def usable_vectors(vectors: DataFrame, id_col: str = "vec_id", col: str = "embedding") -> DataFrame:
    """(vec_id, v array<double>) of the vectors that take part."""
    v = F.col(col).cast("array<double>")
    fine = (F.col("v").isNotNull() & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
            & F.exists("v", lambda c: c != 0) & F.col("vec_id").isNotNull())
    out = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter(fine)
    size = out.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return out.filter(F.size("v") == (size["n"] if size else 0))


def split_blocks(sample: np.ndarray, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The top of the kd-tree: for each level the dimensions and medians of its nodes, fitted on projected points."""
    levels, parts = [], [sample]
    for _ in range(depth):
        dims, values, below = [], [], []
        for own in parts:
            d = int(np.argmax(own.max(0) - own.min(0))) if len(own) else 0
            cut = float(np.median(own[:, d])) if len(own) else 0.0
            dims.append(d)
            values.append(cut)
            below += [own[own[:, d] < cut], own[own[:, d] >= cut]]
        levels.append((np.array(dims), np.array(values)))
        parts = below
    return levels


def block_of(points: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The block that each projected point falls in."""
    node = np.zeros(len(points), np.int64)
    for dims, values in levels:
        node = 2 * node + (points[np.arange(len(points)), dims[node]] >= values[node])
    return node


def _vectors(t) -> np.ndarray:
    return t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)


def nearest(vectors: DataFrame, queries, k: int = 20, id_col: str = "vec_id", col: str = "embedding",
            block_rows: int = BLOCK_ROWS, query_group: int = QUERY_GROUP, certainty: float = CERTAINTY) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of each query row, ``queries`` being a condition on vec_id."""
    import pyarrow as pa
    spark = vectors.sparkSession
    ship_package(spark)
    points = written(usable_vectors(vectors, id_col, col).withColumns({"at": F.monotonically_increasing_id(), "asked": F.coalesce(queries, F.lit(False))}), "vectors")
    longest, n = points.select(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c))), F.count(F.lit(1))).first()
    result = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], result)
    depth = max(0, math.ceil(math.log2(n / block_rows)))
    sample = points.orderBy(F.xxhash64("at")).limit(SAMPLE).select("v").collect() if depth else []
    levels = split_blocks(projected(np.array([r.v for r in sample]), longest), depth) if depth else []

    def placed(batches):
        for b in batches:
            t = pa.Table.from_batches([b])
            x = _vectors(t)
            block = block_of(projected(x, longest), levels)
            # where a query would be as a point: its own projection lacks the last component
            home = block_of(projected_queries(x, np.sqrt(np.einsum("ij,ij->i", x, x)), longest), levels)
            for name, values in (("block", block), ("home", home)):
                t = t.append_column(name, pa.array(values.astype(np.int32)))
            yield from t.combine_chunks().to_batches()

    def boxes(batches):
        for b in batches:
            t = pa.Table.from_batches([b])
            p, block, asked = projected(_vectors(t), longest), t.column("block").to_numpy(), t.column("asked").to_numpy(zero_copy_only=False)
            for own in np.unique(block):
                rows = block == own
                yield pa.RecordBatch.from_pylist([{"block": int(own), "n": int(rows.sum()), "q": int(asked[rows].sum())}
                                                  | {f"lo{i}": float(x) for i, x in enumerate(p[rows].min(0))} | {f"hi{i}": float(x) for i, x in enumerate(p[rows].max(0))}])

    stored = written(points.mapInArrow(placed, "vec_id long, v array<double>, at long, asked boolean, block int, home int"), "vector-blocks")
    ends = [f"{e}{i}" for e in ("lo", "hi") for i in range(PROJECTED)]
    parts = stored.mapInArrow(boxes, "block long, n long, q long, " + ", ".join(f"{e} double" for e in ends))
    known = parts.groupBy("block").agg(F.sum("n").alias("n"), F.sum("q").alias("q"), *[F.min(e).alias(e) if e[0] == "l" else F.max(e).alias(e) for e in ends]).collect()
    known.sort(key=lambda r: r.block)  # a row a block: one in block_rows vectors
    low, high = (np.array([[r[f"{e}{i}"] for i in range(PROJECTED)] for r in known]) for e in ("lo", "hi"))
    numbers = np.array([r.block for r in known])
    pieces = {r.block: -(-r.n // block_rows) for r in known}
    groups = max(1, -(-sum(r.q for r in known) // query_group))
    piece_table = spark.createDataFrame(list(pieces.items()), "block int, pieces long")
    at_home = stored.join(F.broadcast(piece_table), "block")
    grp = F.pmod(F.xxhash64(F.lit(1), "at"), F.lit(groups))
    fresh = lambda *names: [F.col(x).alias(x) for x in names]  # noqa: E731  points and queries come from one table: columns of their own
    held = at_home.select(*fresh("block"), F.pmod(F.xxhash64("at"), "pieces").alias("piece"), *fresh("vec_id", "at", "v"))

    def searched(asked: DataFrame) -> DataFrame:
        """The k nearest of each query (at, q_id, v, floor) in the block it is sent to, those above its floor."""
        sent = (asked.join(F.broadcast(piece_table), "block").withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
                .select("block", "piece", grp.alias("grp"), "q_id", "at", "v", "floor"))
        wanted = sent.groupBy("block", "piece", "grp").count().select(*fresh("block", "piece", "grp"))
        own = held.join(wanted, ["block", "piece"])
        return (own.groupBy("block", "piece", "grp").cogroup(sent.groupBy("block", "piece", "grp"))
                .applyInArrow(search, "q_at long, q_id long, vec_id long, score double"))

    def search(own, theirs):
        if not own.num_rows or not theirs.num_rows:
            return pa.table({"q_at": pa.array([], pa.int64()), "q_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        ids, q_at = own.column("vec_id").to_numpy(), theirs.column("at").to_numpy()
        row, found, score = search_block(ids, own.column("at").to_numpy(), _vectors(own), q_at, _vectors(theirs), longest, k,
                                         certainty=certainty, floor=theirs.column("floor").to_numpy())
        return pa.table({"q_at": pa.array(q_at[row]), "q_id": pa.array(theirs.column("q_id").to_numpy()[row]), "vec_id": pa.array(found), "score": pa.array(score)})

    asking = stored.filter("asked").select(F.col("home").alias("block"), "at", F.col("vec_id").alias("q_id"), "v")
    home = written(searched(asking.withColumn("floor", F.lit(float("-inf")))), "found-at-home")
    if depth:
        kth = home.groupBy("q_at").agg(F.sort_array(F.collect_list("score"), asc=False).alias("s")).select(
            F.col("q_at").alias("at"), F.coalesce(F.get("s", F.lit(k - 1)), F.lit(float("-inf"))).alias("floor"))
        quantile = chi_square_quantile(certainty, PROJECTED)

        def visits(batches):
            for b in batches:
                for lo in range(0, b.num_rows, 512):
                    t = pa.Table.from_batches([b.slice(lo, 512)])
                    q, floor = _vectors(t), t.column("floor").to_numpy()
                    size = np.sqrt(np.einsum("ij,ij->i", q, q))
                    bound = box_bounds(projected_queries(q, size, longest), low, high)
                    reach = quantile * np.maximum(2 * longest ** 2 - 2 * floor * longest / size, 0.0)
                    row, to = np.nonzero((bound <= reach[:, None]) & (numbers[None, :] != t.column("block").to_numpy()[:, None]))
                    for a in range(0, len(row), 4096):
                        r = pa.array(row[a:a + 4096])
                        out = t.take(r)
                        yield from out.set_column(out.schema.get_field_index("block"), "block", pa.array(numbers[to[a:a + 4096]].astype(np.int32))).combine_chunks().to_batches()

        further = asking.join(kth, "at", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf")))).select("block", "at", "q_id", "v", "floor")
        home = home.unionByName(searched(further.mapInArrow(visits, "block int, at long, q_id long, v array<double>, floor double")))
    first = Window.partitionBy("q_at").orderBy(F.desc("score"), "vec_id")
    return (home.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)
            .select(F.col("q_id").alias("query_id"), F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
