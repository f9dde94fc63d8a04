"""Contiguous groups of sorted Arrow batches, and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cvlens.llm.common import written


def whole_groups(batches, key: str) -> Iterator:
    """Tables of whole groups of equal ``key`` (a number), from batches sorted by it.

    Many groups come in one table; only the last group of a batch is carried on.
    """
    import pyarrow as pa
    held: list = []
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(b.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(k, k[-1], "left")) if k[0] <= k[-1] else int(np.flatnonzero(k != k[-1])[-1]) + 1
        if cut:
            yield pa.Table.from_batches([*held, b.slice(0, cut)])
            held = [b.slice(cut)]
        elif held and held[-1].column(held[-1].schema.get_field_index(key))[0].as_py() != k[-1]:
            yield pa.Table.from_batches(held)
            held = [b]
        else:
            held.append(b)
    if held:
        yield pa.Table.from_batches(held)


def spans(keys: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of the runs of equal keys."""
    edges = np.flatnonzero(np.diff(keys)) + 1
    return list(zip([0, *edges.tolist()], [*edges.tolist(), len(keys)])) if len(keys) else []


def forest(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges (i, j) that join the same of ``n`` nodes as the pairs (a, b) do; at most n - 1."""
    top = list(range(n))

    def find(x):
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x
    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        rx, ry = find(x), find(y)
        if rx != ry:
            top[max(rx, ry)] = min(rx, ry)
            out.append((x, y))
    return out


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the least node of each node's component; ``edges`` is (a long, b long).

    Rounds of contraction: every node joins its least neighbour, chains are
    shortened by one jump, and edges are moved to the joined nodes, until none
    is left. At least half of the nodes that still have edges go in each round.
    Minima are aggregated on both sides of the shuffle, so a node with many
    edges costs a row a task.
    """
    left = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    labels = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("up"))
        least = written(least, "component-step")
        top = least.select(F.col("node").alias("up"), F.col("up").alias("upper"))
        jump = written(least.join(top, "up", "left").select("node", F.coalesce("upper", "up").alias("up")), "component-jump")
        if labels is None:
            labels = jump.withColumnRenamed("up", "label")
        else:
            labels = written(labels.join(jump.withColumnRenamed("node", "label"), "label", "left")
                             .select("node", F.coalesce("up", "label").alias("label")), "component-labels")
        to_a, to_b = (jump.select(F.col("node").alias(c), F.col("up").alias(f"_{c}")) for c in "ab")
        moved = left.join(to_a, "a").join(to_b, "b").filter("_a <> _b")
        left = written(moved.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(), "edges")
    if labels is None:
        labels = left.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
