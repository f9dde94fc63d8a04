"""Exact dedup by content sort.

The normalised texts (A-Z lower-cased, nothing else) are range-partitioned by
sampled splitters, each range is sorted externally, and neighbours are compared
in full; each run of equal texts keeps one identifier.

* Sort order: the leading bytes, then the SHA-256, then the text, then the
  identifier. Splitters so stay small whatever the length of the texts, and a
  prefix that many texts share is split by the digest.
* The identifier is part of the range key, so a text that a third of all rows
  hold is split over many ranges. A run that reaches an edge of its range is
  closed in a second step: the first and last run of each range (with its text)
  meet by digest and equal texts in successive ranges become one run.

Null texts count as empty, and empty texts equal each other. Rows with a null
identifier sort lowest and are kept only if no other row of the text has one.
Repeated rows (same identifier, same text) are members like others and one of
them stays: the first of the kept identifier in the order of the run. An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cvlens.llm.common import free_caches, written

# Leading bytes of the range key.
PREFIX_CHARS = 16

_RUNS = ("doc_id long, rid long, keep_id long, text_sha256 string, range_id int, run int, at long, run_n long, "
         "open_run boolean, edge_text string")


def _normalise(batches):
    import pyarrow as pa
    import pyarrow.compute as pc
    free_caches()
    for b in batches:
        text = pc.ascii_lower(pc.fill_null(b.column(1), ""))
        yield pa.RecordBatch.from_arrays([b.column(0), text, b.column(2)], ["doc_id", "norm", "rid"])


def _runs(batches):
    """Number the runs of equal neighbours of one sorted range.

    Texts are compared in full, batch by batch; only the text at the end of a
    batch is carried on. A run is written when it ends, so its ids (8 bytes a
    row) and one text are held.
    """
    import pyarrow as pa
    import pyarrow.compute as pc
    from pyspark import TaskContext
    part = TaskContext.get().partitionId()
    names = ["doc_id", "rid", "keep_id", "text_sha256", "range_id", "run", "at", "run_n", "open_run", "edge_text"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]

    def emit(ids, sha, run, first, last, texts):
        """ids: pieces of one run."""
        ids, places = (pa.concat_arrays(x) for x in zip(*ids))
        n = len(ids)
        edge = first or last
        return pa.RecordBatch.from_arrays([
            ids, places, ids.take(pa.array(np.zeros(n, np.int64))), pa.array([sha] * n, pa.string()), pa.array(np.full(n, part, np.int32)),
            pa.array(np.full(n, run, np.int32)), pa.array(np.arange(n, dtype=np.int64)),
            pa.array(np.full(n, n, np.int64)), pa.array(np.full(n, edge)),
            pa.array([texts if edge else None] + [None] * (n - 1), pa.string())], names)

    held, held_text, held_sha, run = [], None, None, 0
    for b in batches:
        if b.num_rows == 0:
            continue
        ids, norm, sha, rid = b.columns
        n = b.num_rows
        differs = np.ones(n, bool)
        if n > 1:
            differs[1:] = ~np.asarray(pc.equal(norm[1:], norm[:-1]).to_numpy(zero_copy_only=False), bool)
        if held:
            differs[0] = held_text != norm[0].as_py()
        starts = np.flatnonzero(differs)
        head = int(starts[0]) if len(starts) else n
        if head and held:
            held.append((ids[:head], rid[:head]))
        if not len(starts):
            continue
        if held:
            yield emit(held, held_sha, run, run == 0, False, held_text)
            run += 1
        # The runs that begin and end within this batch, all but the first of the range in one piece.
        ends = np.append(starts[1:], n)
        k, lo = len(starts) - 1, 0
        if k and run == 0:
            yield emit([(ids[starts[0]:ends[0]], rid[starts[0]:ends[0]])], sha[int(starts[0])].as_py(), 0, True, False, norm[int(starts[0])].as_py())
            run, lo = 1, 1
        if k > lo:
            a, z = int(starts[lo]), int(ends[k - 1])
            sizes = (ends - starts)[lo:k]
            first = np.repeat(starts[lo:k], sizes)
            yield pa.RecordBatch.from_arrays([
                ids[a:z], rid[a:z], ids.take(pa.array(first)), sha[a:z], pa.array(np.full(z - a, part, np.int32)),
                pa.array(np.repeat(np.arange(run, run + k - lo, dtype=np.int32), sizes)),
                pa.array(np.arange(a, z, dtype=np.int64) - first), pa.array(np.repeat(sizes, sizes).astype(np.int64)),
                pa.array(np.zeros(z - a, bool)), pa.nulls(z - a, pa.string())], names)
            run += k - lo
        s = int(starts[-1])
        held, held_text, held_sha = [(ids[s:], rid[s:])], norm[s].as_py(), sha[s].as_py()
    if held:
        yield emit(held, held_sha, run, run == 0, True, held_text)
    else:
        yield pa.RecordBatch.from_arrays([pa.array([], t) for t in types], names)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min",
                 ranges: int | None = None, place: str | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, rid (the row's place in the input).

    ``keep``: "min" or "max", the identifier that stays of equal texts. ``place``: a column of distinct
    numbers that is the place, the same in every scan; without it rid is only good for telling rows of the result apart.
    """
    if keep not in ("min", "max"):
        raise ValueError("keep is min or max")
    spark = docs.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    norm = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("norm"),
                        (F.col(place) if place else F.monotonically_increasing_id()).alias("rid"))
            .mapInArrow(_normalise, "doc_id long, norm string, rid long")
            .withColumn("text_sha256", F.sha2(F.col("norm").cast("binary"), 256))
            .withColumn("_lead", F.substring("norm", 1, PREFIX_CHARS)))
    by_id = F.col("doc_id").asc_nulls_last() if keep == "min" else F.col("doc_id").desc_nulls_last()
    ordered = (norm.repartitionByRange(ranges, "_lead", "text_sha256", by_id, "rid")
               .sortWithinPartitions("_lead", "text_sha256", "norm", by_id, "rid"))
    runs = written(ordered.select("doc_id", "norm", "text_sha256", "rid").mapInArrow(_runs, _RUNS), "exact-runs")

    # Runs at the edges of ranges: at most two a range. Equal texts in successive ranges are one run.
    edges = runs.filter("edge_text IS NOT NULL").select("text_sha256", "edge_text", "range_id", "run", "run_n", "keep_id")
    same = Window.partitionBy("text_sha256", "edge_text")
    joined = edges.select(
        "range_id", "run", F.sum("run_n").over(same).alias("_n"),
        F.first("keep_id").over(same.orderBy("range_id", "run")).alias("_keep"),
        (F.row_number().over(same.orderBy("range_id", "run")) == 1).alias("_leads"))
    inner = (runs.filter("NOT open_run")
             .select("doc_id", "keep_id", F.col("run_n").alias("group_size"), (F.col("at") == 0).alias("kept"), "text_sha256", "rid"))
    outer = (runs.filter("open_run").join(joined, ["range_id", "run"])
             .select("doc_id", F.col("_keep").alias("keep_id"), F.col("_n").alias("group_size"),
                     ((F.col("at") == 0) & F.col("_leads")).alias("kept"), "text_sha256", "rid"))
    return inner.unionByName(outer)


ORACLE_SQL = """WITH n AS (SELECT doc_id,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents),
  g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(n.norm) AS text_sha256
FROM n JOIN g ON n.norm = g.norm"""
