"""Set similarity join of documents by chosen paths: five-word shingles, Jaccard similarity.

Words are runs of letters, digits and other non-ASCII characters of the
lower-cased text; a text of one to four words has one shingle, all its words.

1. Documents with equal shingle sets are one representative (with a count).
2. Each run splits the representatives recursively. At a path, a set chooses
   each of its shingles with probability ``1 / (threshold * size)`` by a hash
   of path and shingle, and joins the bucket of each chosen one; two sets that
   share a chosen shingle meet below it. Buckets of at most ``small`` sets are
   compared by brute force; larger ones split again, ``depth`` levels deep.
   What is still larger then is compared whole, in blocks.
3. Runs repeat until a pair at the threshold is found with probability
   ``recall``: a run finds it with p(1) = 1 - exp(-1) if its bucket is small at
   the first level, else with p(l + 1) = 1 - exp(-p(l)); the number of runs
   takes the last level's p.
4. In a bucket, sizes and 64-part min-hash sketches sort out pairs that are
   far below the threshold. What is left links documents into families; all
   pairs of a family are compared exactly, in blocks of ``block`` sets. A link
   is a pair of similarity ``threshold`` or more; classes are the components
   of links.

Links are counted where they are found and leave a task as counts and as a
forest of its members, so a group of copies costs rows in proportion to its
members. Null texts, and texts without words, have no shingles: no links, a
class of their own. Repeated rows (equal identifiers too) are separate
documents of one class. An empty table gives an empty result. Very long texts
are shingled in chunks. Other columns are not read.

The rows are stored once with their places, unless the caller names a
column that is their place in every scan; texts of families are read again from there. All
pairs of a family are compared, so a chain of texts that are each plausible
for the sketches, but less than the threshold similar, costs the square of its
length.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cvlens.llm.common import byte_column, free_caches, mix64, text_or_empty, written
from cvlens.llm.groups import components, forest, spans, whole_groups

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.99
DEPTH = 3
SMALL = 64
BLOCK = 1024
BINS = 64
# Standard deviations that a sketch may fall short of the threshold.
SLACK = 4.5
# Bytes of text that are shingled at once.
CHUNK_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256), 95]] = True


def runs_for(recall: float, depth: int) -> int:
    p = 1 - math.exp(-1)
    for _ in range(depth - 1):
        p = 1 - math.exp(-p)
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - p)))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2^64."""
    inverse = pow(int(_BASE), -1, 1 << 64)
    out = []
    for base in (int(_BASE), inverse):
        p = np.full(n + 1, np.uint64(base))
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0][0]) <= n:
        _POWERS[:] = [_powers(max(n, CHUNK_BYTES))]
    return _POWERS[0]


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each lower-cased text (bytes, offsets)."""
    n = len(raw)
    up, down = _power_tables(n)
    inside = np.zeros(n + 1, bool)
    inside[:n] = _WORD[raw]
    begins = inside[:n].copy()
    begins[1:] &= ~inside[:n - 1]
    firsts = offsets[:-1][offsets[:-1] < n]
    begins[firsts] = inside[firsts]
    closes = inside[:n].copy()
    closes[:-1] &= ~inside[1:n]
    lasts = offsets[1:][offsets[1:] > 0] - 1
    closes[lasts] = inside[lasts]
    s, e = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    words = mix64((sums[e] - sums[s]) * down[s])
    upto = np.searchsorted(s, offsets)
    out = []
    rolled = words.copy()
    factor = np.uint64(0xD6E8FEB86659FD93)
    for j in range(1, k):
        rolled = rolled[:len(words) - j] * factor + words[j:] if len(words) > j else rolled[:0]
    rolled = mix64(rolled)
    for a, z in zip(upto[:-1].tolist(), upto[1:].tolist()):
        if z - a >= k:
            out.append(np.unique(rolled[a:z - k + 1]))
        elif z > a:
            h = np.uint64(z - a)
            for w in words[a:z]:
                h = h * factor + w
            out.append(mix64(np.array([h], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def text_sets(texts) -> list[np.ndarray]:
    """Shingle sets of an Arrow array of texts."""
    import pyarrow as pa
    import pyarrow.compute as pc
    low = pc.utf8_lower(texts.cast(pa.string()))
    sizes = np.diff(byte_column(low)[1])
    chunk = np.cumsum(sizes) // CHUNK_BYTES
    out: list[np.ndarray] = []
    with np.errstate(over="ignore"):
        for a, z in spans(chunk):
            out += shingle_sets(*byte_column(low.slice(a, z - a)))
    return out


def paths(tokens: np.ndarray, roots: np.ndarray, threshold: float, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(parents, paths) of each level."""
    limit = np.uint64(min((1 << 64) - 1, int((1 << 64) / (threshold * len(tokens)))))
    spread = mix64(tokens * _BASE)
    out, level = [], roots
    for _ in range(depth):
        of, which = np.nonzero(mix64(tokens[None, :] ^ level[:, None]) < limit)
        parents = level[of]
        level = mix64(spread[which] ^ (parents * np.uint64(0xA24BAED4963EE407)))
        out.append((parents, level))
    return out


def sketch(tokens: np.ndarray) -> tuple[bytes, int]:
    """One byte for each of 64 ranges of the hash (of its least shingle), and which ranges hold any."""
    edges = np.arange(BINS, dtype=np.uint64) << np.uint64(58)
    at = np.append(np.searchsorted(tokens, edges), len(tokens))
    full = at[1:] > at[:-1]
    part = np.zeros(BINS, np.uint8)
    part[full] = (mix64(tokens[at[:-1][full]]) & np.uint64(255)).astype(np.uint8)
    return part.tobytes() + full.astype(np.uint8).tobytes(), len(tokens)


def plausible(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, threshold: float) -> np.ndarray:
    """Whether sketches (rows of 128 bytes) and sizes leave a pair a chance of ``threshold``."""
    fa, fb = a[..., BINS:] != 0, b[..., BINS:] != 0
    either = (fa | fb).sum(-1)
    equal = (fa & fb & (a[..., :BINS] == b[..., :BINS])).sum(-1)
    need = threshold * either - SLACK * np.sqrt(threshold * (1 - threshold) * either)
    return (equal >= need) & (np.minimum(size_a, size_b) >= threshold * np.maximum(size_a, size_b))


_SIGNED = ("doc_id long, rid long, size int, d1 long, d2 long, sk binary, l1 array<long>, "
           "p2 array<long>, l2 array<long>, p3 array<long>, l3 array<long>")


def _sign(threshold: float, depth: int, runs: int, seed: int):
    def run(batches):
        import pyarrow as pa
        free_caches()
        roots = mix64(np.arange(1, runs + 1, dtype=np.uint64) * _BASE + np.uint64(seed))
        whole = pa.list_(pa.int64())
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                rows = []
                with np.errstate(over="ignore"):
                    for tokens in text_sets(part.column(2)):
                        n = len(tokens)
                        if not n:
                            rows.append((0, 0, 0, b"\0" * (2 * BINS), *[np.zeros(0, np.int64)] * 5))
                            continue
                        d1 = int((mix64(tokens) * (np.uint64(2) * np.arange(n, dtype=np.uint64) + np.uint64(1))).sum().view(np.int64))
                        d2 = int(np.bitwise_xor.reduce(mix64(tokens + np.uint64(n) * _BASE)).view(np.int64))
                        levels = paths(tokens, roots, threshold, depth)
                        levels += [(np.zeros(0, np.uint64),) * 2] * (3 - depth)
                        own = [x.view(np.int64) for pair in levels for x in pair][1:]
                        rows.append((n, d1, d2, sketch(tokens)[0], *own))
                lists = [pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(r[i]) for r in rows)]), pa.int32()),
                                                  pa.array(np.concatenate([r[i] for r in rows]) if rows else [], pa.int64())).cast(whole)
                         for i in range(4, 9)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()),
                     pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.binary()), *lists],
                    ["doc_id", "rid", "size", "d1", "d2", "sk", "l1", "p2", "l2", "p3", "l3"])
    return run


def _sketches(t) -> np.ndarray:
    return np.frombuffer(b"".join(t.column("sk").to_pylist()), np.uint8).reshape(-1, 2 * BINS)


def _small_buckets(threshold: float):
    """Brute force over whole buckets: rows ``d`` apart are compared for all buckets at once."""
    def run(batches):
        import pyarrow as pa
        for t in whole_groups(batches, "path"):
            path, rid, size, sk = t.column("path").to_numpy(), t.column("rid").to_numpy(), t.column("size").to_numpy(), _sketches(t)
            d = 1
            while True:
                i = np.flatnonzero(path[d:] == path[:-d]) if d < len(path) else np.zeros(0, np.int64)
                if not len(i):
                    break
                i = i[plausible(sk[i], sk[i + d], size[i], size[i + d], threshold)]
                yield pa.RecordBatch.from_arrays([pa.array(rid[i]), pa.array(rid[i + d])], ["a", "b"])
                d += 1
    return run


def _in_blocks(df: DataFrame, key: str, n: str, block: int) -> DataFrame:
    """Deal the members of large groups into pairs of blocks: columns k1, k2 (block pair) and side."""
    blocks = F.ceil(F.col(n) / block).cast("long")
    own = F.pmod(F.xxhash64("rid"), blocks)
    out = df.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    lo, hi = F.least("_own", "_other"), F.greatest("_own", "_other")
    return (out.withColumn("side", (F.col("_own") == hi).cast("int") + (F.col("_own") == lo).cast("int") * 2)
            .withColumn("part", F.xxhash64(key, lo, hi)).drop("_own", "_other"))


def _sides(t) -> tuple[np.ndarray, np.ndarray, bool]:
    """Row numbers of the two sides of a block pair, and whether they are one block."""
    side = t.column("side").to_numpy()
    first, second = np.flatnonzero(side & 2), np.flatnonzero(side & 1)
    return first, second, bool((side == 3).all())


def _large_buckets(threshold: float):
    def run(batches):
        import pyarrow as pa
        for t in whole_groups(batches, "part"):
            for a, z in spans(t.column("part").to_numpy()):
                g = t.slice(a, z - a)
                rid, size, sk = g.column("rid").to_numpy(), g.column("size").to_numpy(), _sketches(g)
                first, second, same = _sides(g)
                found = [], []
                for lo in range(0, len(first), 64):
                    x = first[lo:lo + 64]
                    i, j = np.nonzero(plausible(sk[x][:, None], sk[second][None], size[x][:, None], size[second][None], threshold))
                    i, j = x[i], second[j]
                    keep = i < j if same else i != j
                    found[0].append(i[keep])
                    found[1].append(j[keep])
                if not found[0]:
                    continue
                own = forest(len(rid), np.concatenate(found[0]), np.concatenate(found[1]))
                yield pa.RecordBatch.from_arrays([pa.array([rid[x] for x, _ in own], pa.int64()),
                                                  pa.array([rid[y] for _, y in own], pa.int64())], ["a", "b"])
    return run


def common_counts(sets: list[np.ndarray], first: np.ndarray, second: np.ndarray, width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of ``sets[first[i]]`` and ``sets[second[j]]``."""
    if len(first) * len(second) <= 4:
        return np.array([[len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for j in second] for i in first], np.int64)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    values, inverse, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(seen > 1) - 1
    shared = (seen > 1)[inverse]
    owner, column = owner[shared], number[inverse[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(first), len(second)), np.int64)
    for lo in range(0, int(number[-1]) + 1 if len(number) else 0, width):
        a, z = np.searchsorted(column, [lo, lo + width])
        m = np.zeros((len(sets), width), np.float32)
        m[owner[a:z], column[a:z] - lo] = 1
        out += np.rint(m[first] @ m[second].T).astype(np.int64)
    return out


def _verify(threshold: float):
    """Exact similarities of a family's block pair: link counts (weighted by copies) and a forest of links."""
    def run(batches):
        import pyarrow as pa
        names = ["rid", "links", "other"]
        for t in whole_groups(batches, "part"):
            for a, z in spans(t.column("part").to_numpy()):
                g = t.slice(a, z - a)
                rid, copies = g.column("rid").to_numpy(), g.column("copies").to_numpy()
                sets = [np.frombuffer(s, np.uint64) for s in g.column("tokens").to_pylist()]
                size = np.array([len(s) for s in sets], np.int64)
                first, second, same = _sides(g)
                if not len(first) or not len(second):
                    continue
                common = common_counts(sets, first, second)
                linked = common >= threshold * (size[first][:, None] + size[second][None] - common) - 1e-9
                if same:
                    np.fill_diagonal(linked, False)
                links = np.zeros(len(rid), np.int64)
                links[first] += linked @ copies[second]
                if not same:
                    links[second] += copies[first] @ linked
                i, j = np.nonzero(np.triu(linked)) if same else np.nonzero(linked)
                edges = forest(len(rid), first[i], second[j])
                some = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*rid[some], *(rid[x] for x, _ in edges)], pa.int64()), pa.array([*links[some], *[0] * len(edges)], pa.int64()),
                     pa.array([*[None] * len(some), *(int(rid[y]) for _, y in edges)], pa.int64())], names)
    return run


def _tokens(batches):
    import pyarrow as pa
    for b in batches:
        for lo in range(0, b.num_rows, 1024):
            part = b.slice(lo, 1024)
            sets = pa.array([s.tobytes() for s in text_sets(part.column(4))], pa.binary())
            yield pa.RecordBatch.from_arrays([*part.columns[:4], sets], ["rid", "family", "n", "copies", "tokens"])


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, depth: int = DEPTH,
                    small: int = SMALL, block: int = BLOCK, seed: int = 11, place: str | None = None) -> DataFrame:
    """One row per document: doc_id, class_id (least doc_id of its class), n_links, rid (its place), class_rid
    (the same number for all of a class).

    ``place``: a column of distinct numbers that is the place, the same in every scan; without it the rows are stored with one.
    """
    if not 0 < threshold <= 1 or not 0 < recall < 1 or not 1 <= depth <= 3:
        raise ValueError("threshold in (0, 1], recall in (0, 1), depth 1 to 3")
    rid = F.col(place) if place else F.monotonically_increasing_id()
    placed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), rid.alias("rid"), text_or_empty().cast("string").alias("text"))
    if not place:
        placed = written(placed, "chosen-texts")
    signed = written(placed.mapInArrow(_sign(threshold, depth, runs_for(recall, depth), seed), _SIGNED), "chosen-signed")
    reps = written(signed.filter("size > 0").groupBy("d1", "d2", "size")
                   .agg(F.min("rid").alias("rid"), F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least_id")), "chosen-reps")
    own = signed.join(reps.select("rid"), "rid", "left_semi")

    # Split the buckets, level by level; only paths below a large bucket go on.
    leaves, large, opened = [], None, None
    for level in range(1, depth + 1):
        if level == 1:
            rows = own.select("rid", F.explode("l1").alias("path"))
        else:
            rows = (own.select("rid", F.explode(F.arrays_zip(f"p{level}", f"l{level}")).alias("_z"))
                    .select("rid", F.col(f"_z.p{level}").alias("parent"), F.col(f"_z.l{level}").alias("path"))
                    .join(opened, "parent", "left_semi").select("rid", "path"))
            rows = written(rows.distinct(), "chosen-rows")
        sizes = written(rows.groupBy("path").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "chosen-sizes")
        leaves.append(rows.join(sizes.filter(F.col("n") <= small), "path").select("path", "rid", "n"))
        opened = sizes.filter(F.col("n") > small).select(F.col("path").alias("parent"))
        if level == depth:
            large = rows.join(sizes.filter(F.col("n") > small), "path").select("path", "rid", "n")
    small_rows = leaves[0]
    for more in leaves[1:]:
        small_rows = small_rows.unionByName(more)
    facts = own.select("rid", "size", "sk")
    pairs = (small_rows.join(facts, "rid").select("path", "rid", "size", "sk")
             .repartition("path").sortWithinPartitions("path", "rid").mapInArrow(_small_buckets(threshold), "a long, b long"))
    blocked = (_in_blocks(large.join(facts, "rid"), "path", "n", block).select("part", "side", "rid", "size", "sk")
               .repartition("part").sortWithinPartitions("part", "rid").mapInArrow(_large_buckets(threshold), "a long, b long"))
    families = components(pairs.unionByName(blocked))

    # Each family's sets meet once, in pairs of blocks.
    families = written(families.join(reps.select(F.col("rid").alias("node"), "copies"), "node")
                       .select(F.col("node").alias("rid"), F.col("label").alias("family"), "copies"), "chosen-families")
    sized = families.groupBy("family").agg(F.count(F.lit(1)).alias("n"))
    members = placed.select("rid", "text").join(families.join(sized, "family"), "rid").select("rid", "family", "n", "copies", "text")
    sets = members.mapInArrow(_tokens, "rid long, family long, n long, copies long, tokens binary")
    found = written(_in_blocks(sets, "family", "n", block).select("part", "side", "rid", "copies", "tokens")
                    .repartition("part").sortWithinPartitions("part", "rid")
                    .mapInArrow(_verify(threshold), "rid long, links long, other long"), "chosen-links")
    classes = components(found.filter("other IS NOT NULL").select(F.col("rid").alias("a"), F.col("other").alias("b")))
    links = found.groupBy("rid").agg(F.sum("links").alias("links"))
    labelled = (reps.join(classes.withColumnRenamed("node", "rid"), "rid", "left").join(links, "rid", "left")
                .select("d1", "d2", "size", "least_id", F.coalesce("label", "rid").alias("label"),
                        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    labelled = written(labelled, "chosen-labels")
    named = labelled.groupBy("label").agg(F.min("least_id").alias("class_id"))
    answer = labelled.join(named, "label").select("d1", "d2", "size", "class_id", "n_links", F.col("label").alias("class_rid"))
    alone = signed.filter("size = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), "rid",
                                            F.col("rid").alias("class_rid"))
    return (signed.filter("size > 0").select("doc_id", "rid", "d1", "d2", "size").join(answer, ["d1", "d2", "size"])
            .select("doc_id", "class_id", "n_links", "rid", "class_rid").unionByName(alone))
