"""Removal of repeated passages: every byte of a 200-byte string that also starts elsewhere.

Texts are UTF-8 bytes; a match never crosses documents; the string may start
again in the same document, overlaps included; all strings are judged on the
input. Removed is what any such string covers, so the result does not depend
on an order of documents.

1. Anchors. Each ``window``-byte string has one anchor, the start of its
   ``gram``-byte substring of least hash (the first of equals). Equal strings
   have equal anchors at equal offsets, so only strings around an anchor that
   occurs twice can be repeated. An anchor and the run of strings it stands for
   are one row; a hash that occurs once ends here.
2. Where all strings of an anchor's run occur again together (equal 64-bit
   BLAKE2b digest of the whole context beside the equal 64-bit hash of the
   anchor), the context is covered. One member of each such class, and the
   anchors with a context of their own, go on where their hash has more than
   one class; they fetch their contexts.
3. The contexts of one anchor hash are sorted twice as suffixes: by the bytes
   after the anchor and by the bytes before it, backwards. The sort is a
   mergesort whose comparison finds the common extension of two suffixes by
   binary search over prefix polynomial hashes (equal hashes of equal lengths)
   and then compares one byte: logarithmic in the length. Every neighbouring
   pair of the result is verified on the bytes; where a hash collided, the
   group is sorted by its bytes instead. The string ``o`` bytes before its
   anchor is repeated if another context agrees with it for ``o`` bytes
   backwards and ``window - o`` bytes onwards: equal runs in both orders.
4. An anchor hash with more than ``LARGE`` contexts (a passage that many documents
   share has them at its two ends) is not one group: each string of these
   contexts is a row of two independent 64-bit hashes, told from differences of
   prefix hashes, counted by pre-aggregation; contexts find theirs again by a
   join. Equal strings of small and of large groups never mix, as a string
   has one anchor.
5. Covered spans go back to their documents.

Null texts count as empty. Texts shorter than the window are kept whole.
Repeated rows are documents of their own (and so remove each other). An empty
table gives an empty result. The input is read once: its rows are stored with
their places, so that a place does not depend on how a later scan is split.

Scale: anchors are about 1 in 80 bytes, as narrow rows; counts are aggregated
on both sides of the shuffle; texts are shuffled once (both joins with them
use one exchange), and only contexts that differ travel with their bytes.
"""

from __future__ import annotations

from functools import lru_cache
from hashlib import blake2b

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cvlens.llm.chosen_path import _power_tables
from cvlens.llm.common import byte_column, free_caches, free_shuffles, mix64, text_or_empty, written
from cvlens.llm.groups import spans, whole_groups

WINDOW = 200
GRAM = 40
CHUNK_BYTES = 1 << 20
_PLACE_BITS = 24  # places in a chunk, packed below the hash
# Groups of more contexts of their own than this are compared string by string.
LARGE = 4096
# Classes of more anchors than this share of all, at most 1,000, are joined apart from the rest.
HOT_SHARE = 1000

_ANCHORS = "h long, u long, rid long, p int, lo int, n int"


def _prefix_sums(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix polynomial hashes, and the powers that move a difference to the origin."""
    up, down = _power_tables(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=sums[1:])
    return sums, down


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minima of the windows v[i:i + w], by prefix and suffix minima of blocks of w."""
    n = len(v) - w + 1
    padded = np.full(-(-len(v) // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(v)] = v
    rows = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(rows, 1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1:w - 1 + n])


def anchors(raw: np.ndarray, offsets: np.ndarray, window: int, gram: int):
    """(hash, context hash, document, place, first string, number of strings - 1) of each anchor."""
    n = len(raw)
    none = [np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int32, np.int32, np.int32)]
    if n < window:
        return none
    sums, down = _prefix_sums(raw)
    grams = mix64((sums[gram:] - sums[:n - gram + 1]) * down[:n - gram + 1])
    places = np.uint64((1 << _PLACE_BITS) - 1)
    key = (grams & ~places) | np.arange(len(grams), dtype=np.uint64)
    at = (sliding_min(key, window - gram + 1) & places).astype(np.int64)
    sizes = np.diff(offsets)
    doc = np.repeat(np.arange(len(sizes)), sizes)[:len(at)]
    inside = np.flatnonzero(np.arange(len(at)) + window <= offsets[1:][doc])
    if not len(inside):
        return none
    p, d = at[inside], doc[inside]
    edge = np.flatnonzero(np.concatenate([[True], (p[1:] != p[:-1]) | (d[1:] != d[:-1])]))
    first = inside[edge]
    more = np.diff(np.append(edge, len(inside))) - 1
    p, d = p[edge], d[edge]
    whole = raw.tobytes()
    u = np.frombuffer(b"".join([blake2b(whole[a:z], digest_size=8).digest() for a, z in zip(first.tolist(), (first + more + window).tolist())]), np.uint64)
    u = mix64(u + ((p - first) * 1000 + more).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    base = offsets[:-1][d]
    return [grams[p].view(np.int64), u.view(np.int64), d, (p - base).astype(np.int32), (first - base).astype(np.int32), more.astype(np.int32)]


def _anchor_rows(window: int, gram: int):
    def run(batches):
        import pyarrow as pa
        free_caches()
        for b in batches:
            raw, offsets = byte_column(b.column(2))
            rid = b.column(0).to_numpy()
            # a chunk ends with a document; a very long one is alone, in parts that share all but one byte of a string
            long = np.diff(offsets) > CHUNK_BYTES
            fresh = (np.diff(offsets[:-1] // CHUNK_BYTES, prepend=0) != 0) | long | np.concatenate([[False], long])[:len(long)]
            for a, z in spans(np.cumsum(fresh)):
                start, end = int(offsets[a]), int(offsets[z])
                cut = bool(long[a])
                for s in range(start, end, CHUNK_BYTES) if cut else (start,):
                    e = min(s + CHUNK_BYTES + window - 1, end) if cut else end
                    own = np.array([0, e - s]) if cut else offsets[a:z + 1] - start
                    with np.errstate(over="ignore"):
                        h, u, d, p, lo, n = anchors(raw[s:e], own, window, gram)
                    if cut:
                        p, lo = p + np.int32(s - start), lo + np.int32(s - start)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (h, u, rid[a + d], p, lo, n)], ["h", "u", "rid", "p", "lo", "n"])
    return run


class Suffixes:
    """Suffixes of byte strings, compared by prefix hashes."""

    def __init__(self, raw: np.ndarray, start: np.ndarray, length: np.ndarray):
        self.raw, self.start, self.length = raw, start, length
        self.sums, self.down = _prefix_sums(raw)

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Lengths of the common extensions, by binary search."""
        a, b = self.start[i], self.start[j]
        lo, hi = np.zeros(len(i), np.int64), np.minimum(self.length[i], self.length[j])
        da, db, sa, sb = self.down[a], self.down[b], self.sums[a], self.sums[b]
        while True:
            open_ = lo < hi
            if not open_.any():
                return lo
            mid = (lo + hi + 1) >> 1
            same = (self.sums[a + mid] - sa) * da == (self.sums[b + mid] - sb) * db
            lo, hi = np.where(open_ & same, mid, lo), np.where(open_ & ~same, mid - 1, hi)

    def before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 as suffix i sorts before, with or after suffix j."""
        m = self.common(i, j)
        ei, ej = m == self.length[i], m == self.length[j]
        at = lambda x, e: np.where(e, -1, self.raw[np.minimum(self.start[x] + m, len(self.raw) - 1)].astype(np.int64))
        return np.sign(at(i, ei) - at(j, ej))

    def order(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sorted numbers, common extension of each with the one before it, -1 at a group's first).

        ``group``: sorted group numbers; groups are sorted apart, all at once,
        by merging runs of 1, 2, 4, ... neighbours: an element's place is its
        own rank plus its rank in the other run, found by binary search.
        """
        n = len(group)
        edges = np.flatnonzero(np.diff(group, prepend=group[0] - 1)) if n else np.zeros(0, np.int64)
        sizes = np.diff(np.append(edges, n))
        first = np.repeat(edges, sizes)
        size = np.repeat(sizes, sizes)
        within = np.arange(n) - first
        order = np.arange(n)
        run = 1
        while n and run < sizes.max():
            live = np.flatnonzero(size > run)
            pair = within[live] // (2 * run)
            left = (within[live] // run) % 2 == 0
            base = first[live] + pair * 2 * run
            end = first[live] + size[live]
            middle = np.minimum(base + run, end)
            lo = np.where(left, middle, base)
            other = lo.copy()
            hi = np.where(left, np.minimum(base + 2 * run, end), middle)
            x = order[live]
            while True:
                open_ = np.flatnonzero(lo < hi)
                if not len(open_):
                    break
                mid = (lo[open_] + hi[open_]) >> 1
                sign = self.before(order[mid], x[open_])
                goes = np.where(left[open_], sign < 0, sign <= 0)  # equals stay in their order
                lo[open_] = np.where(goes, mid + 1, lo[open_])
                hi[open_] = np.where(goes, hi[open_], mid)
            own = np.where(left, live - base, live - middle)
            merged = order.copy()
            merged[base + own + (lo - other)] = x
            order = merged
            run *= 2
        lcp = np.full(n, -1, np.int64)
        inner = np.flatnonzero(within > 0)
        lcp[inner] = self.common(order[inner - 1], order[inner])
        if self._verified(order, lcp, inner):
            return order, lcp
        return self._by_bytes(group, edges, sizes)

    def _verified(self, order: np.ndarray, lcp: np.ndarray, inner: np.ndarray) -> bool:
        """Whether all neighbours agree on the bytes found common and rise at the next one."""
        i, j, m = order[inner - 1], order[inner], lcp[inner]
        ends = np.cumsum(m)
        step = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - m, m)
        if (self.raw[np.repeat(self.start[i], m) + step] != self.raw[np.repeat(self.start[j], m) + step]).any():
            return False
        at = lambda x: np.where(m < self.length[x], self.raw[np.minimum(self.start[x] + m, len(self.raw) - 1)].astype(np.int64), -1)
        a, b = at(i), at(j)
        return bool(((a < b) | ((a == -1) & (b == -1))).all())

    def _by_bytes(self, group, edges, sizes) -> tuple[np.ndarray, np.ndarray]:
        whole = [self.raw[s:s + m].tobytes() for s, m in zip(self.start.tolist(), self.length.tolist())]
        order, lcp = np.arange(len(group)), np.full(len(group), -1, np.int64)
        for e, s in zip(edges.tolist(), sizes.tolist()):
            order[e:e + s] = sorted(range(e, e + s), key=whole.__getitem__)
            for k in range(e + 1, e + s):
                a, b = whole[order[k - 1]], whole[order[k]]
                m = min(len(a), len(b))
                differ = np.flatnonzero(np.frombuffer(a[:m], np.uint8) != np.frombuffer(b[:m], np.uint8))
                lcp[k] = differ[0] if len(differ) else m
        return order, lcp


def repeated_strings(group: np.ndarray, raw: np.ndarray, offsets: np.ndarray, left: np.ndarray, window: int):
    """For contexts (bytes, offsets; the anchor ``left`` bytes in) sorted by group: the least and the largest
    offset of their strings that another context of the group holds too (-1: none)."""
    n = len(group)
    size = np.diff(offsets)
    right = size - left
    lowest = window - right  # the strings' offsets before the anchor run from here to ``left``
    total = int(offsets[-1])
    with np.errstate(over="ignore"):
        onward = Suffixes(raw, offsets[:-1] + left, right).order(group)
        backward = Suffixes(raw[::-1].copy(), total - offsets[:-1] - left, left).order(group)
    least, most = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    place = []
    for order, lcp in (onward, backward):
        own = np.empty(n, np.int64)
        own[order] = np.arange(n)
        place.append((own, lcp))
    for o in range(int(lowest.min()) if n else 0, int(left.max()) + 1 if n else 0):
        fit = np.flatnonzero((lowest <= o) & (o <= left))
        if len(fit) < 2:
            continue
        a = np.cumsum(place[0][1] < window - o)[place[0][0][fit]]
        b = np.cumsum(place[1][1] < o)[place[1][0][fit]]
        _, inverse, counts = np.unique(a * (n + 1) + b, return_inverse=True, return_counts=True)
        again = fit[counts[inverse] > 1]
        most[again] = o
        least[again] = np.where(least[again] < 0, o, least[again])
    return least, most


def _contexts(batches):
    """Documents with their anchors -> one row per anchor with the bytes of its strings."""
    import pyarrow as pa
    for b in batches:
        raw, offsets = byte_column(b.column(2))
        want = b.column(4)
        flat = want.flatten()
        of = np.repeat(np.arange(b.num_rows), np.diff(want.offsets.to_numpy()))
        h, p, lo, n = (flat.field(k).to_numpy() for k in ("h", "p", "lo", "n"))
        large = flat.field("large")
        rid = b.column(0).to_numpy()
        for a in range(0, len(h), 8192):
            z = min(a + 8192, len(h))
            start = offsets[:-1][of[a:z]] + lo[a:z]
            own = [raw[s:s + w + WINDOW].tobytes() for s, w in zip(start.tolist(), n[a:z].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(h[a:z]), pa.array(rid[of[a:z]]), pa.array(p[a:z]), pa.array(lo[a:z]),
                                              large[a:z], pa.array(own, pa.binary())], ["h", "rid", "p", "lo", "large", "context"])


@lru_cache(maxsize=1)
def _byte_numbers() -> np.ndarray:
    """A number for each byte, for a second hash that is independent of the first."""
    return mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _strings(batches):
    """Contexts -> one row per string: two hashes of it, and its offset before the anchor."""
    import pyarrow as pa
    for b in batches:
        for at in range(0, b.num_rows, 2048):
            t = b.slice(at, 2048)
            raw, offsets = byte_column(t.column(4))
            with np.errstate(over="ignore"):
                sums, down = _prefix_sums(raw)
                more = np.zeros_like(sums)
                np.cumsum(_byte_numbers()[raw] * _power_tables(len(raw))[0][:len(raw)], out=more[1:])
                n = np.diff(offsets) - WINDOW + 1
                of = np.repeat(np.arange(len(n)), n)
                within = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                i = offsets[:-1][of] + within
                s, v = (mix64((x[i + WINDOW] - x[i]) * down[i]) for x in (sums, more))
            h, rid, p, lo = (t.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            yield pa.RecordBatch.from_arrays([pa.array(h[of]), pa.array(s.view(np.int64)), pa.array(v.view(np.int64)), pa.array(rid[of]), pa.array(p[of]),
                                              pa.array((p[of] - lo[of] - within).astype(np.int32))], ["h", "s", "v", "rid", "p", "o"])


def _large_spans(contexts: DataFrame) -> DataFrame:
    """(rid, a, z) of what the strings of one large group's contexts cover that another context of it holds."""
    rows = contexts.select("h", "rid", "p", "lo", "context").mapInArrow(_strings, "h long, s long, v long, rid long, p int, o int")
    again = written(rows.groupBy("h", "s", "v").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c"), "repeat-strings")
    return (rows.join(again, ["h", "s", "v"]).groupBy("rid", "p").agg(F.min("o").alias("least"), F.max("o").alias("most"))
            .select("rid", (F.col("p") - F.col("most")).cast("long").alias("a"), (F.col("p") - F.col("least") + WINDOW).cast("long").alias("z")))


def _sorted_spans(batches):
    import pyarrow as pa
    for t in whole_groups(batches, "h"):
        raw, offsets = byte_column(t.column("context"))
        h, p, lo = (t.column(k).to_numpy().astype(np.int64) for k in ("h", "p", "lo"))
        least, most = repeated_strings(np.cumsum(np.diff(h, prepend=h[0]) != 0), raw, offsets, p - lo, WINDOW)
        hit = np.flatnonzero(most >= 0)
        yield pa.RecordBatch.from_arrays([pa.array(t.column("rid").to_numpy()[hit]), pa.array(p[hit] - most[hit]),
                                          pa.array(p[hit] - least[hit] + WINDOW)], ["rid", "a", "z"])


def _cut_out(as_text: bool):
    """Documents with covered spans -> what stays: its bytes, or as text its whole characters."""
    def run(batches):
        import pyarrow as pa
        free_caches()
        for b in batches:
            yield _cut(b, pa.string() if as_text else pa.binary())
    return run


def _cut(b, kind):
    import pyarrow as pa
    raw, offsets = byte_column(b.column(2))
    rows = []
    for i, own in enumerate(b.column(4).to_pylist()):
        text = raw[offsets[i]:offsets[i + 1]].tobytes()
        merged: list[list[int]] = []
        for s in sorted((s["a"], s["z"]) for s in own or ()):
            if merged and s[0] <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], s[1])
            else:
                merged.append(list(s))
        kept, at = [], 0
        for a, z in merged:
            kept.append(text[at:a])
            at = z
        kept.append(text[at:])
        body = b"".join(kept)
        rows.append((len(text), sum(z - a for a, z in merged), len(merged),
                     body.decode("utf-8", "ignore") if pa.types.is_string(kind) else body))
    return pa.RecordBatch.from_arrays(
        [b.column(0), b.column(1), b.column(3), *(pa.array([r[i] for r in rows], pa.int64()) for i in range(3)),
         pa.array([r[3] for r in rows], kind)], ["rid", "doc_id", "rest", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, carry: list[str] | None = None, as_text: bool = False, large: int = LARGE,
                   place: str | None = None) -> DataFrame:
    """One row per document: rid (its place), doc_id, rest (the columns to ``carry``), n_bytes, n_removed,
    n_spans, kept (bytes, or with ``as_text`` a string of the characters that were not cut in two).

    ``place``: a column of distinct numbers that is the place, the same in every scan; without it the rows are stored with one.
    """
    rest = F.struct(*(F.col(f"`{c}`") for c in carry)) if carry else F.struct(F.lit(0).alias("none"))
    rid = F.col(f"`{place}`") if place else F.monotonically_increasing_id()
    texts = docs.select(rid.alias("rid"), F.col("doc_id").cast("long").alias("doc_id"),
                        text_or_empty().cast("string").cast("binary").alias("text"), rest.alias("rest"))
    if not place:
        texts = written(texts, "repeat-texts")
    rest_type = texts.schema["rest"].dataType.simpleString()
    rows = texts.select("rid", "doc_id", "text").mapInArrow(_anchor_rows(WINDOW, GRAM), _ANCHORS)
    twice = (rows.groupBy("h").agg(F.count(F.lit(1)).alias("c"), F.min("u").alias("u1"), F.max("u").alias("u2"))
             .filter("c > 1").select("h", (F.col("u1") == F.col("u2")).alias("alike")))
    # stored, so that both sides of the join are plain shuffles and a frequent hash can be split
    twice = written(twice, "repeat-hashes")
    free_shuffles(docs.sparkSession)
    found = written(rows.join(twice, "h"), "repeat-anchors")
    free_shuffles(docs.sparkSession)
    whole = lambda df: df.select("rid", F.col("lo").cast("long").alias("a"), (F.col("lo") + F.col("n") + WINDOW).cast("long").alias("z"))
    mixed = found.filter("NOT alike").drop("alike")
    kinds = written(mixed.groupBy("h", "u").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("rid", "p", "lo", "n")).alias("one")), "repeat-kinds")
    free_shuffles(docs.sparkSession)
    # the few classes that more than a thousandth of the rows belong to find their rows where they are; the rest is joined
    hot = F.col("c") * HOT_SHARE > (kinds.agg(F.sum("c")).first()[0] or 0)
    shared = kinds.filter("c > 1")
    told = mixed.join(F.broadcast(shared.filter(hot).select("h", "u", F.lit(True).alias("_hot"))), ["h", "u"], "left")
    alike = told.filter("_hot").drop("_hot").unionByName(
        told.filter("_hot IS NULL").drop("_hot").join(shared.filter(~hot).select("h", "u"), ["h", "u"], "left_semi"))
    crowded = written(kinds.groupBy("h").count().filter(F.col("count") > large).select("h", F.lit(True).alias("large")), "repeat-large")
    some = not crowded.isEmpty()
    flagged = kinds.select("h", "one.*").join(crowded, "h", "left")
    wanted = flagged.groupBy("rid").agg(F.collect_list(F.struct("h", "p", "lo", "n", "large")).alias("wanted"))
    contexts = (texts.join(wanted, "rid").select("rid", "doc_id", "text", "rest", "wanted")
                .mapInArrow(_contexts, "h long, rid long, p int, lo int, large boolean, context binary"))
    if some:
        contexts = written(contexts, "repeat-contexts")
    edges = (contexts.filter("large IS NULL").drop("large").repartition("h").sortWithinPartitions("h", "rid", "p")
             .mapInArrow(_sorted_spans, "rid long, a long, z long"))
    if some:
        edges = edges.unionByName(_large_spans(contexts.filter("large")))
    covered = (whole(found.filter("alike")).unionByName(whole(alike)).unionByName(edges)
               .groupBy("rid").agg(F.collect_list(F.struct("a", "z")).alias("covered")))
    return (texts.join(covered, "rid", "left").select("rid", "doc_id", "text", "rest", "covered")
            .mapInArrow(_cut_out(as_text), f"rid long, doc_id long, rest {rest_type}, n_bytes long, n_removed long, n_spans long, "
                                           f"kept {'string' if as_text else 'binary'}"))


def repeat_digests(docs: DataFrame) -> DataFrame:
    """The registered query."""
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
