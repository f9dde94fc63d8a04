"""SimHash near-duplicates by anchor-point covering.

A document's fingerprint holds, for each of 64 bits, whether it is set in over
half of the XXH64 values of its word shingles. Fingerprints at ``threshold`` or
fewer differing bits are linked; connected documents form a component.

Anchors are the codewords of a covering code, so that every fingerprint lies
within the covering radius of one. The code is a product of perfect codes over
blocks of the 64 bits: the binary Golay code twice (23 bits, radius 3) and the
repetition code of 9 bits twice (radius 4). Perfect means that exactly one
codeword of a block is within its radius, so a fingerprint has one home anchor.
If two fingerprints differ in t bits, the home of one is at most its radius
plus t away from the other, and the excesses over the radii of the blocks add
up to at most t. So each fingerprint is copied to every anchor whose excesses
add up to ``threshold`` or less (about 70 of 2^26), and at each anchor the
fingerprints that live there are compared with all that came.

Only different fingerprints are compared: copies of a document, of whatever
number, are one row with their least doc_id. Anchors at which more than
``crowd`` different fingerprints live are left to the finest code, of which every
64-bit word is a codeword (radius 0): what lives at or came to a crowded anchor
is copied to all words within half the threshold. Two fingerprints within the
threshold meet at a word between them, and at most 65 (for threshold 2) meet at
one. No links are lost either way, and no group is larger than the code allows.

Words are runs of bytes other than ASCII white space, after A-Z is
lower-cased; shingles are ``size`` words joined by one blank, repeats included.
Null texts count as empty; a text of fewer words is one shingle, a text of none
has fingerprint zero and is linked like any other. A null doc_id gets a
component like others, whose name it is only if all its documents have none.
Repeated rows are rows of their own. An empty table gives an empty result. Very
long texts are hashed whole, in slices. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cvlens.llm.common import byte_column, free_caches, written
from cvlens.llm.groups import components
from cvlens.session import ship_package

SHINGLE = 3
THRESHOLD = 2
CROWD = 1024
# Fingerprints of more rows than this share of all (so at most 1,000 of them) are joined back apart from the rest.
HOT_SHARE = 1000
SEED = 42
# Hashes whose bits are counted at once.
SLICE = 1 << 14

# x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, a generator of the binary Golay code.
GOLAY = 0b101011100011
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_hashes(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of every shingle of a text."""
    from xxhash import xxh64_intdigest
    words = text.translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) >= size:
        starts, ends = starts[:len(words) - size + 1], ends[size - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    return np.array([xxh64_intdigest(joined[a:z], SEED) for a, z in zip(starts.tolist(), ends.tolist())], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The word of the bits that are set in over half of the hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), SLICE):
        raw = hashes[at:at + SLICE].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(raw, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint of every row, as a signed long of the same bits."""
    def hashed(batches):
        import pyarrow as pa
        free_caches()
        for b in batches:
            raw, edge = byte_column(b.column(1))
            fp = [majority(shingle_hashes(raw[a:z].tobytes(), size)) for a, z in zip(edge[:-1].tolist(), edge[1:].tolist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(fp, np.uint64).view(np.int64))], ["doc_id", "fp"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(hashed, "doc_id long, fp long"))


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words modulo the Golay generator."""
    out = words.copy()
    for bit in range(22, 10, -1):
        out ^= np.where(out >> bit & 1, GOLAY << (bit - 11), 0)
    return out


class _Block:
    """Near codewords of one block: for each class of words, the differences to them by their excess."""

    def __init__(self, at: int, bits: int, radius: int, classes: np.ndarray, patterns: np.ndarray, excess: np.ndarray, n: int):
        self.at, self.mask, self.radius, self.n = at, (1 << bits) - 1, radius, n
        order = np.lexsort((excess, classes))
        self.patterns, self.excess = patterns[order].astype(np.uint64), excess[order]
        classes = classes[order]
        self.first = np.searchsorted(classes, np.arange(n))
        most = int(excess.max())
        # upto[e, c]: patterns of class c with excess at most e; at[..] are in order of excess
        self.upto = np.stack([np.bincount(classes[self.excess <= e], minlength=n) for e in range(most + 1)])

    def class_of(self, words: np.ndarray) -> np.ndarray:
        own = (words >> np.uint64(self.at) & np.uint64(self.mask)).astype(np.int64)
        return _syndromes(own) if self.n == 2048 else own


@lru_cache(maxsize=2)
def covering_code(threshold: int = THRESHOLD) -> tuple[_Block, ...]:
    """The blocks of the product code with all patterns of excess up to ``threshold``."""
    errors, weights = [0], [0]
    for w in range(1, 3 + threshold + 1):
        own = [sum(1 << i for i in bits) for bits in combinations(range(23), w)]
        errors += own
        weights += [w] * len(own)
    errors, weights = np.array(errors, np.int64), np.array(weights)
    golay = (_syndromes(errors), errors, np.maximum(weights - 3, 0), 2048)
    words = np.arange(512)
    weight = np.array([int(w).bit_count() for w in words])
    # the codewords of a repetition code are zero and all ones
    classes, patterns = np.concatenate([words, words]), np.concatenate([words, words ^ 511])
    excess = np.maximum(np.concatenate([weight, 9 - weight]) - 4, 0)
    near = excess <= threshold
    pair = (classes[near], patterns[near], excess[near], 512)
    return (_Block(0, 23, 3, *golay), _Block(23, 23, 3, *golay), _Block(46, 9, 4, *pair), _Block(55, 9, 4, *pair))


def anchors(words: np.ndarray, threshold: int = THRESHOLD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, excess) of every anchor of each word; excess 0 marks its home."""
    rows, anchor, left = np.arange(len(words)), words.astype(np.uint64), np.full(len(words), threshold)
    for block in covering_code(threshold):
        cls = block.class_of(words)[rows]
        many = block.upto[np.minimum(left, len(block.upto) - 1), cls]
        of = np.repeat(np.arange(len(rows)), many)
        pick = np.repeat(block.first[cls], many) + np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
        rows, left = rows[of], left[of] - block.excess[pick]
        anchor = anchor[of] ^ (block.patterns[pick] << np.uint64(block.at))
    return rows, anchor, threshold - left


def ball(words: np.ndarray, radius: int) -> Iterator[np.ndarray]:
    """All words within ``radius`` of each, one difference at a time."""
    for w in range(radius + 1):
        for bits in combinations(range(64), w):
            yield words ^ np.uint64(sum(1 << i for i in bits))


def _deal(batches, threshold: int):
    """(anchor, fp, home) of every anchor of the fingerprints."""
    import pyarrow as pa
    for b in batches:
        for at in range(0, b.num_rows, 2048):
            words = b.column(0).slice(at, 2048).to_numpy(zero_copy_only=False).view(np.uint64)
            row, anchor, excess = anchors(words, threshold)
            yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(words[row].view(np.int64)), pa.array(excess == 0)],
                                             ["anchor", "fp", "home"])


def _between(batches, radius: int):
    """(point, fp) of every word within ``radius`` of the fingerprints."""
    import pyarrow as pa
    for b in batches:
        words = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for near in ball(words, radius):
            yield pa.RecordBatch.from_arrays([pa.array(near.view(np.int64)), b.column(0)], ["point", "fp"])


def links(prints: DataFrame, threshold: int = THRESHOLD, crowd: int = CROWD) -> DataFrame:
    """(a, b): pairs of the different fingerprints ``fp`` that connect all that are within the threshold."""
    if threshold not in (0, 2):
        raise ValueError("threshold is 0 or 2: others have no word midway between any two linked fingerprints, or too many patterns")
    homes = written(prints.select("fp").mapInArrow(
        lambda batches: _home(batches, threshold), "anchor long, fp long"), "simhash-homes")
    crowded = written(homes.groupBy("anchor").count().filter(F.col("count") > crowd).select("anchor"), "simhash-crowded")
    some = not crowded.isEmpty()
    calm = homes.join(crowded, "anchor", "left_anti") if some else homes
    # both ends live at anchors that are not crowded: the smaller one's home sees the pair
    came = calm.select("fp").mapInArrow(lambda batches: _deal(batches, threshold), "anchor long, fp long, home boolean")
    # Spark sizes the copies like the table they come from (about 70 times less): never left to a broadcast
    near = (calm.withColumnRenamed("fp", "a").join(came.withColumnRenamed("fp", "b").hint("merge"), "anchor")
            .filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= threshold)).select("a", "b"))
    if not some:
        return near
    # an end at a crowded anchor: all that live there or come there meet at the words between them
    came = prints.select("fp").mapInArrow(lambda batches: _deal(batches, threshold), "anchor long, fp long, home boolean")
    dense = came.join(crowded, "anchor", "left_semi").select("fp").distinct()
    # at most one fingerprint per word of a ball, and any two of a ball are linked: the least one to each will do
    meet = (dense.mapInArrow(lambda batches: _between(batches, threshold // 2), "point long, fp long").groupBy("point")
            .agg(F.collect_set("fp").alias("all")).filter(F.size("all") > 1))
    return near.unionByName(meet.select(F.array_min("all").alias("a"), F.explode("all").alias("b")).filter("a < b").distinct())


def _home(batches, threshold: int):
    import pyarrow as pa
    for b in batches:
        words = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        _, anchor, _ = anchors(words, 0)
        yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), b.column(0)], ["anchor", "fp"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                    threshold: int = THRESHOLD, crowd: int = CROWD) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    ship_package(docs.sparkSession)
    marked = written(fingerprints(docs, id_col, text_col, size), "simhash-rows")
    prints = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "simhash-prints")
    label = components(written(links(prints, threshold, crowd), "simhash-links")).withColumnRenamed("node", "fp")
    named = prints.join(label, "fp", "left").select("fp", "least", "n", F.coalesce("label", "fp").alias("label"))
    first = named.groupBy("label").agg(F.min("least").alias("component_id"))
    known = written(named.join(first, "label").select("fp", "n", "component_id"), "simhash-named")
    # the few fingerprints that many rows share go to the rows, which stay where they are; the rest is joined
    hot = F.col("n") * HOT_SHARE > marked.count()
    told = marked.join(F.broadcast(known.filter(hot).select("fp", F.col("component_id"), F.lit(True).alias("_hot"))), "fp", "left")
    out = told.filter("_hot").select("doc_id", "fp", "component_id").unionByName(
        told.filter("_hot IS NULL").select("doc_id", "fp").join(known.filter(~hot).select("fp", "component_id"), "fp")
        .select("doc_id", "fp", "component_id"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
