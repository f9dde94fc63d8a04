"""Target-distribution importance resampling by hashed n-grams.

A document is drawn by how much likelier its word n-grams are under a target
text collection than under the documents themselves, with Gumbel noise that
makes the highest scores a draw without replacement.

* Words: a 256-byte table lower-cases A-Z and blanks every ASCII byte that is
  no letter or digit (``bytes.translate``); ``bytes.split`` gives the words. Bytes
  from 0x80 on belong to words, so the UTF-8 text is never decoded.
* Features: the crc32 of a word, extended over ``b" " + next word`` by passing it
  as the seed of the next ``zlib.crc32``, is the crc32 of the joined n-gram; its
  remainder is the bucket. Counters reduce the features of a batch to buckets.
* ``gain`` of a bucket is ``floor(1000 ln((t+1)(S+B) / ((s+1)(T+B))))``; a document's
  weight is the sum of its features' gains.
* ``score = weight + floor(-1000 ln(-ln u))``, u from sha256 of ``seed:doc_id``.
* Of the documents with ``min_words`` words, ``floor(percent * N / 100)`` of the highest
  scores are drawn, ties to the smaller doc_id, and numbered from 1.

Null texts count as empty: no features, weight 0, never drawn. A null doc_id
hashes as an empty name and comes after others in a tie. Rows that share a
doc_id are documents of their own, in an undefined order among equals. An
empty target or corpus counts zero everywhere; an empty table gives an empty
result. Very long texts are processed whole, one at a time. Other columns are not read.

Scale: two passes over the texts (counts, then weights); the driver holds one
number a bucket. Ranks come from a range-partitioned sort of (score, doc_id,
place), stored with its positions, and one offset a partition.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cvlens.llm.common import byte_column, free_caches, written
from cvlens.session import ship_package

BUCKETS = 10_000
MAX_N = 1
MIN_WORDS = 20
PERCENT = 10
SEED = 2024

# A-Z to a-z; digits, a-z and every byte of a non-ASCII character stay; the rest is blank.
WORD_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_TABLE).split()


def feature_hashes(words: list[bytes], max_n: int = MAX_N) -> Iterator[list[int]]:
    """For n = 1, 2, ... the crc32 of every run of n words joined by one blank."""
    hashes = list(map(zlib.crc32, words))
    for n in range(1, max_n + 1):
        if n > 1:
            hashes = [zlib.crc32(b" " + w, h) for h, w in zip(hashes, words[n - 1:])]
        yield hashes


def _texts(column) -> Iterator[bytes]:
    raw, edge = byte_column(column)
    for a, z in zip(edge[:-1].tolist(), edge[1:].tolist()):
        yield raw[a:z].tobytes()


def bucket_counts(texts: DataFrame, col: str = "text", max_n: int = MAX_N, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall in each bucket."""
    def count(batches):
        import pyarrow as pa
        free_caches()
        total: Counter[int] = Counter()
        for b in batches:
            own: Counter[int] = Counter()
            for t in _texts(b.column(0)):
                for hashes in feature_hashes(words_of(t), max_n):
                    own.update(hashes)
            for h, n in own.items():
                total[h % buckets] += n
        yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.int32()), pa.array(total.values(), pa.int64())], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    parts = texts.select(F.col(col).cast("string").alias("text")).mapInArrow(count, "bucket int, n long")
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The whole gain of each bucket."""
    buckets = len(corpus)
    all_corpus, all_target = float(corpus.sum() + buckets), float(target.sum() + buckets)
    return np.array([math.floor(1000 * math.log((float(t + 1) * all_corpus) / (float(s + 1) * all_target)))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def noise(doc_id, seed: int = SEED) -> int:
    """Whole Gumbel noise of a document, from the first 32 bits of its hash."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighted(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", max_n: int = MAX_N,
             seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row."""
    buckets = len(gain)

    def weigh(batches):
        import pyarrow as pa
        for b in batches:
            ids = b.column(0).to_pylist()
            n_words, n_features, weight = (np.zeros(len(ids), np.int64) for _ in range(3))
            for i, t in enumerate(_texts(b.column(1))):
                words = words_of(t)
                n_words[i] = len(words)
                for hashes in feature_hashes(words, max_n):
                    n_features[i] += len(hashes)
                    weight[i] += gain[np.array(hashes, np.int64) % buckets].sum()
            score = weight + np.array([noise(d, seed) for d in ids], np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, (n_words, n_features, weight, score))],
                                             ["doc_id", "n_words", "n_features", "weight", "score"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long, score long"))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, max_n: int = MAX_N,
             buckets: int = BUCKETS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score and rank (null: not drawn) of every row of ``docs``."""
    spark = docs.sparkSession
    ship_package(spark)
    gain = gains(bucket_counts(docs, text_col, max_n, buckets), bucket_counts(target, "text", max_n, buckets))
    scored = written(weighted(docs, gain, id_col, text_col, max_n, seed).withColumn("_place", F.monotonically_increasing_id()), "scored")
    long_enough = F.col("n_words") >= min_words
    # the place spreads a doc_id that many rows share; a stored position is its partition and the place in it
    ordered = (scored.filter(long_enough).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), "_place")
               .withColumn("_at", F.monotonically_increasing_id()))
    ordered = written(ordered, "by-score")
    part = F.shiftright("_at", 33)
    sizes = ordered.groupBy(part.alias("_part")).count().orderBy("_part").collect()  # one row a partition
    drawn = percent * sum(r["count"] for r in sizes) // 100
    before, offsets = 0, []
    for r in sizes:
        offsets.append((r["_part"], before))
        before += r["count"]
    starts = spark.createDataFrame(offsets, "_part long, _before long")
    rank = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    ranked = (ordered.withColumn("_part", part).join(F.broadcast(starts), "_part")
              .withColumn("rank", F.when(rank <= drawn, rank)))
    rest = scored.filter(~long_enough).withColumn("rank", F.lit(None).cast("long"))
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    return ranked.select(columns).unionByName(rest.select(columns))


def oracle_sql(buckets: int = BUCKETS, min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED) -> str:
    """DuckDB spelling of single-word resampling of ``documents`` towards ``benchmark``; crc32 is spelt out on distinct words."""
    def words(table):
        return (f"SELECT *, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
                f"'[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS ws FROM {table}")
    return f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, * FROM ({words('documents')})),
      b AS MATERIALIZED ({words('benchmark')}),
      dw AS MATERIALIZED (SELECT rid, unnest(ws) AS w FROM d), bw AS MATERIALIZED (SELECT unnest(ws) AS w FROM b),
      tab AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(range(8),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c FROM range(256) r(i))),
      vocab AS MATERIALIZED (SELECT w, hex(encode(w)) AS hx FROM (SELECT w FROM dw UNION SELECT w FROM bw)),
      hashed AS MATERIALIZED (SELECT w, xor(list_reduce(list_transform(range(length(hx) // 2),
          lambda i: (strpos('0123456789ABCDEF', substr(hx, 2 * i + 1, 1)) - 1) * 16 + strpos('0123456789ABCDEF', substr(hx, 2 * i + 2, 1)) - 1),
        lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)]), 4294967295), 4294967295) % {buckets} AS bucket FROM vocab, tab),
      s AS (SELECT bucket, count(*) AS s FROM dw JOIN hashed USING (w) GROUP BY bucket),
      t AS (SELECT bucket, count(*) AS t FROM bw JOIN hashed USING (w) GROUP BY bucket),
      gain AS MATERIALIZED (SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM dw) + {buckets})::DOUBLE)
          / ((s + 1)::DOUBLE * ((SELECT count(*) FROM bw) + {buckets})::DOUBLE)))::BIGINT AS g FROM s LEFT JOIN t USING (bucket)),
      weights AS (SELECT rid, sum(g)::BIGINT AS weight FROM dw JOIN hashed USING (w) JOIN gain USING (bucket) GROUP BY rid),
      scored AS MATERIALIZED (SELECT doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
          (('0x' || substr(sha256('{seed}:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
        FROM d LEFT JOIN weights USING (rid)),
      ranked AS (SELECT *, CASE WHEN n_features >= {min_words} THEN row_number() OVER (
          PARTITION BY n_features >= {min_words} ORDER BY score DESC, doc_id) END AS place FROM scored)
    SELECT doc_id, n_features, weight, score,
      CASE WHEN place <= {percent} * (SELECT count(*) FROM scored WHERE n_features >= {min_words}) // 100 THEN place END AS rank FROM ranked"""
