"""Sharding by a two-pass external shuffle, with DataFrame functions only.

Pass 1 scatters the records uniformly into memory-sized buckets by a seeded
hash. Pass 2 gives each bucket a Fisher-Yates shuffle (Spark's ``shuffle`` on
the bucket's array) and writes it: record ``i`` of the shuffled corpus (its
bucket's offset + its place there) goes to shard ``i mod n_shards``, slot
``i div n_shards``, so shard sizes differ by one record at most.

The scatter hash takes the record's place beside its key, so repeated rows, or
one id on a third of all rows, spread like any others. The place of a file's
row is its file and its number in it, the same in every scan however it is
split; a frame that is not read from files is stored first. The draw is fixed
by seed and layout of the input: records are sorted by place before they are
shuffled, so a retried task draws the same permutation.

Null and empty texts are records of size 1 (their bytes plus 1). An empty
table writes no rows. Columns named like the operator's own (``shard``,
``slot``) are replaced.

Scale: the text is shuffled once; buckets hold about ``bucket_bytes`` and are
dealt to as many tasks by a hash, so a task may get a few; one row per bucket
(bucket, records) meets in the running sum of the offsets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cvlens.llm.common import has_file_rows, scratch, scan_place, written

BUCKET_BYTES = 32 << 20
# Bytes counted for a row beside its text.
ROW_BYTES = 128


def two_pass_shuffle(docs: DataFrame, path: str, n_shards: int = 16, seed: int = 17, key: str = "doc_id",
                     text: str = "text", bucket_bytes: int = BUCKET_BYTES) -> None:
    """Write ``docs`` to ``path`` as Parquet, partitioned by ``shard``, with ``slot`` in each shard's order."""
    if n_shards < 1 or bucket_bytes < 1:
        raise ValueError("n_shards and bucket_bytes are at least 1")
    if not has_file_rows(docs):
        docs = written(docs, "shard-input")
    keep = [c for c in docs.columns if c not in ("shard", "slot")]
    total = docs.select(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES)).first()[0] or 0
    n_buckets = max(1, -(-int(total) // bucket_bytes))
    place = scan_place(docs)
    bucket = F.pmod(F.xxhash64(F.lit(seed), F.col(f"`{key}`"), place), F.lit(n_buckets)).cast("int")
    placed = docs.select(bucket.alias("bucket"), place.alias("place"), F.struct(*[F.col(f"`{c}`") for c in keep]).alias("r"))
    sizes = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    by_place = lambda a, b: F.when(a["place"] < b["place"], -1).when(a["place"] > b["place"], 1).otherwise(0)
    # the one exchange of the records: grouping and join go by the same hash of the bucket
    buckets = (placed.repartition(n_buckets, "bucket").groupBy("bucket").agg(F.collect_list(F.struct("place", "r")).alias("records"))
               .join(offsets, "bucket").select("first", F.shuffle(F.array_sort("records", by_place), seed).alias("records")))
    rows = buckets.select("first", F.posexplode("records").alias("at", "record"))
    at = F.col("first") + F.col("at")
    (rows.select(*[F.col("record.r")[c].alias(c) for c in keep], F.pmod(at, F.lit(n_shards)).cast("int").alias("shard"),
                 F.floor(at / n_shards).cast("long").alias("slot"))
     .sortWithinPartitions("shard", "slot").write.partitionBy("shard").option("compression", "zstd").parquet(path))


def read_shards(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def shard_digests(docs: DataFrame, n_shards: int = 16) -> DataFrame:
    """The registered query: write the shards, read them back, and digest each record."""
    spark = docs.sparkSession
    path = scratch(spark, "shards")
    two_pass_shuffle(docs, path, n_shards)
    schema = "doc_id long, text string, slot long, shard int"
    out = read_shards(spark, path, schema)
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return out.select("doc_id", (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
                      F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
