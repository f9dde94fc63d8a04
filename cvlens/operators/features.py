"""Vocabulary, binary skill features, TF-IDF and the train/test split.

The long form (id, index) is the scalable representation; ML vectors are
built from it only where a model needs them. Vocabularies are tables.
"""

from __future__ import annotations

import math

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from cvlens.session import scratch_table, stored

# monotonically_increasing_id is the partition number above 33 bits of position.
_POSITION_BITS = 33


def position_offsets(at: DataFrame, at_col: str = "_at") -> DataFrame:
    """(_part, _offset): rows in the partitions before each one; a row a partition."""
    sizes = at.groupBy(F.shiftright(at_col, _POSITION_BITS).alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))


def add_row_index(df: DataFrame, offsets: DataFrame, idx_col: str, at_col: str = "_at") -> DataFrame:
    """``df`` with ``idx_col``: its partition's offset + its position, from ``at_col``."""
    position = F.col(at_col).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (df.withColumn("_part", F.shiftright(at_col, _POSITION_BITS)).join(offsets, "_part")
            .withColumn(idx_col, F.col("_offset") + position).drop("_part", "_offset", at_col))


def _indexed(df: DataFrame, order_col: str, idx_col: str) -> DataFrame:
    """Attach a 0-based global rank by ``order_col`` to a narrow frame.

    Range-partitioned sort, stored with its positions, then one offset per
    partition; no row passes through Python or a single task.
    """
    ordered = stored(df.orderBy(order_col).withColumn("_at", F.monotonically_increasing_id()), "ordered")
    return add_row_index(ordered, position_offsets(ordered.select("_at")), idx_col).select(*df.columns, idx_col)


def vocabulary(resumes: DataFrame, skills_col: str = "normalized_skills") -> DataFrame:
    """(skill, idx): distinct skills in code-point order; raises when empty."""
    uniq = resumes.select(F.explode(skills_col).alias("skill")).where(F.col("skill").isNotNull()).distinct()
    if uniq.isEmpty():
        raise ValueError("the vocabulary is empty: no resume has a skill")
    return _indexed(uniq, "skill", "idx")


def feature_long(resumes: DataFrame, vocab: DataFrame, skills_col: str = "normalized_skills",
                 id_col: str = "resume_id") -> DataFrame:
    """(id, idx) for every vocabulary skill a resume has; unseen skills are ignored."""
    s = resumes.select(id_col, F.explode(skills_col).alias("skill")).distinct()
    return s.join(vocab, "skill").select(id_col, "idx")


_SPARSE = "struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"


def skill_vectors(resumes: DataFrame, vocab: DataFrame, skills_col: str = "normalized_skills",
                  out_col: str = "features") -> DataFrame:
    """``resumes`` with ``feature_idx`` (the numbers of its skills, ascending) and a binary SparseVector of them.

    Vectors come from the long form: every row keeps a row, even without
    skills, and the names never leave the table. The sparse vector is written
    as its storage layout and read back as a vector, so no row passes through
    Python.
    """
    spark = resumes.sparkSession
    rows = stored(resumes.withColumn("_row", F.monotonically_increasing_id()), "resume-rows")
    size = vocab.count()
    lists = (feature_long(rows, vocab, skills_col, "_row").groupBy("_row")
             .agg(F.array_sort(F.collect_list(F.col("idx").cast("int"))).alias("feature_idx")))
    idx = F.coalesce("feature_idx", F.array().cast("array<int>"))
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), idx.alias("indices"),
                      F.transform(idx, lambda _: F.lit(1.0)).alias("values")).cast(_SPARSE)
    out = (rows.join(lists, "_row", "left").withColumns({"feature_idx": idx, out_col: vector})
           .select(*[F.col(f"`{c}`") for c in resumes.columns if c not in ("feature_idx", out_col)], "feature_idx", out_col))
    path = scratch_table(spark, "skill-vectors")
    out.write.parquet(path)
    fields = [f for f in out.schema.fields if f.name != out_col] + [StructField(out_col, VectorUDT())]
    return spark.read.schema(StructType(fields)).parquet(path)


# ---- text features ------------------------------------------------------------

TOKEN = r"[\p{L}\p{N}_]{2,}"


def tokens(text) -> Column:
    """Lower-cased runs of at least two letters, digits or ``_``, in any script."""
    t = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(F.coalesce(t, F.lit(""))), F.lit(TOKEN), 0)


# Of the terms that more than a thousandth of the documents have, so many are sent to the documents.
FREQUENT = 100_000


def tfidf_long(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """(id, term, weight): raw counts x smooth idf ln((1+n)/(1+df)) + 1, L2 per document; rows of one id are one document.

    Texts are shuffled by document and counted there, so that counts are not. The
    ``frequent`` commonest terms, most of all counts, find their df in the
    documents' own tasks; only counts of the other terms travel to theirs and,
    weighted, back. A document is one row of weights until its norm is known.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit(""))  # null ids are one document
    texts = docs.select(key.alias("_k"), id_col, F.col(text_col).alias("_t")).repartition("_k")
    tf = (texts.select("_k", id_col, F.explode(tokens("_t")).alias("term"))
          .groupBy("_k", id_col, "term").agg(F.count("*").alias("tf")))
    n = docs.count()
    dfreq = stored(tf.groupBy("term").agg(F.count("*").alias("df")), "term-documents")
    common = stored(dfreq.where(F.col("df") * 1000 > n).orderBy(F.desc("df"), "term").limit(frequent).withColumnRenamed("df", "_c"), "common-terms")
    told = tf.join(F.broadcast(common), "term", "left")  # at most ``frequent`` rows
    entry = lambda df: F.struct("term", (F.col("tf") * (F.log((1.0 + n) / (1.0 + F.col(df))) + 1.0)).alias("w"))
    near = told.groupBy("_k", id_col).agg(F.collect_list(F.when(F.col("_c").isNotNull(), entry("_c"))).alias("near"))
    rest = told.where(F.col("_c").isNull()).select("_k", "term", "tf").join(dfreq, "term")
    far = rest.groupBy("_k").agg(F.collect_list(entry("df")).alias("far"))
    whole = near.join(far, "_k", "left").select(id_col, F.concat("near", F.coalesce("far", F.slice("near", 1, 0))).alias("all"))
    norm = F.sqrt(F.aggregate("all", F.lit(0.0), lambda s, e: s + e["w"] * e["w"]))
    return (whole.withColumn("norm", norm).select(id_col, "norm", F.explode("all").alias("e"))
            .select(id_col, "e.term", (F.col("e.w") / F.col("norm")).alias("weight")))


def text_vocabulary(docs: DataFrame, n_docs: int, text_col: str = "text") -> DataFrame:
    """(term, idf, idx) of all terms of the texts, numbered in code-point order; idf = ln((1+n)/(1+df)) + 1."""
    once = docs.select(F.explode(F.array_distinct(tokens(text_col))).alias("term"))
    known = once.groupBy("term").agg((F.log((1.0 + n_docs) / (1.0 + F.count("*"))) + 1.0).alias("idf"))
    return _indexed(known, "term", "idx")


def common_terms(vocab: DataFrame) -> DataFrame:
    """Of the vocabulary's terms that about a thousandth of the documents have or more, the ``FREQUENT`` commonest."""
    return vocab.where(F.col("idf") < 1.0 + math.log(1000)).orderBy("idf", "term").limit(FREQUENT)


def near_and_far(long: DataFrame, common: DataFrame, every: DataFrame, on: str) -> tuple[DataFrame, DataFrame]:
    """``long`` joined with ``every``, by ``on``: what is ``common`` (a part of ``every`` that may be sent to all tasks), and the rest.

    Of the two only the rest, the rarer part, travels.
    """
    near = long.join(F.broadcast(common), on)
    return near, long.join(F.broadcast(common.select(on)), on, "left_anti").join(every.hint("merge"), on)


def term_entries(docs: DataFrame, common: DataFrame, vocab: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(id, term, tf) of every text with the vocabulary's columns: common terms, dealt by id, and the rest; other terms are ignored.

    Texts are shuffled by id and counted there, so that counts are not.
    """
    texts = docs.select(id_col, F.col(text_col).alias("_t")).repartition(id_col)
    counts = texts.select(id_col, F.explode(tokens("_t")).alias("term")).groupBy(id_col, "term").agg(F.count("*").cast("int").alias("tf"))
    return near_and_far(counts, common, vocab, "term")


# ---- split ------------------------------------------------------------------

def split_train_test(df: DataFrame, id_col: str = "resume_id", test_size: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """Add ``split``: the ceil(n * test_size) rows with the smallest md5(seed:id) are test.

    Exact size and repeatable in any SQL engine (not numpy's permutation); rows
    of one id go to one side. The hash at rank k is found by counting hashes by
    prefix (at most 65,536 counts) and ranking the one prefix that holds it;
    rows are then compared with it where they are.
    """
    if not 0 < test_size < 1:
        raise ValueError("test_size must be in (0, 1)")
    hashed = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    h = df.select(hashed.alias("_h"))
    upto = Window.orderBy("_p")
    counts = (h.groupBy(F.substring("_h", 1, 4).alias("_p")).agg(F.count("*").alias("_n"))
              .select("_p", "_n", F.sum("_n").over(upto).alias("_upto"), F.sum("_n").over(Window.partitionBy()).alias("_all")))
    holder = counts.where(F.col("_upto") >= F.ceil(F.col("_all") * F.lit(test_size))).orderBy("_p").first()
    if holder is None:
        return df.withColumn("split", F.lit("train"))
    rank = math.ceil(holder["_all"] * test_size) - (holder["_upto"] - holder["_n"])
    last = h.where(F.substring("_h", 1, 4) == holder["_p"]).orderBy("_h").limit(rank).agg(F.max("_h")).first()[0]
    return df.withColumn("split", F.when(hashed <= F.lit(last), "test").otherwise("train"))
