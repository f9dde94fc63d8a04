"""The corpus pipeline: toxicity, exact dedup, near dedup, repeated passages, packing.

Each stage takes all documents that the one before it kept and returns them
with the columns of ``documents`` (and any others that came along, whatever
their names); the last returns the packed pieces.

* toxicity: documents that score 0.5 or more go;
* exact_dedup: of texts equal but for the case of A-Z the largest doc_id stays;
* near_dedup: of each class of linked documents (five-word shingles, Jaccard
  0.8) the least doc_id stays;
* repeated_passages: bytes of 200-byte strings that start twice are cut out; a
  character that is cut in two goes whole; n_chars follows the text;
* packing: one row per piece of at most 4096 tokens, with its sequence.

Null texts are kept as they are (null) up to packing, where they are empty. A
document whose text is cut out whole stays with an empty text. Rows that are
equal in all columns are documents of their own; dedup keeps one of them. Empty
tables give empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cvlens.llm import chosen_path, exact_dedup, packing, suffix_dedup, toxicity
from cvlens.llm.common import numbered_scan, scratch, table, written
from cvlens.session import ship_package

def _free_name(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    while name in docs.columns:
        name += "_"
    return name


def _placed(docs: DataFrame) -> tuple[DataFrame, str]:
    """(``docs`` with each row's place, the place's column).

    A stored table's rows are told by their files; any other frame is stored first, as another scan may be split otherwise.
    """
    place = _free_name(docs, "place")
    scan = numbered_scan(docs, place)
    return (written(docs.withColumn(place, F.monotonically_increasing_id()), "stage-places") if scan is None else scan), place


def _stay(placed: DataFrame, place: str, places: DataFrame) -> DataFrame:
    """The rows of ``placed`` whose place is in ``places`` (rid), without it."""
    return (placed.join(places.select(F.col("rid").alias(place)), place, "left_semi")
            .select(*(F.col(f"`{c}`") for c in placed.columns if c != place)))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels)
    return docs.filter(toxicity.score_column(spark, model) < 0.5)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    placed, place = _placed(docs)
    return _stay(placed, place, exact_dedup.exact_groups(placed, keep="max", place=place).filter("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    placed, place = _placed(docs)
    classes = chosen_path.near_duplicates(placed, place=place)
    first = classes.groupBy("class_rid").agg(F.min(F.struct("doc_id", "rid")).alias("first"))
    return _stay(placed, place, first.select("first.rid"))


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)

    names, given = docs.columns, _free_name(docs, "given")
    placed, place = _placed(docs)
    # the text goes along once: of the column itself only whether it is null
    cut = suffix_dedup.remove_repeats(placed.withColumn(given, F.col("text").isNotNull()),
                                      [*(c for c in names if c != "text"), given], as_text=True, place=place)
    text = F.when(F.col(f"rest.{given}"), F.col("kept"))
    cut = cut.select(*(text.alias("text") if c == "text" else F.col(f"rest.`{c}`").alias(c) for c in names))
    if "n_chars" in names:
        cut = cut.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text"))
                             .otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return cut.select(*(F.col(f"`{c}`") for c in names))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("repeated_passages", cut_passages),
    ("packing", pack),
]

# Toxicity is a learned model, so SQL can't give run()'s rows; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
