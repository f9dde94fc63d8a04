"""Resume-shaped frames derived from the driver's parquet tables.

* a document is a resume: ``resume_id = doc_id``, ``category = lang``;
* an order is a basket of skills: its parts' ``p_type`` (or ``p_name``);
* a document's resume text carries its order's part names as the SKILLS
  section, the document text as EXPERIENCE, the part types as PROJECTS and
  the source as EDUCATION, so every section step sees real data.

Per-order lists are built from distinct (order, item) pairs first, so a hot
order contributes at most one row per distinct item to its final group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cvlens.session import ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a scan that yields fewer splits than task slots.

    Text steps are CPU-bound per row; a single-row-group file would otherwise
    run on one core. A large input already has enough splits and is left
    as it is (no shuffle).
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < slots:
        return df.repartition(slots)
    return df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def order_items(spark: SparkSession, sf_dir: str, item_col: str = "p_type") -> DataFrame:
    """(order key, items in order of first line number), items distinct per order."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", F.col(item_col).alias("item"))
    firsts = (li.join(part, li.l_partkey == part.p_partkey)
              .groupBy("l_orderkey", "item").agg(F.min("l_linenumber").alias("pos")))
    return (firsts.groupBy("l_orderkey")
            .agg(F.array_sort(F.collect_list(F.struct("pos", "item"))).alias("_s"))
            .select("l_orderkey", F.transform("_s", lambda x: x["item"]).alias("items")))


def order_baskets(spark: SparkSession, sf_dir: str, item_col: str = "p_type") -> DataFrame:
    """One resume per order: (resume_id, category, normalized_skills)."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    items = order_items(spark, sf_dir, item_col)
    return (orders.join(items, orders.o_orderkey == items.l_orderkey)
            .select(F.col("o_orderkey").cast("string").alias("resume_id"),
                    F.col("o_orderpriority").alias("category"),
                    F.col("items").alias("normalized_skills")))


def _document_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, names, types) of the orders that are documents, in one aggregation of their lines."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("l_orderkey"))
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").join(docs, "l_orderkey", "left_semi")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    items = li.join(part, li.l_partkey == part.p_partkey).select(
        "l_orderkey", "l_linenumber", F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("p_name").alias("item")),
                                                        F.struct(F.lit(1).alias("kind"), F.col("p_type").alias("item")))).alias("i"))
    firsts = items.groupBy("l_orderkey", "i.kind", "i.item").agg(F.min("l_linenumber").alias("pos"))
    lists = [F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.struct("pos", "item")))).alias(n)
             for k, n in ((0, "names"), (1, "types"))]
    grouped = firsts.groupBy("l_orderkey").agg(*lists)
    return grouped.select("l_orderkey", *[F.when(F.size(n) > 0, F.transform(n, lambda x: x["item"])).alias(n) for n in ("names", "types")])


def document_resumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(resume_id, category, resume_str) with labelled sections built from the tables."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", "source")
    items = _document_items(spark, sf_dir)
    j = docs.join(items, docs.doc_id == items.l_orderkey, "left")
    text = F.concat(
        F.lit("SKILLS: "), F.coalesce(F.array_join("names", ", "), F.lit("")),
        F.lit("\nEXPERIENCE: "), F.coalesce("text", F.lit("")),
        F.lit("\nPROJECTS: "), F.coalesce(F.array_join("types", ", "), F.lit("")),
        F.lit("\nEDUCATION: "), F.coalesce("source", F.lit("")))
    return j.select(F.col("doc_id").cast("string").alias("resume_id"),
                    F.col("lang").alias("category"), text.alias("resume_str"))


# ---- SQL spellings (DuckDB) ----------------------------------------------

def order_items_sql(item_col: str = "p_type") -> str:
    return f"""(SELECT l_orderkey, list(item ORDER BY pos, item) AS items FROM (
      SELECT l_orderkey, {item_col} AS item, min(l_linenumber) AS pos
      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey, {item_col})
    GROUP BY l_orderkey)"""


def document_resumes_sql() -> str:
    return f"""(SELECT CAST(d.doc_id AS VARCHAR) AS resume_id, d.lang AS category,
      'SKILLS: ' || coalesce(array_to_string(n.items, ', '), '') ||
      chr(10) || 'EXPERIENCE: ' || coalesce(d.text, '') ||
      chr(10) || 'PROJECTS: ' || coalesce(array_to_string(t.items, ', '), '') ||
      chr(10) || 'EDUCATION: ' || coalesce(d.source, '') AS resume_str
    FROM documents d
    LEFT JOIN {order_items_sql('p_name')} n ON d.doc_id = n.l_orderkey
    LEFT JOIN {order_items_sql('p_type')} t ON d.doc_id = t.l_orderkey)"""


def order_baskets_sql(item_col: str = "p_type") -> str:
    return f"""(SELECT CAST(o_orderkey AS VARCHAR) AS resume_id, o_orderpriority AS category,
      i.items AS normalized_skills
    FROM orders JOIN {order_items_sql(item_col)} i ON o_orderkey = i.l_orderkey)"""
