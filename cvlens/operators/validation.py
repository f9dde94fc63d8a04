"""Comparing two extractions of the same documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cvlens.functions.text import clean_text, split_words, strip_ws


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def length_similarity(a, b) -> Column:
    """min/max length of lower+stripped texts; both empty 1, one empty 0."""
    la, lb = F.length(F.lower(strip_ws(_c(a)))), F.length(F.lower(strip_ws(_c(b))))
    return (F.when((la == 0) & (lb == 0), F.lit(1.0)).when((la == 0) | (lb == 0), F.lit(0.0))
            .otherwise(F.least(la, lb) / F.greatest(la, lb)))


def skill_jaccard(a, b) -> Column:
    """Jaccard of lower-cased skill sets; both empty 1, one empty 0."""
    sa = F.array_distinct(F.transform(F.coalesce(_c(a), F.array().cast("array<string>")), F.lower))
    sb = F.array_distinct(F.transform(F.coalesce(_c(b), F.array().cast("array<string>")), F.lower))
    na, nb = F.size(sa), F.size(sb)
    return (F.when((na == 0) & (nb == 0), F.lit(1.0)).when((na == 0) | (nb == 0), F.lit(0.0))
            .otherwise(F.size(F.array_intersect(sa, sb)) / F.size(F.array_union(sa, sb))))


def extraction_report(pairs: DataFrame, csv_text: str = "csv_text", pdf_text: str = "pdf_text",
                      csv_skills: str = "csv_skills", pdf_skills: str = "pdf_skills") -> DataFrame:
    """One row: sample count, mean/population std of text similarity and skill
    overlap, extraction accuracy = mean of the two means."""
    per = pairs.select(length_similarity(csv_text, pdf_text).alias("ts"),
                       skill_jaccard(csv_skills, pdf_skills).alias("so"))
    return (per.agg(F.count("*").alias("total_samples"), F.avg("ts").alias("text_similarity_mean"),
                    F.stddev_pop("ts").alias("text_similarity_std"), F.avg("so").alias("skill_overlap_mean"),
                    F.stddev_pop("so").alias("skill_overlap_std"))
            .withColumn("extraction_accuracy", (F.col("text_similarity_mean") + F.col("skill_overlap_mean")) / 2))


def pair_validation(pairs: DataFrame, id_col: str = "resume_id", pdf_text: str = "pdf_text",
                    csv_text: str = "csv_text", error_col: str | None = None) -> DataFrame:
    """Per pair: cleaned lengths, length ratio, word containment, success.

    Success is decided on unrounded values (ratio in [0.7, 1.3] and
    containment >= 0.6); the reported ratio and similarity are rounded to 3
    places, half to even like Python's ``round``. With an ``error_col``, a pair
    whose extraction failed is a row of zeros with the raw length of the CSV
    text, no success, and its ``error``.
    """
    pc, cc = clean_text(pdf_text), clean_text(csv_text)
    pw = F.array_distinct(split_words(F.lower(pc)))
    cw = F.array_distinct(split_words(F.lower(cc)))
    error = F.col(error_col) if error_col else F.lit(None).cast("string")
    df = pairs.select(F.col(id_col), error.alias("error"), F.length(F.coalesce(F.col(csv_text), F.lit(""))).alias("_raw"), F.length(pc).alias("pdf_length"), F.length(cc).alias("csv_length"),
                      F.size(F.array_intersect(pw, cw)).alias("_hit"), F.size(cw).alias("_cw"))
    ratio = F.when(F.col("csv_length") > 0, F.col("pdf_length") / F.col("csv_length")).otherwise(0.0)
    sim = F.when(F.col("_cw") > 0, F.col("_hit") / F.col("_cw")).otherwise(0.0)
    df = df.withColumn("_ratio", ratio).withColumn("_sim", sim)
    failed = F.col("error").isNotNull()
    out = df.select(
        id_col, F.when(failed, 0).otherwise(F.col("pdf_length")).alias("pdf_length"),
        F.when(failed, F.col("_raw")).otherwise(F.col("csv_length")).alias("csv_length"),
        F.when(failed, 0.0).otherwise(F.bround("_ratio", 3)).alias("length_ratio"),
        F.when(failed, 0.0).otherwise(F.bround("_sim", 3)).alias("text_similarity"),
        (~failed & F.col("_ratio").between(0.7, 1.3) & (F.col("_sim") >= 0.6)).alias("extraction_success"), "error")
    return out if error_col else out.drop("error")


def archive_validation(details: DataFrame) -> DataFrame:
    """One row summarising ``pair_validation`` output; zeros when empty."""
    agg = details.agg(
        F.count("*").alias("total_validated"),
        F.count_if("extraction_success").alias("successful_extractions"),
        F.avg("length_ratio").alias("_r"), F.avg("text_similarity").alias("_s"))
    total = F.col("total_validated")
    return agg.select(
        "total_validated", "successful_extractions",
        (total - F.col("successful_extractions")).alias("failed_extractions"),
        F.when(total > 0, F.bround(F.col("successful_extractions") / total, 3)).otherwise(0.0).alias("success_rate"),
        F.coalesce(F.bround("_r", 3), F.lit(0.0)).alias("average_length_ratio"),
        F.coalesce(F.bround("_s", 3), F.lit(0.0)).alias("average_similarity"))


def last_per_key(df: DataFrame, key: str, order_col: str) -> DataFrame:
    """The last row per key by ``order_col`` (later rows overwrite earlier ones).

    ``max_by`` is a partial aggregate: a hot key is combined map-side, not
    gathered into one task.
    """
    others = [c for c in df.columns if c != key]
    return (df.groupBy(key).agg(F.max_by(F.struct(*others), F.col(order_col)).alias("_r"))
            .select(key, "_r.*"))


def align_sources(a: DataFrame, b: DataFrame, key: str, a_order: str, b_order: str) -> DataFrame:
    """Inner alignment of two sources on ``key`` after keeping each side's last row."""
    return last_per_key(a, key, a_order).join(last_per_key(b, key, b_order), key)


def unmatched_counts(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: keys in both, only in a, only in b (distinct keys); ``require_overlap`` refuses none in both."""
    ka = a.select(key).distinct().withColumn("_a", F.lit(True))
    kb = b.select(key).distinct().withColumn("_b", F.lit(True))
    j = ka.join(kb, key, "full")
    out = j.agg(F.count_if(F.col("_a") & F.col("_b")).alias("matched"),
                F.count_if(F.col("_b").isNull()).alias("only_first"),
                F.count_if(F.col("_a").isNull()).alias("only_second"))
    return out


def require_overlap(counts: DataFrame) -> None:
    if counts.first()["matched"] == 0:
        raise ValueError("no common ids between the two sources")
