"""From resumes of any source to structured resumes, features and clusters.

``structure_resumes`` takes the frame of any reader (CSV, archive, tables):
(resume_id, category, resume_str[, source]). Everything up to normalisation is
row by row; ``cluster_resumes`` runs skills -> matrix -> K-means -> report.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cvlens import sinks
from cvlens.functions.sections import SECTION_NAMES, add_sections
from cvlens.functions.text import clean_text
from cvlens.operators import cluster as K
from cvlens.operators import features as FE
from cvlens.operators.skills import dictionary_terms, explicit_skills, find_terms, normalize_skills
from cvlens.session import free_shuffles, stored


def extract_skills(resumes: DataFrame, aliases: DataFrame, text_col: str = "resume_str", keep_texts: bool = True) -> DataFrame:
    """``resumes`` with clean, its sections, explicit_skills, implicit_skills and skills (both, in order).

    Without ``keep_texts`` the text, clean and the sections are not returned, and of
    them only what implicit skills are looked for in is stored.
    """
    cut = add_sections(resumes.withColumn("clean", clean_text(text_col)), "clean", prefix="sec_")
    told = F.concat_ws("\n", "sec_experience", "sec_projects")
    cut = cut.withColumn("explicit_skills", explicit_skills("sec_skills"))
    if not keep_texts:
        cut = cut.withColumn("_told", told).drop(text_col, "clean", *[f"sec_{n}" for n in SECTION_NAMES])
    base = stored(cut.withColumn("_row", F.monotonically_increasing_id()), "sections")
    free_shuffles(base.sparkSession)
    told = base.select("_row", told.alias("_told") if keep_texts else "_told")
    found = find_terms(told, dictionary_terms(aliases), "_row", "_told")
    implicit = F.coalesce("implicit_skills", F.array().cast("array<string>"))
    return (base.join(found, "_row", "left").withColumn("implicit_skills", implicit)
            .withColumn("skills", F.concat("explicit_skills", "implicit_skills")).drop("_row", "_told"))


def structure_resumes(resumes: DataFrame, aliases: DataFrame, cutoff: float = 85.0, keep_texts: bool = True) -> DataFrame:
    """Structured resumes (the nested document of ``sinks.STRUCTURED_RESUME``).

    A reader's ``_error`` column goes along: a row with an error is not processed
    and keeps its id, category, source and error, with the rest null. Rows
    without text or id fail here (``no text``, ``no id``), so one bad row stops
    no other. ``split_faults`` takes the two kinds apart. Without ``keep_texts``
    there is no ``sections`` column, and the texts are not carried through the steps.
    """
    given = "_error" in resumes.columns
    here = F.when(F.col("resume_id").isNull(), F.lit("no id")).when(F.col("resume_str").isNull(), F.lit("no text"))
    error = F.coalesce("_error", here) if given else here
    source = F.col("source") if "source" in resumes.columns else F.lit(None).cast("string")
    rows = resumes.select("resume_id", "category", source.alias("source"), error.alias("_error"),
                          F.when(error.isNull(), F.col("resume_str")).alias("resume_str"))
    done = normalize_skills(extract_skills(rows, aliases, keep_texts=keep_texts), aliases, "skills", cutoff)
    fine = F.col("_error").isNull()
    texts = [F.when(fine, F.struct(*[F.col(f"sec_{n}").alias(n) for n in SECTION_NAMES], F.col("clean").alias("raw_text"))).alias("sections")] if keep_texts else []
    return done.select(
        "resume_id", F.col("category").alias("job_category"), *texts,
        F.when(fine, F.struct("explicit_skills", "implicit_skills")).alias("skills"), F.when(fine, F.col("normalized_skills")).alias("normalized_skills"),
        F.lit(None).cast("struct<ats_score:double,semantic_score:double>").alias("scores"),
        F.struct(F.col("source").alias("file_path"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("processed_date"),
                 F.lit(None).cast("int").alias("processing_time_ms")).alias("metadata"), "_error")


def split_faults(structured: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(processed resumes, quarantine: resume_id, job_category, file_path, error), from one stored table."""
    kept = stored(structured, "structured")
    bad = kept.where(F.col("_error").isNotNull())
    return (kept.where(F.col("_error").isNull()).drop("_error"),
            bad.select("resume_id", "job_category", F.col("metadata.file_path").alias("file_path"), F.col("_error").alias("error")))


def resume_features(structured: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(vectors, vocabulary): ``structured`` with ``feature_idx`` and a binary ``features`` vector, and (skill, idx)."""
    if structured.isEmpty():
        raise ValueError("no resumes to build features from")
    vocab = FE.vocabulary(structured)
    return FE.skill_vectors(structured, vocab), vocab


@dataclass
class ClusterReport:
    assignments: DataFrame   # resume_id, job_category, cluster
    sizes: DataFrame         # cluster, size
    categories: DataFrame    # cluster, job_category, count
    profiles: DataFrame      # cluster, rank, skill, weight
    summary: DataFrame       # sample_count, requested_cluster_count, actual_cluster_count, silhouette_score


def cluster_resumes(structured: DataFrame, k: int = 10, top_n: int = 10, seed: int = 42, n_init: int = 10,
                    max_iter: int = 300) -> ClusterReport:
    """Cluster structured resumes by their skills."""
    if "_error" in structured.columns:
        structured = structured.where(F.col("_error").isNull())
    vectors, vocab = resume_features(structured)
    vectors = vectors.select("resume_id", "job_category", "normalized_skills", "features", "feature_idx")  # a stored table
    model = K.fit_kmeans(vectors, "features", k, n_init, seed, max_iter, index_col="feature_idx", size=vocab.count())
    given = stored(model.transform(vectors), "resume-clusters")
    sizes = K.cluster_sizes(given)
    score = K.silhouette(given, "resume_id", "features", "cluster")
    summary = given.agg(F.count("*").alias("sample_count")).crossJoin(score).select(  # one row each
        "sample_count", F.lit(k).cast("long").alias("requested_cluster_count"),
        F.col("n_clusters").alias("actual_cluster_count"), F.col("silhouette").alias("silhouette_score"))
    return ClusterReport(given.select("resume_id", "job_category", "cluster"), sizes,
                         K.cluster_categories(given, category_col="job_category"),
                         K.cluster_profiles(given, "normalized_skills", "cluster", top_n), summary)


def write_cluster_report(report: ClusterReport, path: str) -> None:
    """K4: one JSON folder for each part of the report."""
    for name in ("assignments", "sizes", "categories", "profiles", "summary"):
        sinks.write_report(getattr(report, name), f"{path.rstrip('/')}/{name}")
