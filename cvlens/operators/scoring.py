"""Resume-to-job scores.

Every resume is scored against the jobs of its own category that ask for a
skill it has, found by an equi-join on the skill: no resume x job product.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cvlens.session import stored

JOB_SCHEMA = ("job_title string, job_category string, required_skills array<string>, "
              "preferred_skills array<string>, experience_years int, education string, "
              "certifications array<string>")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ats_score(resume_skills, job_skills) -> Column:
    """Percent of distinct lower-cased requirements present in the resume; 0 if either is empty."""
    r = F.coalesce(_c(resume_skills), F.array().cast("array<string>"))
    j = F.coalesce(_c(job_skills), F.array().cast("array<string>"))
    rs = F.array_distinct(F.transform(r, F.lower))
    js = F.array_distinct(F.transform(j, F.lower))
    return (F.when((F.size(r) == 0) | (F.size(j) == 0), F.lit(0.0))
            .otherwise(F.size(F.array_intersect(rs, js)) / F.size(js) * 100.0))


def cosine(a, b) -> Column:
    """Cosine of two float arrays (elements widened to double first); 0 if either is empty."""
    x = F.transform(_c(a), lambda v: v.cast("double"))
    y = F.transform(_c(b), lambda v: v.cast("double"))
    dot = F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    nx = F.sqrt(F.aggregate(x, F.lit(0.0), lambda s, v: s + v * v))
    ny = F.sqrt(F.aggregate(y, F.lit(0.0), lambda s, v: s + v * v))
    return (F.when((F.size(x) == 0) | (F.size(y) == 0), F.lit(0.0))
            .otherwise(dot / (nx * ny)))


def match_jobs(resumes: DataFrame, jobs: DataFrame, skills_col: str = "normalized_skills",
               category_col: str = "category", zero_pairs: bool = False) -> DataFrame:
    """(resume_id, job_title, ats_score) for each resume and each job of its category that asks for one of its skills.

    An inverted index: the resumes' and the jobs' distinct lower-cased skills are
    rows, joined on (skill, category); the score is the share of a job's skills
    that were hit. Rows of equal ids or titles are scored apart. Pairs without
    a hit score 0 and are only made on demand (``zero_pairs``): their number is
    that of all pairs of a category.
    """
    low = lambda c: F.array_distinct(F.transform(F.filter(F.coalesce(_c(c), F.array().cast("array<string>")), lambda x: x.isNotNull()), F.lower))
    ours = stored(resumes.select(F.monotonically_increasing_id().alias("_r"), "resume_id", F.col(category_col).alias("_c"), low(skills_col).alias("_s")), "match-resumes")
    theirs = stored(jobs.select(F.monotonically_increasing_id().alias("_j"), "job_title", F.col("job_category").alias("_c"), low("required_skills").alias("_s")), "match-jobs")
    hits = (ours.select("_r", "resume_id", "_c", F.explode("_s").alias("_skill"))
            .join(theirs.select("_j", "job_title", "_c", F.size("_s").alias("_n"), F.explode("_s").alias("_skill")), ["_skill", "_c"])
            .groupBy("_r", "_j").agg(F.first("resume_id").alias("resume_id"), F.first("job_title").alias("job_title"),
                                     (F.count("*") / F.first("_n") * 100.0).alias("ats_score")))
    if not zero_pairs:
        return hits.select("resume_id", "job_title", "ats_score")
    pairs = ours.select("_r", "resume_id", "_c").join(theirs.select("_j", "job_title", "_c"), "_c").select("_r", "_j", "resume_id", "job_title")
    return (pairs.join(hits.select("_r", "_j", "ats_score"), ["_r", "_j"], "left")
            .select("resume_id", "job_title", F.coalesce("ats_score", F.lit(0.0)).alias("ats_score")))


def both_scores(pairs: DataFrame, embeddings: DataFrame, id_col: str = "resume_id") -> DataFrame:
    """ATS plus semantic score; a resume without stored vectors gets semantic 0.0.

    ``embeddings`` holds (id, resume_vec, job_vec); ``pairs`` already carries
    ``ats_score``.
    """
    sem = embeddings.select(id_col, cosine("resume_vec", "job_vec").alias("semantic_score"))
    return (pairs.join(sem, id_col, "left")
            .withColumn("semantic_score", F.coalesce("semantic_score", F.lit(0.0)))
            .withColumn("scores", F.struct("ats_score", "semantic_score")))
