"""Writers for structured resumes, reports, rules, clusters and models (K1-K6),
and the structured-resume reader (S8) and job reader (S9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The structured resume document (nested; ``scores`` may be null).
STRUCTURED_RESUME = (
    "resume_id string, job_category string, "
    "sections struct<skills:string, experience:string, education:string, projects:string, raw_text:string>, "
    "skills struct<explicit_skills:array<string>, implicit_skills:array<string>>, "
    "normalized_skills array<string>, scores struct<ats_score:double, semantic_score:double>, "
    "metadata struct<file_path:string, processed_date:string, processing_time_ms:int>")

JOB_REQUIREMENT = ("job_title string, job_category string, required_skills array<string>, "
                   "preferred_skills array<string>, experience_years int, education string, "
                   "certifications array<string>")


def write_json(df: DataFrame, path: str) -> None:
    """NDJSON, nulls kept (``scores: null`` survives a round trip)."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_structured(df: DataFrame, path: str) -> None:
    """K1: one JSON document per resume; a repeated id keeps its last row (apply last_per_key first)."""
    write_json(df, path)


def read_structured(spark: SparkSession, path: str) -> DataFrame:
    """Structured resumes with the fixed nested schema."""
    return spark.read.schema(STRUCTURED_RESUME).json(path)


def read_jobs(spark: SparkSession, path: str) -> DataFrame:
    """Job requirement documents (one JSON object per file, possibly multi-line)."""
    return spark.read.schema(JOB_REQUIREMENT).option("multiLine", True).json(path)


def write_report(df: DataFrame, path: str) -> None:
    """K2-K5: reports, rules and cluster assignments as JSON."""
    write_json(df, path)


def write_vocabulary(vocab: DataFrame, path: str) -> None:
    """K6: the vocabulary as parquet."""
    vocab.write.mode("overwrite").parquet(path)


def save_classifier(model, path: str) -> None:
    """K6: a fitted forest as a Spark ML pipeline (text models save themselves as tables)."""
    from pyspark.ml import PipelineModel
    PipelineModel(list(model.stages) + [model.label_model]).write().overwrite().save(path)


def load_classifier(path: str):
    from pyspark.ml import PipelineModel
    from cvlens.operators.classify import SkillForest
    pm = PipelineModel.load(path)
    return SkillForest(pm.stages[:-1], pm.stages[-1])
