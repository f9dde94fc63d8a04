"""Registered queries: text cleaning and sections."""

from __future__ import annotations

from pyspark.sql import functions as F

from cvlens.functions.sections import SECTION_NAMES, add_sections, section_sql
from cvlens.functions.text import clean_text, clean_text_sql
from cvlens.plans.registry import register
from cvlens.sources.tables import document_resumes, document_resumes_sql, documents

# Custom header patterns for the labelled resumes: the first pattern of
# "skills" never matches, so the second one must be used (P4); "summary" is
# not one of the four sections and only shortens its neighbours.
CUSTOM_PATTERNS = {
    "skills": [r"(?i)competencies:", r"(?i)skills:"],
    "experience": [r"(?i)experience:"],
    "education": [r"(?i)education:"],
    "summary": [r"(?i)projects:"],
}


@register("clean_text", f"""
SELECT doc_id, {clean_text_sql('text')} AS clean FROM documents""")
def q_clean_text(spark, sf):
    return documents(spark, sf).select("doc_id", clean_text("text").alias("clean"))


def _sections_sql(patterns=None):
    t = "clean"
    cols = ",\n  ".join(f"{section_sql(t, n, patterns)} AS {n}" for n in SECTION_NAMES)
    return f"""
SELECT resume_id, {cols}
FROM (SELECT resume_id, {clean_text_sql('resume_str')} AS clean FROM {document_resumes_sql()})"""


def _sections(spark, sf, patterns=None):
    df = document_resumes(spark, sf).select("resume_id", clean_text("resume_str").alias("clean"))
    return add_sections(df, "clean", patterns).drop("clean")


@register("sections_default", _sections_sql())
def q_sections_default(spark, sf):
    return _sections(spark, sf)


@register("sections_custom", _sections_sql(CUSTOM_PATTERNS))
def q_sections_custom(spark, sf):
    return _sections(spark, sf, CUSTOM_PATTERNS)


@register("sections_documents", f"""
SELECT doc_id, {section_sql('c', 'skills')} AS skills, {section_sql('c', 'experience')} AS experience,
  {section_sql('c', 'education')} AS education, {section_sql('c', 'projects')} AS projects
FROM (SELECT doc_id, {clean_text_sql('text')} AS c FROM documents)""")
def q_sections_documents(spark, sf):
    df = documents(spark, sf).select("doc_id", clean_text("text").alias("c"))
    return add_sections(df, "c").drop("c")
