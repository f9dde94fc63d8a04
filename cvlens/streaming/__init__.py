"""Incremental ingest of resume files with Structured Streaming.

The reference has no streaming operators. New files dropped into
``root/<CATEGORY>/<id>.txt`` go through the same steps as the batch path (decode,
clean, sections, explicit and implicit skills), a micro-batch at a time, so
no state is kept; the sink is a parquet table with a folder a batch, which a
repeated batch replaces (exactly-once, survives restarts).
Normalisation and mining need the whole collection and run as batch jobs
over that table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cvlens.functions.text import decode_text
from cvlens.operators.resumes import extract_skills
from cvlens.sources.aliases import alias_frame

_BINARY = "path string, modificationTime timestamp, length long, content binary"
_PATH = r"([^/]+)/([^/]+)\.[^./]+$"


def read_resume_stream(spark: SparkSession, root: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """Streaming (resume_id, category, resume_str) from category folders of .txt files."""
    raw = (spark.readStream.format("binaryFile").schema(_BINARY)
           .option("pathGlobFilter", "*.txt").option("maxFilesPerTrigger", max_files_per_trigger)
           .load(f"{root.rstrip('/')}/*/"))
    return raw.select(F.regexp_extract("path", _PATH, 2).alias("resume_id"),
                      F.regexp_extract("path", _PATH, 1).alias("category"),
                      decode_text("content").alias("resume_str"))


def structure(df: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """The batch path's steps on the rows of one micro-batch."""
    aliases = alias_frame(df.sparkSession) if terms is None else terms
    return extract_skills(df, aliases).select(
        "resume_id", "category", *[F.col(f"sec_{n}").alias(n) for n in ("skills", "experience", "education", "projects")],
        "explicit_skills", "implicit_skills")


def start_ingest(spark: SparkSession, root: str, out_path: str, checkpoint: str, terms: DataFrame | None = None):
    """Start the append-only ingest; returns the StreamingQuery. ``terms``: (alias, canonical), default the shipped ones.

    A batch is written below ``out_path/batch=<number>`` and replaced as a whole if it is run again.
    """
    def write(batch: DataFrame, number: int) -> None:
        structure(batch, terms).write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch={number}")

    return (read_resume_stream(spark, root).writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint).start())
