"""Resume files: CSV export (S1, S2), category folders (S3-S6), bounded samples.

All readers return (resume_id, category, resume_str, source) frames. Nothing
is read on the driver. Folders of many small files on a mounted file system are
listed and read by tasks through the operating system, as Spark's reader spends
a millisecond and more on each file; other stores are left to that reader.
"""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cvlens.functions.text import decode_text
from cvlens.session import checkpoint_dir, ship_package, stored

# The CSV export's columns and the accepted file extensions.
REQUIRED_COLUMNS = ["ID", "Resume_str", "Resume_html", "Category"]
RESUME_EXTENSIONS = [".pdf", ".txt"]
CSV_SCHEMA = "ID string, Resume_str string, Resume_html string, Category string"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (survives executor loss)."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/cvlens-io/{name}-{uuid.uuid4().hex}"


def check_csv_columns(spark: SparkSession, path: str) -> list[str]:
    """Header columns; raises ValueError when a required one is missing."""
    cols = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).columns
    missing = [c for c in REQUIRED_COLUMNS if c not in cols]
    if missing:
        raise ValueError(f"the export at {path} lacks the columns {missing}")
    return cols


def read_resume_csv(spark: SparkSession, path: str, with_row_index: bool = False) -> DataFrame:
    """RFC-4180 CSV (quoted fields with line breaks), a file or a folder of them; every column a string, null -> ''.

    ``with_row_index`` adds row_idx, the row's number in the whole export, and names it in the source.
    """
    cols = check_csv_columns(spark, path)
    schema = ", ".join(f"`{c}` string" for c in cols)
    raw = (spark.read.schema(schema).option("header", True).option("multiLine", True)
           .option("quote", '"').option("escape", '"').csv(path))
    df = raw.select(F.coalesce(F.col("ID"), F.lit("")).alias("resume_id"),
                    F.coalesce(F.nullif(F.col("Category"), F.lit("")), F.lit("UNKNOWN")).alias("category"),
                    F.coalesce(F.col("Resume_str"), F.lit("")).alias("resume_str"),
                    F.lit(path).alias("source"))
    if with_row_index:
        df = _numbered(df.withColumns({"_file": F.col("_metadata.file_path"), "_at": F.monotonically_increasing_id()}))
        df = df.withColumn("source", F.concat(F.lit("csv:"), F.col("source"), F.lit(":row_"), F.col("row_idx")))
    return df


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``row_idx``: from 0, in the order of the files' names and of the rows in each file.

    One scan stores the rows with their file and place. A file is read by one
    task from its start on, so its rows have successive places; its first place
    and the rows of the files before it (a row a file) give the index.
    """
    kept = stored(rows, "csv-rows")
    files = kept.groupBy("_file").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = files.select("_file", "_first", before.alias("_before"))
    return (kept.join(starts, "_file").withColumn("row_idx", F.col("_before") + F.col("_at") - F.col("_first"))
            .drop("_file", "_at", "_first", "_before"))


def write_resume_csv(df: DataFrame, path: str) -> None:
    """Write (resume_id, category, resume_str[, resume_html]) in the export's layout."""
    html = F.col("resume_html") if "resume_html" in df.columns else F.lit("")
    (df.select(F.col("resume_id").alias("ID"), F.col("resume_str").alias("Resume_str"), html.alias("Resume_html"),
               F.col("category").alias("Category"))
     .write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def _extension(path_col) -> F.Column:
    return F.lower(F.regexp_extract(path_col, r"(\.[^./]+)$", 1))


def valid_extension(path_col) -> F.Column:
    """Case-insensitive .pdf / .txt."""
    return _extension(path_col).isin(RESUME_EXTENSIONS)


def _qualified(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path)


def _depth_of(spark: SparkSession, root: str) -> int:
    """Path parts of ``root`` as the scan spells it."""
    return len(_qualified(spark, root).toString().rstrip("/").split("/"))


def _mounted(spark: SparkSession, root: str) -> str | None:
    """``root`` as Spark spells it (``file:/...``), if it is a folder of a mounted file system; else None."""
    if re.search(r"[*?\[\]{}\\]", root):
        return None
    path = _qualified(spark, root)
    uri = path.toUri()
    return path.toString().rstrip("/") if uri.getScheme() == "file" and os.path.isdir(uri.getPath()) else None


# Names that Spark's scans pass over.
_HIDDEN = re.compile(r"\.|_(?!metadata|common_metadata)(?!.*=)|.*\._COPYING_$", re.DOTALL)
# Files of a listed batch, and bytes of read contents handed over at once.
_NAMES, _CONTENTS = 4096, 4 << 20


def _list_folders(batches):
    """Folders -> (path, modified, length) of the files right in them, as they come."""
    import pyarrow as pa

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                                           pa.array([r[2] for r in rows], pa.int64())], ["path", "modified", "length"])
    for b in batches:
        for folder in b.column(0).to_pylist():
            rows = []
            with os.scandir(folder.removeprefix("file:")) as entries:
                for e in entries:
                    if e.is_file() and not _HIDDEN.match(e.name):
                        about = e.stat()
                        rows.append((f"{folder}/{e.name}", about.st_mtime_ns // 1_000_000, about.st_size))
                    if len(rows) == _NAMES:
                        yield batch(rows)
                        rows = []
            yield batch(rows)


def _read_contents(batches):
    """The listed files with their bytes."""
    import pyarrow as pa
    for b in batches:
        own, size, first = [], 0, 0
        for i, path in enumerate(b.column(0).to_pylist()):
            with open(path.removeprefix("file:"), "rb", buffering=0) as f:
                own.append(f.readall())
            size += len(own[-1])
            if size >= _CONTENTS or i == b.num_rows - 1:
                part = b.slice(first, len(own))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(own, pa.binary())], ["path", "modified", "length", "content"])
                own, size, first = [], 0, i + 1


def _names(spark: SparkSession, folders: list[str], pattern: str) -> DataFrame:
    """(path, modified, length) of the files of ``pattern`` right in mounted ``folders``; none without bytes."""
    ship_package(spark)
    listed = (spark.createDataFrame([(f,) for f in folders], "folder string")
              .mapInArrow(_list_folders, "path string, modified long, length long"))
    # Hadoop's own spelling of the glob as a regular expression
    glob = spark._jvm.org.apache.hadoop.fs.GlobPattern.compile(pattern).pattern()
    name = F.element_at(F.split("path", "/"), -1)
    return listed.where((F.col("length") > 0) & F.rlike(name, F.lit(rf"(?s)\A(?:{glob})\z")))


def _contents(names: DataFrame) -> DataFrame:
    """Listed files as binaryFile columns; a task reads many."""
    dealt = names.repartition(4 * names.sparkSession.sparkContext.defaultParallelism, "path")
    read = dealt.mapInArrow(_read_contents, "path string, modified long, length long, content binary")
    return read.select("path", F.timestamp_millis("modified").alias("modificationTime"), "length", "content")


def _categories(spark: SparkSession, root: str) -> list[str] | None:
    """The folders right below a mounted ``root``; None if there are none or ``root`` is no such folder."""
    top = _mounted(spark, root)
    if top is None:
        return None
    with os.scandir(top.removeprefix("file:")) as entries:
        return [f"{top}/{e.name}" for e in entries if e.is_dir()] or None


def list_archive(spark: SparkSession, root: str, pattern: str = "*.txt") -> DataFrame:
    """The archive's files (binaryFile columns): those exactly one folder below ``root``."""
    folders = _categories(spark, root)
    if folders:
        return _contents(_names(spark, folders, pattern))
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
             .load(f"{root.rstrip('/')}/*/"))
    return files.where(F.size(F.split("path", "/")) == _depth_of(spark, root) + 2)


def read_archive(spark: SparkSession, root: str, pattern: str = "*.txt", faults: bool = False) -> DataFrame:
    """One resume per file under ``root/<CATEGORY>/``; category = folder, id = file stem.

    Only one folder level is read; plain files in the root are skipped. PDF
    bytes are not decoded (text files only). Spark's scans leave out files of
    no bytes, so those are no rows. With ``faults`` every file of the pattern is
    a row, and those that can't be processed say why in ``_error``.
    """
    if faults:
        return quarantine(list_archive(spark, root, pattern))
    return _files_to_resumes(list_archive(spark, root, pattern), category_from_path=True)


def read_flat(spark: SparkSession, directory: str, pattern: str = "*.txt") -> DataFrame:
    """Files directly in ``directory`` (not recursive); category UNKNOWN."""
    folder = _mounted(spark, directory)
    if folder:
        files = _contents(_names(spark, [folder], pattern))
    else:
        files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(directory)
    return _files_to_resumes(files, category_from_path=False)


_STEM = r"([^/]+)/([^/]+)\.[^./]+$"


def _files_to_resumes(files: DataFrame, category_from_path: bool) -> DataFrame:
    files = files.where(valid_extension(F.col("path")))
    name = F.regexp_extract("path", _STEM, 2)
    cat = F.regexp_extract("path", _STEM, 1) if category_from_path else F.lit("UNKNOWN")
    return files.select(name.alias("resume_id"),
                        F.coalesce(F.nullif(cat, F.lit("")), F.lit("UNKNOWN")).alias("category"),
                        decode_text("content").alias("resume_str"), F.col("path").alias("source"))


def bounded_sample(df: DataFrame, max_samples: int | None, order_col: str = "resume_id") -> DataFrame:
    """The first ``max_samples`` rows by id (None or 0 -> all rows)."""
    if not max_samples:
        return df
    return df.orderBy(order_col).limit(max_samples)


def sample_archive(spark: SparkSession, root: str, max_samples: int | None, pattern: str = "*.txt") -> DataFrame:
    """``read_archive`` of the first ``max_samples`` files by id: names are chosen first, only those files are read."""
    if not max_samples:
        return read_archive(spark, root, pattern)
    folders = _categories(spark, root)
    listed = _names(spark, folders, pattern) if folders else list_archive(spark, root, pattern)
    names = listed.select("path").where(valid_extension(F.col("path")))
    first = bounded_sample(names.select("path", F.regexp_extract("path", _STEM, 2).alias("resume_id")), max_samples)
    paths = [r["path"] for r in first.select("path").collect()]  # at most max_samples
    if not paths:
        return read_archive(spark, root, pattern).limit(0)
    return _files_to_resumes(spark.read.format("binaryFile").load(paths), category_from_path=True)


def quarantine(files: DataFrame) -> DataFrame:
    """Every file as a row with ``_error``: null for one that can be processed, else why it is set aside.

    ``files`` has path and content. Errors are rows, so one bad file stops no
    other: no decoder for the extension, no content, binary content.
    """
    ext = _extension(F.col("path"))
    error = (F.when(~valid_extension(F.col("path")), F.lit("extension not accepted"))
             .when(ext == ".pdf", F.lit("no decoder for .pdf"))
             .when(F.col("content").isNull() | (F.octet_length("content") == 0), F.lit("no content"))
             .when(F.locate("\x00", F.decode(F.col("content"), "ISO-8859-1")) > 0, F.lit("binary content")))
    return files.select(F.regexp_extract("path", _STEM, 2).alias("resume_id"), F.regexp_extract("path", _STEM, 1).alias("category"),
                        F.when(error.isNull(), decode_text("content")).alias("resume_str"), F.col("path").alias("source"),
                        error.alias("_error"))


def quarantine_counts(rows: DataFrame) -> DataFrame:
    """One row: processed, failed, total."""
    return rows.agg(F.count_if(F.col("_error").isNull()).alias("processed"),
                    F.count_if(F.col("_error").isNotNull()).alias("failed"), F.count("*").alias("total"))


def write_archive(df: DataFrame, root: str, ext: str = ".txt") -> None:
    """Write each (resume_id, category, resume_str) row as root/<category>/<id><ext>.

    Runs on the executors against the shared folder, through the file system
    that the folder's URI names (file, HDFS, S3, ...).
    """
    name = F.concat(F.col("category"), F.lit("/"), F.col("resume_id"), F.lit(ext))
    write_files(df.select(name.alias("name"), F.encode(F.coalesce("resume_str", F.lit("")), "UTF-8").alias("content")), root)


def write_files(df: DataFrame, root: str) -> None:
    """Write each (name, content) row as the file ``root/<name>``."""
    base = re.sub(r"^file:/+", "file:///", root)

    def write_part(batches):
        import pyarrow as pa
        from pyarrow import fs
        store, folder = fs.FileSystem.from_uri(base)
        made = set()
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                parent = name.rpartition("/")[0]
                if parent not in made:
                    store.create_dir(f"{folder}/{parent}", recursive=True)
                    made.add(parent)
                with store.open_output_stream(f"{folder}/{name}") as out:
                    out.write(content or b"")
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])

    df.select("name", "content").mapInArrow(write_part, "n long").write.format("noop").mode("overwrite").save()
