"""Small helpers shared by the operators: tables, scratch tables, hashing."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cvlens.session import checkpoint_dir, ship_package

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, what: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back.

    A lost executor then costs a re-read and not a recomputation, and a frame
    that is used several times is computed once.
    """
    path = scratch(df.sparkSession, what)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs that are done.

    Files go when the driver's garbage collector finds their plans unused, which
    else may be long after a table was written and its lineage cut.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


_CACHES: dict[str, Callable[[], None]] = {}


def claim_cache(owner: str, free: Callable[[], None]) -> None:
    """One operator's cache at a time in a worker process: the others are freed.

    Workers serve one stage after another; what an earlier operator keeps for
    its next task would add to the memory of this one.
    """
    free_caches(owner)
    _CACHES[owner] = free


def free_caches(owner: str | None = None) -> None:
    """Free all caches but ``owner``'s in this worker process."""
    others = [_CACHES.pop(k) for k in list(_CACHES) if k != owner]
    for drop in others:
        drop()
    if others:
        gc.collect()


def has_file_rows(df: DataFrame) -> bool:
    """Whether rows come straight from Parquet files, so that they have a file and a number in it."""
    try:
        df.select("_metadata.file_path", "_metadata.row_index")
        return True
    except AnalysisException:
        return False


def scan_place(df: DataFrame) -> Column:
    """A number for each row of files, the same in every scan: a hash of its file and its number in the file."""
    return F.xxhash64("_metadata.file_path", "_metadata.row_index")


def numbered_scan(df: DataFrame, name: str) -> DataFrame | None:
    """``df`` with each row's place as column ``name``, if it is a plain scan of Parquet files; else None.

    The place is a hash of the row's file above the row's number in it. The hashes
    of all files are compared first (four seeds are tried), so no two rows share a
    place; every scan gives the same, however it is split, and nothing is stored.
    Any other plan (filters, joins, exploded lists) might repeat work or rows. The
    driver holds five numbers a file.
    """
    if not df._jdf.queryExecution().analyzed().children().isEmpty() or not has_file_rows(df):
        return None
    path, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    files = (df.select(path.alias("path"), row.alias("row")).groupBy("path").agg(F.max("row").alias("last"))
             .select("last", *(F.xxhash64("path", F.lit(seed)) for seed in range(4))).collect())
    bits = max((r[0] for r in files), default=0).bit_length()
    mask = (1 << (63 - bits)) - 1
    for seed in range(4):
        if len({r[1 + seed] & mask for r in files}) == len(files):
            place = F.shiftleft(F.xxhash64(path, F.lit(seed)).bitwiseAND(F.lit(mask).cast("long")), bits) + row
            # never null, so that no join filters it and all joins by place can use one exchange
            return df.select("*", F.coalesce(place, F.lit(-1)).cast("long").alias(name))
    return None


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser on unsigned 64-bit integers (wraps)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_column(arr) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets) of an Arrow string or binary array; null counts as empty."""
    import pyarrow as pa
    import pyarrow.compute as pc
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = pc.fill_null(arr, b"" if pa.types.is_binary(arr.type) or pa.types.is_large_binary(arr.type) else "")
    big = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    _, off, data = arr.buffers()
    if off is None or len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, np.int64 if big else np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]
