"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every cvlens job relies on. AQE re-plans joins from runtime sizes,
# splits skewed shuffle partitions (a frequent skill or one huge category) and
# coalesces the many small partitions a local test produces.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "cvlens", extra: dict | None = None) -> SparkSession:
    """Return the active session or build one with cvlens' defaults.

    On a cluster the launcher supplies master, memory and
    ``spark.checkpoint.dir``; locally (tests, bench) we fill in what is unset.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage (``DataFrame.checkpoint``).

    Read from ``spark.checkpoint.dir``. Only a local-mode session without the
    setting (tests, the bench) gets a fresh private folder; on a cluster an
    unset value is an error, because a machine-local folder would not survive
    the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="cvlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package, once a session.

    Functions of the package are pickled by name, so workers must be able to
    import it wherever they run. An installed or already zipped package (a
    wheel on the cluster, ``--py-files``) is left as it is.
    """
    sc = spark.sparkContext
    root = os.path.dirname(os.path.abspath(__file__))
    if getattr(sc, "_cvlens_shipped", False) or not os.path.isdir(root):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="cvlens-ship-"), "cvlens.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if not name.endswith((".pyc", ".pyo")):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("cvlens", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._cvlens_shipped = True


def scratch_table(spark: SparkSession, name: str) -> str:
    """A new folder for a table below the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/cvlens-tables/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, lineage cut."""
    path = scratch_table(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs that are done.

    They go when the driver's garbage collector finds their plans unused, which
    else may be long after a table was stored.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
