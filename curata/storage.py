"""Shared scratch storage: cut lineage with written tables that survive lost executors."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_swept: dict[str, float] = {}


def scratch_root(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; a temporary one only in local mode (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith(("local[", "local*")) and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="curata-")
    return _own[app]


def materialize(df: DataFrame, label: str = "step", **options: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again, so that nothing upstream is computed twice."""
    spark = df.sparkSession
    sweep(spark, every=10.0)
    path = f"{scratch_root(spark)}/curata-{label}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._curata_path = path  # type: ignore[attr-defined]
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)  # what reads it is a plan of this application
    return out


def sweep(spark: SparkSession, every: float = 0.0) -> None:
    """Let the driver collect its garbage: only then do executors delete the shuffle files of lineages that were cut.

    Not more often than ``every`` seconds.  What a job has just left is held by
    its last events at first, so the collector runs twice.
    """
    if time.monotonic() - _swept.get("at", -1e9) < every:
        return
    gc.collect()
    for _ in range(2):
        spark._jvm.System.gc()
        time.sleep(0.3)
    _swept["at"] = time.monotonic()


def discard(df: DataFrame) -> None:
    """Delete what ``materialize`` wrote, once nothing reads it any more."""
    path = getattr(df, "_curata_path", None)
    if path:
        spark = df.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
