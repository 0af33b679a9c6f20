"""Incremental intake: new files as a stream, each record once, counts by window, and a state that survives restarts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def read_stream(spark: SparkSession, path: str, schema: str | T.StructType, files_a_batch: int = 1000) -> DataFrame:
    """Parquet files that appear in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(path)


def _timed(rows: DataFrame, time: str, late: str) -> DataFrame:
    return rows.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)


def first_seen(rows: DataFrame, time: str, keys: Sequence[str], late: str = "1 hour") -> DataFrame:
    """Each key once within the time that a copy may be late; state older than that is dropped."""
    return _timed(rows, time, late).dropDuplicatesWithinWatermark(list(keys))


def windowed_counts(rows: DataFrame, time: str, group: str, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Rows and sums by window and group, final once the watermark has passed a window's end."""
    per = _timed(rows, time, late).groupBy(F.window(time, width).alias("w"), group)
    return per.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), group, "n", "total")


def run_available(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what is there, append it as Parquet, and stop; the checkpoint remembers what was done."""
    query = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(path)
    query.awaitTermination()
    return query


def unchanged(before: DataFrame, after: DataFrame, key: str, digest: str) -> DataFrame:
    """``key, problem``: inputs that came, went or changed while a run read them; none if it can be trusted."""
    both = before.select(key, F.col(digest).alias("a")).join(after.select(key, F.col(digest).alias("b")), key, "full")
    return both.select(key, F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").when(F.col("a") != F.col("b"), "changed").alias("problem")).where("problem is not null")


def cached(spark: SparkSession, path: str, fingerprint: str, compute: Callable[[], DataFrame]) -> DataFrame:
    """A table that is computed again only if the fingerprint of its inputs is another one."""
    place = f"{path.rstrip('/')}/{fingerprint}"
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{place}/_SUCCESS")
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        compute().write.mode("overwrite").parquet(place)
    return spark.read.parquet(place)
