"""Incremental ingestion: files as a stream, parsed or counted, once or continuously."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def daily_counts(events: DataFrame, late: str = "30 days") -> DataFrame:
    """Counts a day of a stream with the column ts; later rows than the watermark are dropped."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return timed.groupBy(F.window("ts", "1 day").alias("w")).agg(F.count(F.lit(1)).alias("count")).select(F.col("w.start").alias("day"), "count")


def daily_counts_once(spark: SparkSession, path: str) -> DataFrame:
    """Run the stream over what is there now and return the result."""
    from uuid import uuid4

    schema = spark.read.parquet(path).schema
    # a single file has to be named by its folder and a filter
    folder, _, name = path.rpartition("/")
    source = spark.readStream.schema(schema).option("pathGlobFilter", name if not _is_folder(spark, path) else "*.parquet").parquet(path if _is_folder(spark, path) else folder)
    view = "counts_" + uuid4().hex
    query = daily_counts(source).writeStream.outputMode("complete").format("memory").queryName(view).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.table(view)


def _is_folder(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(where).isDirectory()


def ingest(raw: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, continuous: str | None = None) -> StreamingQuery:
    """Hand each batch of a raw-archive stream to `handle` (rows, batch id). `continuous`: an interval such as "1 hour"; else what is there now."""
    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return raw.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(**trigger).start()
