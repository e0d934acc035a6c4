"""Incremental processing with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexflume.operators.ingest import merge_incremental
from lexflume.sources.files import shared_path


def stream_distinct(spark: SparkSession, path: str, keys: list[str], *, watermark: tuple[str, str] | None = None) -> DataFrame:
    """The distinct keys of a folder or file of Parquet, read as a stream until all there is has been processed.

    With a watermark (column, delay) the state of old keys is dropped; without one
    every key is kept, as for a bounded source. Result and checkpoint are tables in
    the shared folder.
    """
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rpartition("/")
    reader = spark.readStream.schema(schema)
    source = (reader.option("pathGlobFilter", name).parquet(folder) if name.endswith(".parquet") and _is_file(spark, path) else reader.parquet(path))
    if watermark:
        source = source.withWatermark(*watermark)
        kept = source.dropDuplicatesWithinWatermark(keys).select(keys)
    else:
        kept = source.select(keys).dropDuplicates(keys)
    out = shared_path(spark, "stream")
    query = kept.writeStream.format("parquet").option("path", out).option("checkpointLocation", shared_path(spark, "offsets")).trigger(availableNow=True).outputMode("append").start()
    query.awaitTermination()
    return spark.read.parquet(out)


def _is_file(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isFile()


def merge_batches(new: DataFrame, target: str):
    """A foreachBatch sink that merges each micro-batch into the Parquet table target, through a new version of it.

    A version counts once its write has committed. A batch that runs again starts from
    the version before its own, so it gives the same table; errors rise.
    """

    def sink(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        before = [v for v in versions(spark, target) if v < epoch]
        old = spark.read.parquet(f"{target}/v{max(before)}") if before else batch.limit(0)
        merge_incremental(old, batch).write.mode("overwrite").parquet(f"{target}/v{epoch}")

    return new.writeStream.foreachBatch(sink)


def versions(spark: SparkSession, target: str) -> list[int]:
    """The versions of a merged table whose write has committed."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/v*/_SUCCESS")
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return sorted(int(x.getPath().getParent().getName()[1:]) for x in found or [])


def merged_table(spark: SparkSession, target: str) -> DataFrame:
    """What merge_batches has made so far."""
    return spark.read.parquet(f"{target}/v{versions(spark, target)[-1]}")


def windowed_counts(stream: DataFrame, at: str, key: str, *, size: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    return stream.withWatermark(at, delay).groupBy(F.window(at, size), key).agg(F.count(F.lit(1)).alias("n"))
