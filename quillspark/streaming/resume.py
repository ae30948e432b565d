"""Collection as a stream: each serial once, merged into a table batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def first_of_each(stream: DataFrame, key: str, time: str | None = None, delay: str = "1 day") -> DataFrame:
    """Rows of a stream with keys not seen before. With a time column, keys are forgotten `delay` after the watermark."""
    if time:
        return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])
    return stream.dropDuplicates([key])


def merge_into(stream: DataFrame, path: str, key: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Appends to a Parquet table the rows whose key it doesn't have; a batch that is run again appends nothing."""

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        fresh = batch.dropDuplicates([key])
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
            fresh = fresh.join(spark.read.parquet(path).select(key), key, "left_anti")
        fresh.write.mode("append").parquet(path)

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def counts_by_window(stream: DataFrame, time: str, key: str, width: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    return stream.withWatermark(time, delay).groupBy(F.window(time, width), key).agg(F.count(F.lit(1)).alias("n"))
