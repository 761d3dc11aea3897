"""The collection as a structured stream: watermarked first-wins keys, appended to a table that is filtered when it is read.

A watermark bounds the state; it trails the latest event time and is not the
look-back window.  Rows leave the window as time passes, with or without new
data, so the window is applied when the table is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.times import in_window


def deduplicated(stream: DataFrame, key: str, ts: str, minutes: int = 60) -> DataFrame:
    typed = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return typed.withWatermark(ts, f"{minutes} minutes").dropDuplicatesWithinWatermark([key])


def append_to(stream: DataFrame, path: str, checkpoint: str, *, refresh_seconds: int | None = 30) -> StreamingQuery:
    """Appends to Parquet every ``refresh_seconds``; with None what is there is processed once."""
    w = stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=f"{refresh_seconds} seconds") if refresh_seconds else w.trigger(availableNow=True)).start()


def recent(spark: SparkSession, path: str, ts: str, now: Column, minutes: float = 60.0) -> DataFrame:
    return spark.read.parquet(path).where(in_window(F.col(ts), now, minutes))
