"""Streaming twins: a micro-batch is a flush window.

Caps, ranks and as-of joins need row numbers, which streams refuse, so each micro-batch is drained by
foreachBatch, where one batch is one window. Tracks whose time is that of their delivery are stamped with the
batch's flush minute, and each delivery is written under its batch id, so a repeated batch replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable, Collection
from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery


def run_stream(
    rows: DataFrame, tracks: Callable[[DataFrame], dict[str, DataFrame]], path: str, checkpoint: str, trigger: str | None = "30 seconds",
    stamped: Collection[str] = (), clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
) -> StreamingQuery:
    """Drain rows every trigger (None: all there is, then stop) through tracks(batch) into path/<track>. Tracks named
    in stamped get the UTC minute of the batch's delivery as their column minute; the others keep their own."""

    def deliver(batch: DataFrame, batch_id: int) -> None:
        flush = F.lit(clock().replace(second=0, microsecond=0, tzinfo=None)).cast("timestamp_ntz")
        held = batch.withColumn("w", F.lit(batch_id).cast("long")).persist()
        try:
            for name, df in tracks(held).items():
                df = df.withColumn("minute", flush) if name in stamped else df
                df.write.mode("overwrite").parquet(f"{path}/{name}/batch={batch_id}")
        finally:
            held.unpersist()

    writer = rows.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)).start()


def windowed_counts(rows: DataFrame, keys: list[str], ts: str = "ts", window: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """Counts per tumbling window and key that runs on streams, with a watermark behind which Spark drops rows; windows.run_windows
    keeps them. ts may be without zone."""
    timed = rows.withColumn("__ts", F.col(ts).cast("timestamp")).withWatermark("__ts", late)
    return timed.groupBy(F.window("__ts", window), *keys).agg(F.count("*").alias("cnt")).select(F.col("window.start").alias("minute"), *keys, "cnt")
