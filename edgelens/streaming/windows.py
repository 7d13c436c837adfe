"""Counts per tumbling window of a stream in which no row is lost, whatever its age.

The watermark is the newest event time of all earlier micro-batches less `late`. Rows of windows that it has not passed are
counted as partial rows of open windows; windows that it passes become final rows once; rows that come for a window already
passed become partial rows of a table of their own. Merged on their natural key (rollups.merge_rollups), final and late rows
are what one batch over all rows counts.

A micro-batch writes under its number and reads what those before it wrote, so a repeated micro-batch replaces itself and a
restarted query goes on. Open rows are laid out by hour, and a delivery reads the hours that the watermark passes only.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from edgelens.operators.rollups import merge_rollups


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table that may not be there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def schema_of(rows: DataFrame, keys: list[str]) -> str:
    return ", ".join(["minute timestamp", *[f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys], "cnt long"])


def run_windows(
    rows: DataFrame, keys: list[str], path: str, checkpoint: str, late_s: int = 600, window_s: int = 60, ts: str = "ts", trigger: str | None = "30 seconds"
) -> StreamingQuery:
    """Counts of a stream by window (minute, its start) and keys into path/final, path/late and path/open."""
    spark, schema = rows.sparkSession, schema_of(rows, keys)
    open_schema = f"{schema}, hour timestamp, batch long"

    def mark(batch_id: int) -> datetime | None:
        """The newest event time up to a micro-batch."""
        if batch_id < 0:
            return None
        row = _read(spark, f"{path}/marks/batch={batch_id}", "newest timestamp").first()
        return row and row.newest

    def deliver(batch: DataFrame, batch_id: int) -> None:
        before = mark(batch_id - 1)
        passed = lambda newest: F.unix_micros("minute") + window_s * 1_000_000 <= F.unix_micros(F.lit(newest).cast("timestamp")) - late_s * 1_000_000
        start = F.timestamp_seconds(F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / window_s) * window_s)
        counted = batch.withColumn("minute", start).groupBy("minute", *keys).agg(F.count("*").alias("cnt")).persist()
        try:
            is_late = F.coalesce(passed(before), F.lit(False)) if before else F.lit(False)
            counted.where(is_late | F.col("minute").isNull()).write.mode("overwrite").parquet(f"{path}/late/batch={batch_id}")
            own = counted.where(~is_late & F.col("minute").isNotNull()).withColumns({"hour": F.date_trunc("hour", "minute"), "batch": F.lit(batch_id).cast("long")})
            own.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("hour", "batch").parquet(f"{path}/open")
        finally:
            counted.unpersist()
        newest = batch.agg(F.max(F.col(ts).cast("timestamp")).alias("newest"))
        newest = newest.select(F.greatest("newest", F.lit(before).cast("timestamp")).alias("newest"))
        newest.coalesce(1).write.mode("overwrite").parquet(f"{path}/marks/batch={batch_id}")
        now = mark(batch_id)
        if now is None:
            return
        ripe = _read(spark, f"{path}/open", open_schema).where(F.col("batch") <= batch_id).where(passed(now)).where(F.col("hour") <= F.lit(now).cast("timestamp"))
        if before:
            edge = F.timestamp_seconds(F.unix_seconds(F.lit(before).cast("timestamp")) - late_s - window_s)
            ripe = ripe.where(~passed(before)).where(F.col("hour") >= F.date_trunc("hour", edge))
        merge_rollups(["minute", *keys], ["cnt"], ripe.drop("hour", "batch")).write.mode("overwrite").parquet(f"{path}/final/batch={batch_id}")

    writer = rows.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)).start()


def counts(spark: SparkSession, path: str, keys: list[str], schema: str, still_open: bool = True, late_s: int = 600, window_s: int = 60) -> DataFrame:
    """What run_windows counted so far, final and late rows merged; with still_open, also of windows not passed yet.
    schema: schema_of() the stream."""
    parts = [_read(spark, f"{path}/final", schema), _read(spark, f"{path}/late", schema)]
    if still_open:
        newest = _read(spark, f"{path}/marks", "newest timestamp").agg(F.max("newest")).first()[0]
        rest = _read(spark, f"{path}/open", f"{schema}, hour timestamp, batch long").drop("hour", "batch")
        parts.append(rest.where(F.unix_micros("minute") + window_s * 1_000_000 > F.unix_micros(F.lit(newest).cast("timestamp")) - late_s * 1_000_000))
    return merge_rollups(["minute", *keys], ["cnt"], *parts)
