"""Batches of typed rows: gzip NDJSON with a _type field, or one Parquet table per track."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def write_batch(tracks: dict[str, DataFrame], path: str) -> bool:
    """All tracks as one gzip NDJSON output, _type first and nulls left out; nothing if all are empty."""
    lines = None
    for name, df in tracks.items():
        row = df.select(F.to_json(F.struct(F.lit(name).alias("_type"), *df.columns), {"ignoreNullFields": "true"}).alias("value"))
        lines = row if lines is None else lines.unionAll(row)
    if lines is None or lines.isEmpty():
        return False
    lines.write.option("compression", "gzip").text(path)
    return True


def read_track(spark: SparkSession, path: str, track: str, schema: T.StructType) -> DataFrame:
    """The rows of one track; absent fields take 0, '' or false."""
    typed = T.StructType([T.StructField("_type", T.StringType()), *schema.fields])
    rows = spark.read.schema(typed).json(path).where(F.col("_type") == track).drop("_type")
    zero = {T.StringType: "", T.BooleanType: False}
    fill = {f.name: F.coalesce(f.name, F.lit(zero.get(type(f.dataType), 0)).cast(f.dataType)) for f in schema.fields if not isinstance(f.dataType, (T.ArrayType, T.TimestampType, T.TimestampNTZType))}
    return rows.withColumns(fill)


def write_tables(tracks: dict[str, DataFrame], path: str, day_of: str = "minute") -> None:
    """One Parquet table per track, partitioned by day where the track has a time."""
    for name, df in tracks.items():
        if day_of in df.columns:
            df.withColumn("day", F.to_date(day_of)).write.partitionBy("day").parquet(f"{path}/{name}")
        else:
            df.write.parquet(f"{path}/{name}")
