"""Helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from edgelens.runtime import importable

#: Rows of one key that a task takes in a join, while the table has fewer than HOT_KEYS times as many.
HOT_ROWS, HOT_KEYS = 256, 1024


#: Rows whose results a task holds at a time.
SLICE_ROWS = 1024


def row_key(id_col: str, text_col: str) -> Column:
    """128 bits that name a document: rows with equal id and text are one. Nulls differ from empty values."""
    own, text = F.col(id_col).cast("string"), F.col(text_col)
    name = F.coalesce(F.concat(F.length(own).cast("string"), F.lit(":"), own), F.lit("-"))
    return F.unhex(F.md5(F.concat(name, F.coalesce(F.concat(F.lit("+"), text), F.lit("-")))))


def hot_limit(rows: int) -> int:
    """Keys with more rows than this are hot; there are fewer than HOT_KEYS of them, so they may be broadcast."""
    return max(HOT_ROWS, rows // HOT_KEYS)


def append_columns(
    df: DataFrame, inputs: list[str], schema: list[tuple[str, str]], maker: Callable[[], Callable]
) -> DataFrame:
    """df with the columns of schema ((name, Spark type)) computed in Arrow batches from inputs.

    maker() runs once per task and returns f(*pyarrow arrays) -> list of pyarrow arrays. A column of
    df that has a new column's name (in any case) is replaced by it.
    """
    importable(df.sparkSession)
    new = {n.lower() for n, _ in schema}
    kept = [c for c in df.columns if c.lower() not in new]
    src = df.select(*[F.col(f"`{c}`") for c in kept], *[F.col(f"`{c}`").alias(f"__in{i}") for i, c in enumerate(inputs)])
    n_in = len(inputs)
    out_schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[: len(kept)]]
        + [f"`{n}` {t}" for n, t in schema]
    )
    names = kept + [n for n, _ in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = None
        for whole in batches:
            for start in range(0, max(1, whole.num_rows), SLICE_ROWS):
                b = whole.slice(start, SLICE_ROWS)
                make = make or maker()
                cols = b.columns
                yield pa.RecordBatch.from_arrays(cols[: len(cols) - n_in] + list(make(*cols[len(cols) - n_in :])), names)

    return src.mapInArrow(run, out_schema)


def integer_vectors(df: DataFrame, vec_col: str, scale: int, largest: float) -> DataFrame:
    """The rows of df whose vector holds only finite components and is neither null nor empty, with __v array<long>: each
    component times scale, rounded down. Rows whose squared length could reach largest are left out."""
    x = F.transform(F.col(f"`{vec_col}`"), lambda c: c.cast("double") * float(scale))
    kept = [c for c in df.columns if c.lower() not in ("__v", "__x")]
    rows = df.select(*[F.col(f"`{c}`") for c in kept], x.alias("__x")).where(F.col("__x").isNotNull() & (F.size("__x") > 0))
    rows = rows.where(F.forall("__x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    longest = F.aggregate("__x", F.lit(0.0), lambda a, c: a + (F.abs(c) + 1) * (F.abs(c) + 1))  # rounding down adds less than 1
    rows = rows.where(longest < largest)
    return rows.select(*[F.col(f"`{c}`") for c in kept], F.transform("__x", lambda c: F.floor(c)).alias("__v"))


def join_hot(rows: DataFrame, groups: DataFrame, keys: list[str], n_col: str, limit: int) -> DataFrame:
    """rows joined with groups, which have a row for each key and in n_col its number of rows, or more. The few keys
    with more than limit (see hot_limit) are joined by broadcast, so that none of them is one task's."""
    hot = F.broadcast(groups.where(F.col(n_col) > limit))
    cold = rows.join(hot.select(*keys), keys, "left_anti").join(groups.where(F.col(n_col) <= limit), keys)
    return rows.join(hot, keys).unionByName(cold)
