"""Mixing sources to target weights by Poisson replication (operator 9).

A source with n documents and weight w out of W of a target of T documents is to be repeated
w / W * T / n times on the mean. A document's count is the Poisson quantile, with that mean, of a uniform
number hashed from (seed, doc_id, source): the same on every run and for every partitioning. A mean above
MAX_RATE is split evenly into several draws of their own, which are added: a sum of Poisson counts is one. Documents
are exploded by their count and dealt anew by a hash of (seed, doc_id, copy), so neighbours are unrelated.

Defined results: null sources form one source of their own; a source without a weight takes
default_weight; weight 0 removes a source; repeated rows with one doc_id have the same count each; an
empty table gives an empty table; other columns pass unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from edgelens.llm.common import row_key
from edgelens.runtime import stage

BROADCAST_SOURCES = 10_000
BROADCAST_TWINS = 1 << 20  # keys of 16 bytes
MAX_RATE = 500.0  # mean of one draw
EXPLODED = 1024  # copies made at a time


def uniform(*parts: Column) -> Column:
    """In [0, 1), from 52 bits of MD5, which other engines can repeat."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_key(source_col: str) -> Column:
    return F.coalesce(F.concat(F.lit("+"), F.col(f"`{source_col}`").cast("string")), F.lit("-"))


def with_twins(docs: DataFrame, id_col: str, source_col: str) -> DataFrame:
    """docs with __twin: null where a row's id and source are its own, else a hash of the row and the number that it has among its repeats."""
    key = row_key(id_col, source_col)
    often = stage(docs.groupBy(key.alias("__key")).agg(F.count("*").alias("n")).where("n > 1").select("__key"), "mix-twins")
    n = often.count()
    if not n:
        return docs.withColumn("__twin", F.lit(None).cast("string"))
    often = F.broadcast(often) if n <= BROADCAST_TWINS else often
    keyed = docs.withColumn("__key", key)
    alone = keyed.join(often, "__key", "left_anti").drop("__key").withColumn("__twin", F.lit(None).cast("string"))
    twins = keyed.join(often, "__key", "left_semi").drop("__key")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    # equal rows are interchangeable: one of them stands for all, and is told apart by numbers again
    one = twins.groupBy(F.md5(F.to_json(whole, {"ignoreNullFields": "false"})).alias("__row")).agg(*[F.first(f"`{c}`").alias(c) for c in docs.columns], F.count("*").alias("__n"))
    some = one.withColumn("__from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1, F.lit(EXPLODED).cast("long"))))
    each = some.withColumn("__i", F.explode(F.sequence(F.col("__from"), F.least(F.col("__from") + EXPLODED, F.col("__n")) - 1)))
    return alone.unionByName(each.select(*[F.col(f"`{c}`") for c in docs.columns], F.concat_ws("|", "__row", "__i").alias("__twin")))


def rates(docs: DataFrame, weights: dict[str | None, float], default_weight: float, target: float | None, source_col: str) -> DataFrame:
    """(source, rate): the mean repetitions of each source's documents."""
    source = source_key(source_col)
    sizes = docs.groupBy(source.alias("__source")).agg(F.count("*").alias("__n"))
    weight = F.lit(float(default_weight))
    for name, w in sorted(weights.items(), key=lambda x: str(x[0])):
        weight = F.when(F.col("__source") == ("-" if name is None else f"+{name}"), F.lit(float(w))).otherwise(weight)
    sizes = stage(sizes.withColumn("__w", weight), "source-sizes")
    total = sizes.agg(F.sum("__w").alias("w"), F.sum("__n").alias("n")).first()
    wanted = float(target if target is not None else total["n"] or 0)
    whole = float(total["w"] or 0)
    rate = F.col("__w") * F.lit(wanted) / F.lit(whole) / F.col("__n") if whole > 0 else F.lit(0.0)
    return sizes.select("__source", rate.alias("__rate"))


def poisson_steps(table: DataFrame) -> DataFrame:
    """rates by draw with __draws and __cdf: P(count <= k) of a draw for k = 0, 1, ... until what is left is below 1e-12."""
    draws = F.greatest(F.ceil(F.col("__rate") / MAX_RATE), F.lit(1)).cast("int")
    table = table.withColumn("__draws", draws).withColumn("__rate", F.col("__rate") / F.col("__draws"))
    last = F.ceil(F.col("__rate") + 10 * F.sqrt("__rate") + 20).cast("int")
    start = F.struct(
        F.exp(-F.col("__rate")).alias("p"), F.exp(-F.col("__rate")).alias("c"), F.array(F.exp(-F.col("__rate"))).alias("all")
    )

    def add(acc: Column, k: Column) -> Column:
        p = acc["p"] * F.col("__rate") / k
        return F.struct(p.alias("p"), (acc["c"] + p).alias("c"), F.concat(acc["all"], F.array(acc["c"] + p)).alias("all"))

    return table.withColumn("__cdf", F.aggregate(F.sequence(F.lit(1), last), start, add)["all"])


def mix(
    docs: DataFrame, weights: dict[str | None, float] | None = None, default_weight: float = 1.0, target: float | None = None,
    seed: int = 17, id_col: str = "doc_id", source_col: str = "source", copy_col: str = "copy",
) -> DataFrame:
    """docs, each repeated by its Poisson count and dealt out at random, with copy_col from 0. weights: by source, None for the null one."""
    table = stage(poisson_steps(rates(docs, weights or {}, default_weight, target, source_col)), "source-rates")
    n_sources = table.count()
    copies = "__copy"
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() != copy_col.lower()]
    drawn_by = [F.lit(seed), F.col(f"`{id_col}`"), F.col(f"`{source_col}`")]

    def own(*more: Column) -> Column:
        return F.when(F.col("__twin").isNull(), uniform(*drawn_by, *more)).otherwise(uniform(*drawn_by, F.col("__twin"), *more))

    keyed = with_twins(docs.select(*kept), id_col, source_col).select("*", source_key(source_col).alias("__source"), own().alias("__u"))
    if n_sources <= BROADCAST_SOURCES:
        joined = keyed.join(F.broadcast(table), "__source")
    else:  # a hot source is spread over salts
        salts = 64
        joined = keyed.withColumn("__salt", (F.col("__u") * salts).cast("int")).join(
            table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), ["__source", "__salt"]
        )
    def drawn(u: Column) -> Column:
        return F.aggregate("__cdf", F.lit(0), lambda n, c: n + (c <= u).cast("int"))

    more = F.aggregate(  # the draws after the first
        F.sequence(F.lit(1), F.col("__draws") - 1), F.lit(0),
        lambda n, i: n + drawn(own(i)),
    )
    count = drawn(F.col("__u")) + F.when(F.col("__draws") > 1, more).otherwise(0)
    run = F.sequence(F.col("__from"), F.least(F.col("__from") + EXPLODED, F.col("__count")) - 1)
    return (
        joined.where(F.col("__rate") > 0)
        .withColumn("__count", count)
        .where(F.col("__count") > 0)
        .withColumn("__from", F.explode(F.sequence(F.lit(0), F.col("__count") - 1, F.lit(EXPLODED))))
        .select(*kept, "__twin", F.explode(run).alias(copies))
        .withColumn("__deal", F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), "__twin", F.col(copies)))
        .repartition("__deal")
        .sortWithinPartitions("__deal")
        .select(*kept, F.col(copies).alias(copy_col))
    )
