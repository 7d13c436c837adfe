"""First-come key caps and position-dependent sampling.

A cap admits the first n different keys of a flush window in order of arrival; admitted keys keep counting
and the rest is overflow. Keys are aggregated before they are ranked, and a ranking passes on n keys of a window only; what is
beyond a cap is found by joining the few admitted keys back, so no task ranks all keys of a window. Row-level operators go
by machine and window, since the counters they stand for are kept per process, and number rows by slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from edgelens.operators.series import numbered


def keyed_counts(rows: DataFrame, keys: list[str], window: str, count: Column | None = None, seq: str = "seq") -> DataFrame:
    """(window, keys, cnt, first): counts and first arrival of each key."""
    return rows.groupBy(window, *keys).agg((F.count("*") if count is None else F.sum(count)).alias("cnt"), F.min(seq).alias("first"))


def ranked(counts: DataFrame, window: list[str], keys: list[str]) -> DataFrame:
    """With the arrival of each key in its window; keys that arrive together are ordered by themselves."""
    return counts.withColumn("arrival", F.row_number().over(Window.partitionBy(*window).orderBy("first", *keys)))


def cap_keys(rows: DataFrame, keys: list[str], n: int, window: str = "w") -> tuple[DataFrame, DataFrame]:
    """(admitted counts, overflow per window). A task ranks only the first n keys of what it holds of a window,
    and the overflow is the window's total without the admitted keys."""
    counts = keyed_counts(rows, keys, window)
    kept = ranked(counts, [window], keys).where(F.col("arrival") <= n).select(window, *keys, "cnt")
    total = counts.groupBy(window).agg(F.sum("cnt").alias("cnt"), F.count("*").alias("keys"))
    own = kept.groupBy(F.col(window).alias("__w")).agg(F.sum("cnt").alias("own"), F.count("*").alias("own_keys"))
    rest = total.join(own, F.col(window).eqNullSafe(F.col("__w")), "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("own", "own_keys")})
    over = rest.where(F.col("keys") > F.col("own_keys")).select(window, (F.col("cnt") - F.col("own")).alias("overflow"), (F.col("keys") - F.col("own_keys")).alias("keys_dropped"))
    return kept, over


def admitted(counts: DataFrame, window: list[str], keys: list[str], n: int) -> DataFrame:
    """counts of the first n keys of each window. Tasks pass on n keys of a window each, not all that they hold."""
    return ranked(counts, window, keys).where(F.col("arrival") <= n).drop("arrival")


def marked(counts: DataFrame, chosen: DataFrame, on: list[str], flag: str) -> DataFrame:
    """counts with flag: whether their key, nulls too, is among the chosen, some rows of the same counts.

    Both sides read all columns of counts, so that Spark aggregates the rows once for both."""
    on = [*on, "first"]
    other = chosen.select(*[F.col(f"`{c}`").alias(f"__{c}") for c in (*on, "cnt")])
    same = None
    for c in on:
        own = counts[c].eqNullSafe(F.col(f"`__{c}`"))
        same = own if same is None else same & own
    return counts.join(other, same, "left").withColumn(flag, F.col("__cnt").isNotNull()).drop(*[f"__{c}" for c in (*on, "cnt")])


def cap_with_sentinel(rows: DataFrame, keys: list[str], n: int, sentinel: dict[str, Column], window: str = "w") -> DataFrame:
    """Counts in which keys beyond the cap are re-keyed by sentinel and summed again."""
    counts = keyed_counts(rows, keys, window)
    r = marked(counts, admitted(counts, [window], keys, n), [window, *keys], "__in")
    r = r.withColumns({k: F.when(F.col("__in"), F.col(k)).otherwise(v) for k, v in sentinel.items()})
    return r.groupBy(window, *keys).agg(F.sum("cnt").alias("cnt"))


def _per_group(rows: DataFrame, group: str, key: str, n: int, sentinel: str, window: str, more: tuple[str, ...]) -> DataFrame:
    counts = keyed_counts(rows, [group, key, *more], window)
    r = marked(counts, admitted(counts, [window, group], [key, *more], n), [window, group, key, *more], "__in")
    r = r.withColumn(key, F.when(F.col("__in"), F.col(key)).otherwise(sentinel))
    return r.groupBy(window, group, key, *more).agg(F.sum("cnt").alias("cnt"), F.min("first").alias("first"))


def cap_per_group(rows: DataFrame, group: str, key: str, n: int, sentinel: str = "__overflow__", window: str = "w", more: tuple[str, ...] = ()) -> DataFrame:
    """At most n different keys in each group; later ones become the sentinel."""
    return _per_group(rows, group, key, n, sentinel, window, more).drop("first")


def cap_nested(rows: DataFrame, group: str, key: str, n: int, most: int, sentinel: str = "__overflow__", window: str = "w", more: tuple[str, ...] = ()) -> DataFrame:
    """cap_per_group, and of its rows the first most of each window."""
    r = _per_group(rows, group, key, n, sentinel, window, more)
    return ranked(r, [window], [group, key, *more]).where(F.col("arrival") <= most).drop("first", "arrival")


def is_page(outcome: Column, source: Column) -> Column:
    """Outcomes whose silent loss is lenient."""
    return (source != "") & (outcome.startswith("issued_") | outcome.startswith("not_shown_"))


def cap_two_tier(rows: DataFrame, keys: list[str], page: Column, n: int, reserve: int, window: str = "w") -> DataFrame:
    """Counts with kept: the first n keys of any kind, then the first reserve others that are no pages."""
    counts = keyed_counts(rows, keys, window).withColumn("page", page)
    on = [window, *keys]
    tier = marked(counts, admitted(counts, [window], keys, n), on, "__in")
    second = admitted(tier.where(~F.col("__in") & ~F.col("page")).drop("__in"), [window], keys, reserve)
    out = marked(tier, second, on, "__reserve")
    return out.withColumn("kept", F.col("__in") | F.col("__reserve")).select(window, *keys, "cnt", "page", "kept")


def position(rows: DataFrame, parts: list[str], seq: str = "seq") -> DataFrame:
    """rows with pos, their place in their parts from 0. A task sorts a slice of a part, not the whole part."""
    key = F.to_json(F.struct(*parts))  # nulls are left out of it, by name
    return numbered(rows.withColumn("__part", key), "__part", seq).withColumn("pos", F.col("n") - 1).drop("__part", "n")


def cap_rows(rows: DataFrame, n: int, parts: list[str], seq: str = "seq") -> DataFrame:
    """The first n rows of each window and machine; tasks pass on n rows of each."""
    first = F.row_number().over(Window.partitionBy(*parts).orderBy(seq))
    return rows.withColumn("__n", first).where(F.col("__n") <= n).drop("__n")


def sample_under_load(rows: DataFrame, threshold: int, parts: list[str], floor: Column | None = None) -> DataFrame:
    """One row of each factor once a window has seen threshold rows; sample_rate is the factor."""
    factor = F.lit(1) if threshold <= 0 else F.when(F.col("pos") >= threshold, F.floor(F.col("pos") / threshold) + 1).otherwise(1)
    factor = factor if floor is None else F.greatest(factor, floor)
    r = position(rows, parts).withColumn("sample_rate", factor.cast("long"))
    return r.where(F.col("pos") % F.col("sample_rate") == 0).drop("pos")


def sample_by_disposition(rows: DataFrame, threshold: int, parts: list[str]) -> DataFrame:
    """Served rows stay; the others are sampled by their own position."""
    served = rows.where("disposition = 'served'").withColumn("sample_rate", F.lit(1).cast("long"))
    return served.unionByName(sample_under_load(rows.where("disposition <> 'served'"), threshold, parts))


def pressure_floor(p: Column) -> Column:
    return F.when(p <= 0.7, 1).otherwise(1 + F.round(15 * F.least(F.lit(1.0), (p - 0.7) / 0.3))).cast("long")


def loss_minutes(two_tier: DataFrame, minute: str = "minute") -> DataFrame:
    """Dropped increments of the outcomes that may not be lost silently, by minute."""
    return two_tier.where("not kept and not page").groupBy(minute).agg(F.sum("cnt").alias("lost_count"))
