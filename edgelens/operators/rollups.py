"""Keyed aggregates over facts, connections and node samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from edgelens.functions import columns as C
from edgelens.operators import caps

COUNTER_KEY = ["minute", "vhost_id", "method_norm", "status", "origin", "country_norm", "asn_norm", "exempt"]
#: Cumulative counters of a machine, fixed names in their order.
NODE_COUNTERS = ["waf_skipped_detect", "waf_skipped_static", "waf_would_skip", "shed_p0", "shed_p1", "shed_p2", "shed_p3", "would_shed"]
BUCKETS = len(C.LATENCY_BOUNDS_US) + 1


def request_counters(facts: DataFrame, histogram: bool = False) -> DataFrame:
    """One row per counter key: count, bytes, duration and, if asked for, sparse latency buckets."""
    aggs = [F.count("*").alias("request_count"), F.sum("bytes_in").alias("bytes_in"), F.sum("bytes_out").alias("bytes_out"), F.sum("duration_us").alias("duration_us_sum")]
    if histogram:
        aggs += [F.nullif(F.sum(F.when(F.col("lat_bucket") == i, 1).otherwise(0)), F.lit(0)).alias(f"lat_b{i:02d}") for i in range(BUCKETS)]
    return facts.groupBy(*COUNTER_KEY).agg(*aggs)


def unique_clients(facts: DataFrame, salt: str, keys: tuple[str, ...] = ("minute", "vhost_id")) -> DataFrame:
    """Distinct client hashes; an empty salt disables the track. A client is hashed once for each key that it has."""
    clients = facts.where(F.lit(bool(salt))).select(*keys, "hash_ip", "ua").distinct()
    return clients.select(*keys, C.client_hash(F.coalesce("hash_ip", F.lit("")), F.coalesce("ua", F.lit("")), salt).alias("client_hash")).distinct()


def counts(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("cnt"))


def upstream_evidence() -> tuple[Column, Column]:
    """(observed, status): whether a request proves that an upstream answered, and with what."""
    c = F.col
    latency = (c("upstream_latency_us") > 0) & (c("latency_before_us").isNull() | (c("upstream_latency_us") != c("latency_before_us")))
    status = c("upstream_status")
    seen = (c("origin") == "upstream") & (c("wrote") | c("retried_response")) & latency & ((status == 101) | status.between(200, 599))
    return F.coalesce(seen, F.lit(False)), status


def domain_health(facts: DataFrame) -> DataFrame:
    """Six counters per (minute, vhost, configuration key); keys are 64 lower-case hex digits."""
    seen, status = upstream_evidence()
    failed = F.col("origin") == "cluster_proxy_error"
    routed = (~F.col("err_is_handler") & ~failed & (F.col("wrote") | ((F.col("origin") != "upstream") & ~F.col("cancelled")))) | seen
    total = lambda cond: F.sum(F.when(cond, 1).otherwise(0))
    return validated(facts, health_rules())[0].groupBy("minute", "vhost_id", "health_key").agg(
        F.count("*").alias("request_count"), total(routed).alias("routing_responses"), total(seen).alias("upstream_responses"),
        total(seen & status.between(200, 399)).alias("upstream_successes"), total(seen & status.between(500, 599)).alias("upstream_5xx"),
        total(failed).alias("proxy_errors"),
    )


def node_state_minutes(samples: DataFrame, counters: list[str] = NODE_COUNTERS) -> DataFrame:
    """Per machine and minute: maxima, seconds at levels, reason bits, least known burst estimate and its last
    model, least limit in force, last processors, and each counter's delta as the first value of the next observed
    minute less the first of this. Then the emission rule: completed minutes at a level, with a counter, or each tenth."""
    m = samples.withColumn("minute", C.minute(F.col("ts"))).groupBy("machine_id", "minute").agg(
        F.max("level").alias("max_level"), F.sum(F.when(F.col("level") == 1, 1).otherwise(0)).alias("level1_samples"),
        F.sum(F.when(F.col("level") == 2, 1).otherwise(0)).alias("level2_samples"), F.bit_or("reasons").alias("reasons"), F.max("sched_us").alias("max_sched_us"),
        F.coalesce(F.min(F.when(F.col("burst_est") != -1, F.col("burst_est"))), F.lit(-1)).alias("burst_est"), F.max_by("burst_model", "t").alias("burst_model"),
        F.max("inflight").alias("max_inflight"), F.coalesce(F.min(F.when(F.col("admission_limit") > 0, F.col("admission_limit"))), F.lit(0)).alias("admission_limit"),
        F.max_by("gomaxprocs", "t").alias("gomaxprocs"), *[F.min_by(c, "t").alias(c) for c in counters],
    )
    order = Window.partitionBy("machine_id").orderBy("minute")
    m = m.withColumns({"later": F.lead("minute").over(order), **{c: F.lead(c).over(order) - F.col(c) for c in counters}}).where("later is not null").drop("later")
    worth = (F.col("max_level") > 0) | (F.minute("minute") % 10 == 0)
    for c in counters:
        worth = worth | (F.col(c) > 0)
    return m.where(worth)


#: Buckets (as a power of two) of a distinct-count sketch: its relative standard error is 1.04 / sqrt(2 ** 12), 1.6 %.
SKETCH_BITS = 12


def client_sketches(facts: DataFrame, salt: str, keys: tuple[str, ...] = ("minute", "vhost_id")) -> DataFrame:
    """(keys, clients): a sketch of each key's different clients, of at most 4 KiB or so; partial rows merge by
    merge_rollups. An empty salt disables the track."""
    rows = facts.where(F.lit(bool(salt)))
    client = F.concat_ws("\x1f", F.coalesce("hash_ip", F.lit("")), F.coalesce("ua", F.lit("")), F.lit(salt))
    return rows.groupBy(*keys).agg(F.hll_sketch_agg(client, F.lit(SKETCH_BITS)).alias("clients"))


def merge_rollups(key: list[str], measures: list[str], *parts: DataFrame, sets: list[str] = (), maxima: list[str] = (), sketches: list[str] = ()) -> DataFrame:
    """Partial rows of one track on the natural key: measures are summed, sets united, maxima taken, sketches of distinct
    counts united (hll_sketch_estimate reads them).

    A set is one value of its row; a track of large sets should keep a sketch, or an entry a row and merge_entries."""
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p, allowMissingColumns=True)
    merged = [F.sum(m).alias(m) for m in measures] + [F.max(m).alias(m) for m in maxima] + [F.hll_union_agg(s).alias(s) for s in sketches]
    return whole.groupBy(*key).agg(*merged, *[F.array_distinct(F.flatten(F.collect_list(s))).alias(s) for s in sets])


def merge_entries(*parts: DataFrame) -> DataFrame:
    """Partial rows of a track that keeps a row for each entry of its sets: each entry once."""
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole.distinct()


def validated(rows: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) rows; rejected ones have reject, the first rule that they break. Null breaks a rule."""
    broken = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in rules.items()])
    tagged = rows.withColumn("reject", broken)
    return tagged.where("reject is null").drop("reject"), tagged.where("reject is not null")


def intake(rows: DataFrame, tracks: dict[str, dict[str, Column]]) -> DataFrame:
    """(track, rows_in, rejects, first rule broken -> count as a map) of rows offered to tracks, in one pass."""
    one = []
    for name, rules in tracks.items():
        broken = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), rule) for rule, ok in rules.items()])
        one.append(F.struct(F.lit(name).alias("track"), broken.alias("reject")))
    each = rows.select(F.explode(F.array(*one)).alias("t")).groupBy("t.track", "t.reject").agg(F.count("*").alias("cnt"))
    by_rule = F.map_from_entries(F.collect_list(F.when(F.col("reject").isNotNull(), F.struct("reject", "cnt"))))
    lost = F.coalesce(F.sum(F.when(F.col("reject").isNotNull(), F.col("cnt"))), F.lit(0))
    return each.groupBy("track").agg(F.sum("cnt").alias("rows_in"), lost.alias("rejects"), by_rule.alias("by_rule"))


def health_rules() -> dict[str, Column]:
    """What a row of domain health must be: its key 64 lower-case hex digits, its vhost not 0."""
    return {"health_key": F.col("health_key").rlike("^[0-9a-f]{64}$"), "vhost": F.col("vhost_id") != 0}


#: Reasons of a close that are counted, fixed values.
CLOSE_REASONS = ["ip", "sni", "ja3", "ja4", "abuseipdb"]


def close_rules() -> dict[str, Column]:
    return {"reason": F.col("reason").isin(CLOSE_REASONS), "ip": F.col("ip").isNotNull()}


def fingerprint_rules() -> dict[str, Column]:
    return {"ja3": F.col("ja3") != "", "ja4": F.col("ja4") != ""}


def track_health(rows: DataFrame, tracks: dict[str, tuple[list[str], int, dict[str, Column]]], window: str = "w", seq: str = "seq") -> DataFrame:
    """Per track: rows offered and refused, keys kept, and increments and keys dropped, all from one scan of the rows.

    tracks: name -> (keys, cap of a window, rules that rows must keep)."""
    each = []
    for name, (keys, n, rules) in tracks.items():
        good = F.lit(True)
        for rule in rules.values():
            good = good & F.coalesce(rule, F.lit(False))
        key = F.array(*[F.col(k).cast("string") for k in keys])
        each.append(F.struct(F.lit(name).alias("track"), F.lit(n).alias("cap"), F.when(good, key).alias("key")))
    offered = rows.select(F.col(window).alias("w"), F.col(seq).alias("seq"), F.explode(F.array(*each)).alias("t"))
    counts = offered.groupBy("w", "t.track", "t.cap", "t.key").agg(F.count("*").alias("cnt"), F.min("seq").alias("first"))
    good = counts.where("key is not null")
    kept = None
    for n in sorted({n for _, n, _ in tracks.values()}):
        own = caps.admitted(good.where(F.col("cap") == n), ["track", "w"], ["key"], n)
        kept = own if kept is None else kept.unionByName(own)
    both = caps.marked(counts, kept, ["w", "track", "cap", "key"], "kept")
    of = lambda which, what: F.coalesce(F.sum(F.when(which, what)), F.lit(0)).cast("long")
    kept, over, bad = F.col("kept"), ~F.col("kept") & F.col("key").isNotNull(), F.col("key").isNull()
    return both.groupBy("track").agg(
        F.sum("cnt").alias("rows_in"), of(bad, F.col("cnt")).alias("rejects"), of(kept, F.lit(1)).alias("keys_kept"), of(kept, F.col("cnt")).alias("counted"),
        of(over, F.col("cnt")).alias("overflow"), of(over, F.lit(1)).alias("keys_dropped"),
    )


def measured(rows: DataFrame, track: str, rules: dict[str, Column]) -> tuple[DataFrame, Observation | str]:
    """rows, and what tells how many of them were offered to a track and refused, by rule, without another pass: an Observation
    to be read once an action over them ended; of a stream its name in the progress (stream_metrics)."""
    broken = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in rules.items()], F.lit(""))
    sums = [F.sum(F.when(broken == name, 1).otherwise(0)).alias(name) for name in rules]
    name = f"track_{track}"
    by = name if rows.isStreaming else Observation(name)
    return rows.observe(by, F.count(F.lit(1)).alias("rows_in"), F.sum(F.when(broken != "", 1).otherwise(0)).alias("rejects"), *sums), by


def stream_metrics(query: StreamingQuery, name: str) -> dict[str, int]:
    """The sums of an observed name over the micro-batches that a query still reports."""
    out: dict[str, int] = {}
    for p in query.recentProgress:
        for k, v in (p.observedMetrics[name].asDict() if name in p.observedMetrics else {}).items():
            out[k] = out.get(k, 0) + (v or 0)
    return out
