"""Address dimension, host attribution, heavy hitters and as-of ranking of upstreams."""

from __future__ import annotations

import ipaddress

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from edgelens.functions import columns as C
from edgelens.runtime import importable

BROADCAST_HOSTS = 500_000  # 253-byte names at most: 150 MB, checked before the hint


def canonical(text: str | None) -> tuple[str | None, str | None, int | None]:
    """(ip, prefix, length) of an address with or without port, or nothing. Brackets go with a port only; blanks
    around an address make it none."""
    t = text or ""
    if "]:" in t:
        t = t[1 : t.rindex("]:")]
    elif t.count(":") == 1:
        t = t.split(":")[0]
    try:
        ip = ipaddress.ip_address(t)
    except ValueError:
        return None, None, None
    zone = getattr(ip, "scope_id", None)
    ip = getattr(ip, "ipv4_mapped", None) or ip
    bits = 24 if ip.version == 4 else 56
    net = ipaddress.ip_network(f"{str(ip).split('%')[0]}/{bits}", strict=False)
    return str(ip) if not zone else f"{ip}", str(net.network_address), bits


def plain_address(text: str | None) -> str | None:
    """The canonical form of an address without port; IPv4 within IPv6 as IPv4."""
    try:
        ip = ipaddress.ip_address((text or "").strip())
    except ValueError:
        return None
    return str(getattr(ip, "ipv4_mapped", None) or ip)


_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: An IPv4 address, plain or in IPv6's ::ffff: form, with or without a port; groups: the address and its first three numbers with their dot.
_V4_FORMS = [r"^((OOO)O)(?::[^:]*)?\z", r"^(?i:::ffff:)((OOO)O)\z", r"^\[(?i:::ffff:)?((OOO)O)\]:(?!.*\]:)(?s:.*)\z"]
V4_FORMS = [f.replace("(OOO)O", rf"((?:{_OCTET}\.){{3}}){_OCTET}") for f in _V4_FORMS]


def ipv4(text: Column) -> Column:
    """struct<ip, prefix, prefix_len> of an IPv4 address in one of V4_FORMS, as canonical() has it; else null. In Catalyst."""
    out = None
    for form in V4_FORMS:
        value = F.struct(F.regexp_extract(text, form, 1).alias("ip"), F.concat(F.regexp_extract(text, form, 2), F.lit("0")).alias("prefix"), F.lit(24).alias("prefix_len"))
        out = F.when(text.rlike(form), value) if out is None else out.when(text.rlike(form), value)
    return out


def ip_dimension(rows: DataFrame, col: str = "remote_addr", v6: bool = True) -> DataFrame:
    """(col, ip, prefix, prefix_len) of the different addresses; each is parsed once, IPv4 in Catalyst and only other
    forms in Python. Without v6, other forms are no addresses, and nothing leaves the JVM."""
    importable(rows.sparkSession)
    different = rows.select(col).distinct().withColumn("a", ipv4(F.col(col)))
    if not v6:
        return different.select(col, "a.ip", "a.prefix", "a.prefix_len")

    @F.pandas_udf("ip string, prefix string, prefix_len int")
    def parse(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([canonical(x) for x in s], columns=["ip", "prefix", "prefix_len"]).astype({"prefix_len": "Int32"})

    four = different.where("a is not null").select(col, "a.ip", "a.prefix", "a.prefix_len")
    other = different.where("a is null").select(col).withColumn("a", parse(col)).select(col, "a.ip", "a.prefix", "a.prefix_len")
    return four.unionByName(other)


def without_zone(ip: Column) -> Column:
    """An address without the scope zone, which means something on one connection only."""
    return F.substring_index(ip, "%", 1)


def with_client_ip(rows: DataFrame, col: str = "remote_addr", out: str = "client_ip") -> DataFrame:
    """rows with the canonical address of the connection, or its trimmed text where that is no address."""
    known = ip_dimension(rows, col).select(F.col(col).alias("__addr"), F.col("ip").alias("__ip"))
    joined = rows.join(known, F.col(col) == F.col("__addr"), "left")
    return joined.withColumn(out, F.coalesce("__ip", F.trim(col))).drop("__addr", "__ip")


def with_address(rows: DataFrame, col: str = "remote_addr") -> DataFrame:
    """rows with ip, prefix and prefix_len, null where col is no address."""
    known = ip_dimension(rows, col).withColumnRenamed(col, "__addr")
    return rows.join(known, F.col(col) == F.col("__addr"), "left").drop("__addr")


def with_ip(rows: DataFrame, col: str = "remote_addr") -> DataFrame:
    """Rows with a valid address, and its canonical form."""
    return rows.join(ip_dimension(rows, col).where("ip is not null"), col)


def normal_host(host: Column) -> Column:
    """Without numeric port and one trailing dot, ASCII-lowered; null if it cannot be a host."""
    bare = F.regexp_replace(F.regexp_replace(host, ":[0-9]*$", ""), r"\.$", "")
    low = F.translate(bare, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(low.rlike(r"^[a-z0-9._-]{1,253}$"), low)


def load_hosts(dimension: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) rows of (host, vhost_id)."""
    good = F.coalesce(F.col("host").rlike(r"^[a-z0-9._-]{0,252}[a-z0-9_-]$") & (F.col("vhost_id") > 0), F.lit(False))
    return dimension.where(good), dimension.where(~good)


def attribute_hosts(facts: DataFrame, hosts: DataFrame) -> DataFrame:
    """The table's vhost wins over the variable's; conflict marks where both speak and differ."""
    named = hosts.select(F.col("host").alias("host_norm"), F.col("vhost_id").alias("table_vhost"))
    named = F.broadcast(named) if hosts.count() <= BROADCAST_HOSTS else named
    out = facts.withColumn("host_norm", normal_host(F.col("host"))).join(named, "host_norm", "left")
    conflict = F.coalesce((F.col("table_vhost") != F.col("vhost_id")), F.lit(False))
    return out.withColumn("conflict", conflict).withColumn("vhost_id", F.coalesce("table_vhost", "vhost_id"))


def top_by_count(counts: DataFrame, group: list[str], key: list[str], k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("cnt"), *key))
    return counts.withColumn("rank", rank).where(F.col("rank") <= k)


#: Addresses that a heavy-hitter sketch tracks: counts are over by at most about 1 / (0.75 * TRACKED) of a window's rows, never under.
TRACKED = 8192


def ip_sketches(connections: DataFrame, group: list[str], ip: str = "ip", tracked: int = TRACKED) -> DataFrame:
    """(group, sketch): partial rows of heavy hitters, of a size that does not grow with the addresses."""
    return connections.groupBy(*group).agg(F.expr(f"approx_top_k_accumulate(`{ip}`, {tracked})").alias("sketch"))


def top_by_sketch(group: list[str], k: int, *parts: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """(group, ip, cnt) of the k heaviest by partial rows of any number of batches; of an address that they track cnt is its
    count or more."""
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    merged = whole.groupBy(*group).agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"))
    items = merged.select(*group, F.explode(F.expr(f"approx_top_k_estimate(sketch, {k})")).alias("t"))
    return items.select(*group, F.col("t.item").alias("ip"), F.col("t.count").alias("cnt"))


def fair_vhosts(facts: DataFrame, tracked: int, window: str = "w") -> DataFrame:
    """(window, vhost_id) of the vhosts admitted first, a share of tracked for each of 16 shards."""
    seen = facts.groupBy(window, "vhost_id").agg(F.min("seq").alias("first")).withColumn("shard", F.col("vhost_id") % 16)
    arrival = F.row_number().over(Window.partitionBy(window, "shard").orderBy("first", "vhost_id"))
    return seen.withColumn("arrival", arrival).where(F.col("arrival") <= -(-tracked // 16)).select(window, "vhost_id")


def fair_rejects(facts: DataFrame, tracked: int, window: str = "w") -> DataFrame:
    """(window, rejected): requests of the vhosts that fair_vhosts() does not admit."""
    rest = facts.groupBy(window, "vhost_id").agg(F.count("*").alias("cnt")).join(fair_vhosts(facts, tracked, window), [window, "vhost_id"], "left_anti")
    return rest.groupBy(window).agg(F.sum("cnt").alias("rejected"))


def fair_top_paths(facts: DataFrame, k: int, tracked: int, window: str = "w") -> DataFrame:
    """Top k (path, status class) of the vhosts admitted first."""
    c = facts.join(fair_vhosts(facts, tracked, window), [window, "vhost_id"], "left_semi").groupBy(window, "vhost_id", "path_bucket", "status_bucket").agg(F.count("*").alias("cnt"))
    return top_by_count(c, [window, "vhost_id"], ["path_bucket", "status_bucket"], k)


def sampled_ips(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct addresses whose FNV-1a hash is divisible by 16."""
    return rows.select(*keys, "ip").distinct().where(C.fnv64(F.col("ip")) % 16 == 0)


def rank_upstreams(points: DataFrame, scores: DataFrame, half_life_s: float = 30.0, slice_s: int = 3600, arrival: str | None = None) -> DataFrame:
    """Of the available candidates at each point the one with the lowest decayed score times (in-flight + 1); a point
    with candidates of which none is available, or without any (dial null), has nulls.

    points: (point, ts, pos, dial, available, inflight); scores: (dial, ts, score), and in arrival (optional) their order: of
    a dial's scores of one time the last to arrive counts, without that order the highest. As-of join: both sides in one
    frame, the last score carried forward within a dial's slice of time; from slice to slice goes only the last
    score of each, so that no task takes the whole history of one dial.
    """
    cut = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / slice_s).alias("slice")
    left = points.select("point", "ts", cut, "pos", "dial", "available", "inflight", F.lit(1).alias("side"))
    right = scores.where("score is not null").select("dial", "ts", cut, F.struct("ts", *([arrival] if arrival else []), "score").alias("own"), F.lit(0).alias("side"))
    both = left.unionByName(right, allowMissingColumns=True)
    order = Window.partitionBy("dial", "slice").orderBy("ts", "side", "own").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("dial").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    ends = both.groupBy("dial", "slice").agg(F.max("own").alias("end")).select("dial", "slice", F.last("end", True).over(earlier).alias("carried"))
    asked = both.withColumn("last", F.last("own", True).over(order)).where("side = 1").join(ends, ["dial", "slice"], "left")
    asked = asked.withColumn("last", F.coalesce("last", "carried"))
    us = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("last.ts").cast("timestamp"))
    score = F.coalesce(F.col("last.score") * F.pow(F.lit(0.5), us / (half_life_s * 1e6)), F.lit(0.0)) * (F.col("inflight") + 1)
    usable = F.coalesce("available", F.lit(False)) & F.col("dial").isNotNull()
    rank = F.row_number().over(Window.partitionBy("point").orderBy(F.desc("usable"), "score", "pos"))
    best = asked.withColumns({"score": score, "usable": usable}).withColumn("rank", rank).where("rank = 1")
    return best.select("point", *[F.when(F.col("usable"), F.col(c)).alias(c) for c in ("dial", "pos", "score")])
