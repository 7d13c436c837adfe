"""Sketches, one-pass metrics, native addresses, and caps against plain versions; and what their plans must not hold."""

import io
import random
import re
from collections import Counter, defaultdict
from contextlib import redirect_stdout

import pytest
from conftest import SF
from pyspark.sql import functions as F

from edgelens.operators import addresses, caps, rollups
from edgelens.plans.queries import QUERIES


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.mark.parametrize("name", ["c2_sni_sentinel", "c3_sni_per_ip", "c4_challenge_counts", "c5_block_counts", "a6_ip_sni", "a9_block_counts", "a11_challenge_counts", "c11_loss_minutes", "a19_track_health"])
def test_rankings_pass_on_few_keys_only(spark, name):
    text = plan(QUERIES[name](spark, SF))
    windows, limits = re.findall(r"(?<!Group)\bWindow \[", text), re.findall(r"WindowGroupLimit .*Final", text)
    assert 0 < len(windows) == len(limits)  # each window is above a group limit


def test_one_scan_serves_counts_and_caps(spark):
    assert executed(QUERIES["a19_track_health"](spark, SF)).count("FileScan parquet") == 1
    assert executed(QUERIES["c4_challenge_counts"](spark, SF)).count("FileScan parquet") == 1


@pytest.mark.parametrize("name", ["t2_cpu_rates", "t4_sched_p99"])
def test_the_node_view_has_no_windows_of_its_own(spark, name):
    for parts in re.findall(r"windowspecdefinition\((.*?) ASC", plan(QUERIES[name](spark, SF))):
        assert "slice" in parts or "block" in parts, parts


def plain_keyed(rows, n, reserve):
    """rows: (w, key, seq, page): the first n keys of a window, then the first `reserve` others that are no pages."""
    counts, first, out = Counter(), {}, {}
    for w, k, s, _ in rows:
        counts[w, k] += 1
        first[w, k] = min(s, first.get((w, k), s))
    for w in {w for w, _ in counts}:
        order = sorted((k for v, k in counts if v == w), key=lambda k: (first[w, k], k is not None, k or ""))
        late = [k for k in order[n:] if not (k or "").startswith("p")]
        for k in order:
            out[w, k] = (counts[w, k], k in order[:n] or k in late[:reserve])
    return out


def test_caps_with_null_keys_equal_plain_ones(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice([1, 2, None]), rnd.choice([None, *[f"p{i}" for i in range(8)], *[f"q{i}" for i in range(12)]]), i, None) for i in range(400)]
    df = spark.createDataFrame([r[:3] for r in rows], "w long, k string, seq long").repartition(3)
    want = plain_keyed(rows, 5, 3)
    got = caps.cap_two_tier(df, ["k"], F.coalesce(F.col("k").startswith("p"), F.lit(False)), 5, 3)
    assert {(r.w, r.k): (r.cnt, r.kept) for r in got.collect()} == want
    once = plain_keyed(rows, 5, 0)
    got = {(r.w, r.k): r.cnt for r in caps.cap_with_sentinel(df, ["k"], 5, {"k": F.lit("over")}).collect()}
    plain = Counter()
    for (w, k), (n, kept) in once.items():
        plain[w, k if kept else "over"] += n
    assert got == dict(plain)
    pos = {(r.w, r.k, r.seq): r.pos for r in caps.position(df, ["w", "k"]).collect()}
    order = defaultdict(list)
    for w, k, s, _ in rows:
        order[w, k].append(s)
    assert pos == {(w, k, s): i for (w, k), own in order.items() for i, s in enumerate(sorted(own))}


def test_fair_vhosts_and_their_rejects(spark):
    rnd = random.Random(6)
    rows = [(w, rnd.choice([0, 16, 32, 5, 21, 37, 7, 1000]), i, f"/{rnd.randrange(4)}", 2) for i, w in enumerate(rnd.choices([1, 2], k=500))]
    df = spark.createDataFrame(rows, "w long, vhost_id long, seq long, path_bucket string, status_bucket int")
    for tracked in (16, 40):
        tracks = defaultdict(list)
        for w, v, *_ in rows:
            if v not in tracks[w, v % 16] and len(tracks[w, v % 16]) < -(-tracked // 16):
                tracks[w, v % 16].append(v)
        inside = lambda r: r[1] in tracks[r[0], r[1] % 16]
        assert {tuple(r) for r in addresses.fair_vhosts(df, tracked).collect()} == {(w, v) for (w, _), own in tracks.items() for v in own}
        assert {r.w: r.rejected for r in addresses.fair_rejects(df, tracked).collect()} == Counter(r[0] for r in rows if not inside(r))
        counts = defaultdict(Counter)
        for r in filter(inside, rows):
            counts[r[:2]][r[3]] += 1
        want = {(*g, p, n) for g, c in counts.items() for p, n in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:2]}
        assert {(r.w, r.vhost_id, r.path_bucket, r.cnt) for r in addresses.fair_top_paths(df, 2, tracked).collect()} == want


def test_native_ipv4_equals_the_parser(spark):
    rnd = random.Random(2)
    octet = lambda: rnd.choice([str(rnd.randrange(256)), "0", "255", "256", "01", "1a", "", "٣"])
    texts = [None, "", ":", "::", "]:", "[]:", "1.2.3.4\n", "1.2.3.4:80\n", "[1.2.3.4]:1]:2", "[[1.2.3.4]:1", "x1.2.3.4]:5", "[::ffff:1.2.3.4]:5", "::ffff:1.2.3.4:5", "::FFFF:1.2.3.4", "1.2.3.4:5:6", " 1.2.3.4"]
    for _ in range(3000):
        t = ".".join(octet() if rnd.random() < 0.2 else str(rnd.randrange(256)) for _ in range(rnd.choice([4, 4, 4, 4, 3, 5])))
        texts.append(rnd.choice(["{}", "{}:443", "[{}]:80", "::ffff:{}", "[::ffff:{}]:1", "{}:", "2001:db8::{}", "{}%eth0", "[{}]", "::fFfF:{}"]).format(t))
    df = spark.createDataFrame([(t,) for t in texts], "remote_addr string")
    want = {t: addresses.canonical(t) for t in set(texts)}
    got = {r.remote_addr: (r.ip, r.prefix, r.prefix_len) for r in addresses.ip_dimension(df).collect()}
    assert got == want
    native = {r.t: r.a for r in df.select(F.col("remote_addr").alias("t"), addresses.ipv4(F.col("remote_addr")).alias("a")).collect()}
    assert all(tuple(a) == want[t] for t, a in native.items() if a) and sum(a is not None for a in native.values()) > 700
    assert all(native[t] for t, (ip, _, bits) in want.items() if bits == 24 and re.fullmatch(r"(\[?(::ffff:)?[0-9.]+(\]:|:)?[0-9]*)", t))
    only = addresses.ip_dimension(df, v6=False)
    assert "Python" not in plan(only) and only.where("ip is not null").count() > 700


def test_sketches_of_clients_are_near_and_merge(spark):
    df = spark.range(60_000).select((F.col("id") % 3).alias("minute"), F.lit(1).alias("vhost_id"), (F.col("id") % 20_000).cast("string").alias("hash_ip"), F.lit(None).cast("string").alias("ua"))
    parts = [rollups.client_sketches(df.where(f"hash_ip % 2 = {i}"), "s") for i in range(2)] + [rollups.client_sketches(df, "s")]
    merged = rollups.merge_rollups(["minute", "vhost_id"], [], *parts, sketches=["clients"])
    got = {r.minute: r.n for r in merged.select("minute", F.hll_sketch_estimate("clients").alias("n")).collect()}
    exact = {r.minute: r.n for r in df.groupBy("minute").agg(F.count_distinct("hash_ip").alias("n")).collect()}
    assert set(got) == set(exact) and all(abs(got[m] - n) <= 5 * 1.04 / 64 * n for m, n in exact.items())
    assert rollups.client_sketches(df, "").count() == 0
    e = spark.createDataFrame([(1, "a"), (1, "b")], "k long, entry string")
    assert rollups.merge_entries(e, e.limit(1), e).count() == 2


def test_heavy_hitters_are_never_under_counted(spark):
    rnd = random.Random(1)
    rows = [(1, f"hot{i}") for i in range(12) for _ in range(4000 // (i + 1))] + [(1, f"cold{rnd.randrange(10**9)}") for _ in range(20_000)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "w long, ip string").repartition(5)
    exact = Counter(ip for _, ip in rows)
    halves = df.randomSplit([0.4, 0.6], 7)
    tracked = 512
    parts = [addresses.ip_sketches(h, ["w"], tracked=tracked) for h in halves]
    got = {r.ip: r.cnt for r in addresses.top_by_sketch(["w"], 6, *parts, tracked=tracked).collect()}
    assert set(got) == {f"hot{i}" for i in range(6)}
    assert all(exact[ip] <= n <= exact[ip] + len(rows) / (0.75 * tracked) * 2 for ip, n in got.items())


def test_rows_are_measured_on_the_way(spark, tmp_path):
    df = spark.createDataFrame([("a" * 64, 1), ("a" * 64, 0), ("A" * 64, 1), (None, 0), ("a" * 64, None)], "health_key string, vhost_id long")
    rules = rollups.health_rules()
    rows, seen = rollups.measured(df, "domain_health", rules)
    rows.write.parquet(f"{tmp_path}/in")
    assert seen.get == {"rows_in": 5, "rejects": 4, "health_key": 2, "vhost": 2}
    stream, name = rollups.measured(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"), "domain_health", rules)
    q = stream.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination()
    assert rollups.stream_metrics(q, name) == {"rows_in": 5, "rejects": 4, "health_key": 2, "vhost": 2}
