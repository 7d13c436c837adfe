import itertools
import math
import random

import pandas as pd
import pytest
from pyspark.sql import Row, functions as F

from edgelens.functions import columns as C
from edgelens.operators import addresses, caps, rollups, series, waf
from edgelens.sources import batches, readers


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("i,bound", list(enumerate(C.LATENCY_BOUNDS_US)))
def test_latency_bucket_edges(spark, i, bound):
    assert value(spark, C.latency_bucket(F.lit(bound - 1))) == i and value(spark, C.latency_bucket(F.lit(bound))) == i + 1


@pytest.mark.parametrize("uri,want", [
    ("/", "/"), ("", "/"), ("/A/b?c", "/a/b"), ("/users/123/x", "/users/*/x"), ("/x/550e8400-e29b-41d4-a716-446655440000", "/x/*"), ("/p/abc123def456", "/p/*"),
    ("/report-2024.pdf", "/*"), ("/v1.2/api", "/*/api"), ("/" + "a" * 65, "/*"), ("//a///b/c/d", "/a/b/c"), ("/blog/a-post", "/blog/a-post"),
])
def test_path_buckets(spark, uri, want):
    assert value(spark, C.path_bucket(F.lit(uri))) == want


@pytest.mark.parametrize("text", ["", "abc", "é" * 10, "日本語" * 4, "a😀b😀c😀", "x" * 9 + "é"])
@pytest.mark.parametrize("n", [4, 7, 10])
def test_byte_cap_keeps_whole_characters(spark, text, n):
    assert value(spark, C.byte_cap(F.lit(text), n)) == text.encode()[:n].decode(errors="ignore")


@pytest.mark.parametrize("text", ["", "a", "foobar", "naïve 日本"])
def test_fnv(spark, text):
    h = 0xCBF29CE484222325
    for b in text.encode():
        h = ((h ^ b) * 0x100000001B3) % 2**64
    assert int(value(spark, C.fnv64(F.lit(text)))) == h


@pytest.mark.parametrize("text,want", [
    ("10.1.2.3:80", ("10.1.2.3", "10.1.2.0", 24)), ("[2001:DB8::1]:443", ("2001:db8::1", "2001:db8::", 56)), ("::ffff:1.2.3.4", ("1.2.3.4", "1.2.3.0", 24)),
    ("[::1]", (None,) * 3), (" 10.1.2.3", (None,) * 3), ("::1", ("::1", "::", 56)), ("010.1.1.1", (None,) * 3), ("", (None,) * 3), (None, (None,) * 3), ("x", (None,) * 3),
])
def test_canonical_address(text, want):
    assert addresses.canonical(text) == want


@pytest.mark.parametrize("host,want", [("A.example:443", "a.example"), ("a.example.", "a.example"), ("a:x", None), ("", None), ("[::1]", None), ("é.example", None)])
def test_host_lookup_form(spark, host, want):
    assert value(spark, addresses.normal_host(F.lit(host))) == want


def test_caps_against_a_simulation(spark):
    data = [(i, i // 60, (i * 7919) % 23, (i * 31) % 5) for i in range(300)]
    df = spark.createDataFrame(data, "seq long, w long, key long, page long")
    seen, counts, over = {}, {}, {}
    for seq, w, key, _ in data:
        if key in seen.setdefault(w, []) or len(seen[w]) < 7:
            seen[w] += [key] if key not in seen[w] else []
            counts[w, key] = counts.get((w, key), 0) + 1
        else:
            over[w] = over.get(w, 0) + 1
    kept, lost = caps.cap_keys(df, ["key"], 7)
    assert {(r.w, r.key): r.cnt for r in kept.collect()} == counts
    assert {r.w: r.overflow for r in lost.collect()} == over
    tiers = caps.cap_two_tier(df, ["key"], F.col("key") % 2 == 0, 7, 2)
    for w in range(5):
        order = list(dict.fromkeys(k for _, x, k, _ in data if x == w))
        late = [k for k in order[7:] if k % 2][:2]
        assert {r.key for r in tiers.where(f"kept and w = {w}").collect()} == {*order[:7], *late}


def test_sampling_positions(spark):
    df = spark.range(50).select(F.col("id").alias("seq"), F.lit(1).alias("w"))
    want = [(i, max(1, i // 10 + 1)) for i in range(50) if i % (i // 10 + 1 if i >= 10 else 1) == 0]
    assert [(r.seq, r.sample_rate) for r in caps.sample_under_load(df, 10, ["w"]).orderBy("seq").collect()] == want
    assert [value(spark, caps.pressure_floor(F.lit(p))) for p in (0.0, 0.7, 0.85, 1.0, 2.0)] == [1, 1, 9, 16, 16]


def test_merge_is_a_sum(spark):
    a, b = (spark.createDataFrame([(1, x)], "k long, n long") for x in (2, 5))
    assert rollups.merge_rollups(["k"], ["n"], a, b).first().n == 7


def test_markers_and_catalogue(spark):
    got = lambda m: value(spark, waf.parse_evidence(F.lit(m)))
    assert got("http=1;coraza_all=0;coraza_rule_ids=1,20,300").ids == [1, 20, 300]
    assert got("http=0;coraza_all=1;coraza_rule_ids=").all and got("http=1;coraza_all=0;coraza_rule_ids=2,1") is None
    assert got("http=1;coraza_all=0;coraza_rule_ids=01") is None and got("x") is None


def test_managed_headers_decoded_and_as_addresses(spark):
    rows = [(1, "X-Key", "s%2565cret"), (2, "x-key", "no"), (3, "X-Other", "secret"), (4, "X-IP", "1.2.3.4, 2001:DB8:0:0::1"), (5, "X-IP", "::ffff:9.9.9.9"), (6, "X-Key", "a, SECRET ,b"),
            (7, "X-Key", None), (8, "X-Key", "s&#101;cret"), (9, "X-Key", "%25252573ecret")]
    managed = spark.createDataFrame([("x-key", "Secret"), ("X-IP", "2001:db8::1, 9.9.9.9")], "name string, value string")
    got = {r.id: r.carried for r in waf.carries_managed(spark.createDataFrame(rows, "id long, name string, value string"), managed).collect()}
    assert got == {1: True, 2: False, 3: False, 4: True, 5: True, 6: True, 7: False, 8: True, 9: False}


@pytest.mark.parametrize("mode,dest,accept,want", [(None, "document", "", "P1"), ("navigate", None, "", "P1"), (None, "image", "text/html", "P1"), (None, "image", "*/*", "P3"), (None, None, None, "P3")])
def test_admission_classes(spark, mode, dest, accept, want):
    text = lambda x: F.lit(x).cast("string")
    assert value(spark, C.admission_class(F.lit("GET"), F.lit("/a.css"), text(mode), text(dest), text(accept))) == want
    assert value(spark, C.admission_class(F.lit("POST"), F.lit("/a.css"), text(mode), text(dest), text(accept))) == "P2"


def test_bounded_losses(spark):
    rows = [Row(cluster_id=1, seq=i, minute=m, lost=1) for i, m in enumerate([5, 6, 7, 8, 4, 9])]
    out = {r.minute: r.lost for r in series.bounded_losses(spark.createDataFrame(rows), 3).collect()}
    # 8 takes 5's loss, 4 is older than all that are held and joins 6, whose two move on to 9
    assert out == {7: 1, 8: 2, 9: 3}


def test_bounded_losses_keep_clusters_apart(spark):
    rows = [Row(cluster_id=c, seq=i, minute=m, lost=i + c) for c in (1, 2) for i, m in enumerate([9, 3, 3, 12, 1, 20, 15])]
    held = {1: {}, 2: {}}
    for r in sorted(rows, key=lambda r: r.seq):
        h, m, n = held[r.cluster_id], r.minute, r.lost
        if m not in h and len(h) == 2:
            low = min(h)
            n, m = n + h.pop(low), max(m, low)
        h[m] = h.get(m, 0) + n
    out = series.bounded_losses(spark.createDataFrame(rows), 2).collect()
    assert {(r.cluster_id, r.minute): r.lost for r in out} == {(c, m): n for c, h in held.items() for m, n in h.items()}


def test_latency_score_arithmetic(spark):
    rows = [("u", 1, "2024-01-01 00:00:00", 1000, 200), ("u", 2, "2024-01-01 00:00:30", 2000, 200), ("u", 3, "2024-01-01 01:00:00", 7000, 503), ("", 4, "2024-01-01 00:00:00", 5, 200)]
    df = spark.createDataFrame(rows, "dial string, t long, ts string, latency_us long, status int").withColumn("ts", F.col("ts").cast("timestamp"))
    got = {r.t: r.score for r in series.latency_scores(df).collect()}
    assert math.isclose(got[2], 0.2 * 2000 + 0.8 * 500) and got[3] == 5_000_000 and set(got) == {1, 2, 3}


def test_long_series_of_one_key_against_a_plain_fold(spark):
    n = 100_000
    us, dt = [1000 + i * 7919 % 5000 for i in range(n)], [700.0 if i % 9000 == 8999 else float(i % 40) for i in range(n)]
    at = list(itertools.accumulate(dt))
    df = spark.createDataFrame(pd.DataFrame({"dial": "u", "t": range(n), "ts": at, "latency_us": us, "status": 200})).withColumn("ts", F.timestamp_seconds("ts"))
    want = []
    for x, d in zip(us, dt):
        want.append(float(x) if not want or d > 600 else 0.2 * x + 0.8 * want[-1] * 0.5 ** (d / 30))
    got = [r.score for r in series.latency_scores(df).orderBy("t").collect()]
    assert len(got) == n and all(math.isclose(a, b) for a, b in zip(got, want))
    rates = df.select(F.col("dial").alias("machine_id"), "t", F.col("latency_us").alias("steal_permille"), F.lit(1.5).alias("dt"))
    last, gain = None, 1 - math.exp(-0.15)
    for x, r in zip(us, series.throttle_ewma(rates).orderBy("t").collect()):
        last = float(x) if last is None else last + gain * (x - last)
        assert math.isclose(r.ewma, last)


@pytest.mark.parametrize("back", [1, 3])
def test_previous_rows_across_slices_and_blocks(spark, monkeypatch, back):
    monkeypatch.setattr(series, "BLOCK", 4)
    rnd = random.Random(5)
    places = {"a": sorted(rnd.sample(range(300), 40)), "b": [7], "c": sorted(rnd.sample(range(90), 13))}
    rows = [(k, t, t * t) for k, ts in places.items() for t in ts] + [(None, 3, 9), ("a", None, 1)]
    df = spark.createDataFrame(rnd.sample(rows, len(rows)), "k string, t long, v long")
    assert {(r.k, r.t, r.n) for r in series.numbered(df, "k", "t", width=16).collect()} == {(k, t, i + 1) for k, ts in places.items() for i, t in enumerate(ts)}
    out = series.with_previous(df, "k", "t", ["v"], back=back).collect()
    assert {(r.k, r.t): r.prev and r.prev.v for r in out} == {(k, t): ts[i - back] ** 2 if i >= back else None for k, ts in places.items() for i, t in enumerate(ts)}
    out = series.with_previous(df, "k", "t", ["v"], back=back, or_first=True).collect()
    assert {(r.k, r.t): r.prev.v for r in out} == {(k, t): ts[max(0, i - back)] ** 2 for k, ts in places.items() for i, t in enumerate(ts)}
    assert len(out) == 54 and not series.with_previous(df.limit(0), "k", "t", ["v"]).collect()


def test_ranked_upstreams_across_slices_of_time(spark):
    rnd = random.Random(6)
    scores = [(f"u{rnd.randrange(3)}", i * 1700, rnd.choice([None, float(rnd.randrange(1, 100))])) for i in range(60)]
    points = [(i, i * 4000 + 1, pos, rnd.choice([f"u{pos}", f"u{pos}", None]), rnd.random() < 0.8, rnd.randrange(3)) for i in range(40) for pos in range(4)]
    at = lambda df: df.withColumn("ts", F.timestamp_seconds("ts"))
    p = at(spark.createDataFrame(points, "point int, ts long, pos int, dial string, available boolean, inflight long"))
    got = {r.point: (r.pos, r.dial, r.score and round(r.score, 6)) for r in addresses.rank_upstreams(p, at(spark.createDataFrame(scores, "dial string, ts long, score double")), 9000.0).collect()}
    want = {}
    for i, ts, pos, dial, up, n in points:
        last = max(((t, x) for d, t, x in scores if d == dial and x is not None and t <= ts), default=None)
        value = (last[1] * 0.5 ** ((ts - last[0]) / 9000) if last else 0.0) * (n + 1)
        want.setdefault(i, (None, None, None))
        if up and dial and (want[i][2] is None or value < want[i][2]):
            want[i] = (pos, dial, value)
    assert got == {i: (pos, dial, x and round(x, 6)) for i, (pos, dial, x) in want.items()}


def test_validation_keeps_the_rejected_rows(spark):
    df = spark.createDataFrame([("a" * 64, 1), ("a" * 64, 0), ("A" * 64, 1), (None, 0), ("a" * 64, None)], "health_key string, vhost_id long")
    good, bad = rollups.validated(df, rollups.health_rules())
    assert good.count() == 1 and sorted(r.reject for r in bad.collect()) == ["health_key", "health_key", "vhost", "vhost"]
    row = rollups.intake(df, {"domain_health": rollups.health_rules()}).first()
    assert (row.rows_in, row.rejects, row.by_rule) == (5, 4, {"health_key": 2, "vhost": 2})


def test_batch_round_trip_and_empty_batch(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "a"), (2, 0, "b")], "k long, n long, s string")
    assert batches.write_batch({"x": df, "y": df.limit(0)}, str(tmp_path / "b"))
    raw = sorted(r.value for r in spark.read.text(str(tmp_path / "b")).collect())
    assert raw == ['{"_type":"x","k":1,"s":"a"}', '{"_type":"x","k":2,"n":0,"s":"b"}']
    assert sorted(tuple(r) for r in batches.read_track(spark, str(tmp_path / "b"), "x", df.schema).collect()) == [(1, 0, "a"), (2, 0, "b")]
    assert not batches.write_batch({"x": df.limit(0)}, str(tmp_path / "none"))


def test_tables_of_tracks_by_day(spark, tmp_path):
    df = spark.sql("select timestamp_ntz'2024-01-01 10:00:00' as minute, 1 as n union all select timestamp_ntz'2024-01-02 00:00:00', 2")
    batches.write_tables({"x": df, "y": df.drop("minute")}, str(tmp_path / "t"))
    assert sorted(p.name for p in (tmp_path / "t/x").glob("day=*")) == ["day=2024-01-01", "day=2024-01-02"]
    assert {(str(r.day), r.n) for r in spark.read.parquet(str(tmp_path / "t/x")).collect()} == {("2024-01-01", 1), ("2024-01-02", 2)}
    assert spark.read.parquet(str(tmp_path / "t/y")).count() == 2


@pytest.mark.parametrize("fact", sorted(readers.SCHEMAS))
def test_readers_take_only_their_schema(spark, tmp_path, fact):
    spark.createDataFrame([("m", 7, "extra")], "machine_id string, seq long, unknown string").write.json(str(tmp_path / fact))
    df = readers.read_fact(spark, fact, str(tmp_path / fact), fmt="json")
    assert "unknown" not in df.columns and df.count() == 1 and df.schema == readers.read_fact(spark, fact, str(tmp_path / fact), fmt="json", stream=True).schema
    assert df.first()[0] == ("m" if "machine_id" == df.columns[0] else 7 if df.columns[0] == "seq" else None)


def test_stream_stamps_flush_minutes_and_keeps_late_rows_own(spark, tmp_path):
    from datetime import datetime, timezone

    from edgelens.streaming import tracks

    src = spark.createDataFrame([("a", "2024-01-01 00:00:10"), ("a", "2023-06-01 00:00:00")], "ip string, ts string").withColumn("ts", F.to_timestamp("ts"))
    src.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(src.schema).parquet(str(tmp_path / "in"))
    both = lambda b: {"flushed": b.groupBy("ip").count(), "own": b.groupBy(C.minute(F.col("ts")).alias("minute"), "ip").count()}
    at = datetime(2025, 5, 5, 5, 5, 55, tzinfo=timezone.utc)
    q = tracks.run_stream(stream, both, str(tmp_path / "out"), str(tmp_path / "cp"), trigger=None, stamped={"flushed"}, clock=lambda: at)
    q.awaitTermination()
    read = lambda n: {(str(r.minute), r["count"]) for r in spark.read.parquet(str(tmp_path / f"out/{n}")).collect()}
    assert read("flushed") == {("2025-05-05 05:05:00", 2)} and read("own") == {("2024-01-01 00:00:00", 1), ("2023-06-01 00:00:00", 1)}


def test_stream_equals_batch(spark, tmp_path):
    from conftest import SF

    from edgelens.streaming import tracks

    schema = spark.read.parquet(f"{SF}/events.parquet").schema
    src = str(tmp_path / "in")
    spark.read.parquet(f"{SF}/events.parquet").write.parquet(src)
    stream = spark.readStream.schema(schema).parquet(src)
    q = tracks.run_stream(
        stream, lambda b: {"caps": caps.cap_keys(b.withColumnRenamed("event_id", "seq"), ["user_id"], 10)[0]}, str(tmp_path / "out"), str(tmp_path / "cp"), trigger=None
    )
    q.awaitTermination()
    batch = spark.read.parquet(src).withColumn("w", F.lit(0)).withColumnRenamed("event_id", "seq")
    want = {(r.user_id, r.cnt) for r in caps.cap_keys(batch, ["user_id"], 10)[0].collect()}
    assert {(r.user_id, r.cnt) for r in spark.read.parquet(str(tmp_path / "out/caps")).collect()} == want
    w = tracks.windowed_counts(stream, ["event_type"])
    q = w.writeStream.format("memory").queryName("wc").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    direct = spark.read.parquet(src).groupBy(F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("m"), "event_type").count()
    assert {(r.minute, r.event_type, r.cnt) for r in spark.sql("select cast(minute as timestamp_ntz) as minute, event_type, cnt from wc").collect()} == {tuple(r) for r in direct.collect()}
