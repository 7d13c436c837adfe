"""Streams in two micro-batches give what one batch over all rows gives."""

import math
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from edgelens.operators import series
from edgelens.streaming import stateful, tracks, windows


def drain(spark, df, name, path):
    q = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", path).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)


def halves(spark, rows, schema, order, folder):
    """A stream of two files, the earlier rows in the first; each file is a micro-batch."""
    df = spark.createDataFrame(rows, schema)
    cut = sorted(r[order] for r in rows)[len(rows) // 2]
    name = df.columns[order]
    df.where(F.col(name) < cut).coalesce(1).write.parquet(f"{folder}/in")
    df.where(F.col(name) >= cut).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    return df, spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")


def test_latency_stream_equals_batch(spark, tmp_path):
    rows = [(f"u{i % 3}" if i % 11 else "", i, datetime(2024, 1, 1) + timedelta(seconds=i * (7 if i < 60 else 300)), (i * 7919) % 9000 - 100, 503 if i % 13 == 0 else 200) for i in range(120)]
    df, stream = halves(spark, rows, "dial string, t long, ts timestamp, latency_us long, status int", 1, tmp_path)
    got = {(r.dial, r.t): r.score for r in drain(spark, stateful.latency_scores(stream), "scores", str(tmp_path / "cp")).collect()}
    want = {(r.dial, r.t): r.score for r in series.latency_scores(df).collect()}
    assert set(got) == set(want) and all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)


def uncommit(checkpoint):
    """As after a failure between the delivery of the last micro-batch and its commit."""
    folder = f"{checkpoint}/commits"
    last = max((f for f in os.listdir(folder) if f.isdigit()), key=int)
    for f in (last, f".{last}.crc"):
        if os.path.exists(f"{folder}/{f}"):
            os.remove(f"{folder}/{f}")


def pieces(spark, df, order, folder, cuts):
    """A stream of one file for each piece of df between the cuts of its order, each a micro-batch."""
    at = [None, *cuts, None]
    for i, (a, z) in enumerate(zip(at, at[1:])):
        own = df.where((F.lit(True) if a is None else F.col(order) >= a) & (F.lit(True) if z is None else F.col(order) < z))
        own.coalesce(1).write.mode("append").parquet(f"{folder}/in/p={i:03d}")
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/*")


def node_samples(spark, n=90):
    rnd = random.Random(21)
    rows, total = [], {m: [0] * 8 for m in "abc"}
    at = datetime(2024, 1, 1)
    for i in range(n):
        m = rnd.choice("abc")
        at += timedelta(seconds=rnd.choice([0.5, 1, 2, 40]))
        total[m] = [x + rnd.randrange(60) for x in total[m]]
        now = [0] * 8 if rnd.random() < 0.05 else [x if rnd.random() < 0.95 else 0 for x in total[m]]
        rows.append((m, at, *now, rnd.choice([None, i * 300_000, i * 300_000]), [i * 3, i * 5 + rnd.randrange(4), i]))
    names = ", ".join(f"{c} long" for c in series.JIFFIES)
    return spark.createDataFrame(rows, f"machine_id string, ts timestamp, {names}, throttled_usec long, sched_counts array<bigint>")


@pytest.mark.parametrize("seed", [1, 2])
def test_rates_and_percentiles_of_any_split_equal_batch(spark, tmp_path, seed):
    df = node_samples(spark)
    times = sorted(r.ts for r in df.select("ts").collect())
    cuts = sorted(random.Random(seed).sample(times[1:], 4))
    stream = pieces(spark, df, "ts", tmp_path, cuts)
    ordered = series.with_order(df)
    got = {(r.machine_id, r.ts): r for r in drain(spark, stateful.cpu_rates(stream, throttled=True), f"rates{seed}", f"{tmp_path}/cp1").collect()}
    want = series.cpu_rates(ordered, throttled=True, width=1 << 30)
    assert len(got) == df.count()
    for r in want.collect():
        own = got[(r.machine_id, r.ts)]
        assert own.steal_permille == r.steal_permille and (own.busy is None) == (r.busy is None) and math.isclose(own.busy or 0, r.busy or 0)
    smooth = {(r.machine_id, r.t): r.ewma for r in series.throttle_ewma(want).collect()}
    for r in ordered.collect():
        assert math.isclose(got[(r.machine_id, r.ts)].ewma, smooth[(r.machine_id, r.t)], abs_tol=1e-9)
    bounds = [0.0, 0.001, 0.02, float("inf")]
    got = {(r.machine_id, r.ts): r.p99 for r in drain(spark, stateful.sched_p99(stream, bounds), f"p99s{seed}", f"{tmp_path}/cp2").collect()}
    counted = ordered.withColumn("counts", F.col("sched_counts"))
    assert got == {(r.machine_id, r.ts): r.p99 for r in series.sched_p99(counted, bounds).collect()}


def test_idle_upstreams_leave_the_state(spark, tmp_path):
    at = lambda s: datetime(2024, 1, 1) + timedelta(seconds=s)
    rows = [(f"u{i}", i, at(i), 1000 + i, 200) for i in range(50)] + [("live", 100 + i, at(60 + 300 * i), 2000, 200) for i in range(12)] + [("u3", 500, at(3700), 9000, 200)]
    df = spark.createDataFrame(rows, "dial string, t long, ts timestamp, latency_us long, status int")
    stream = pieces(spark, df, "ts", tmp_path, [at(55), *[at(61 + 300 * i) for i in range(12)]])
    q = stateful.latency_scores(stream).writeStream.format("memory").queryName("idle").outputMode("append").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination()
    held = [p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators]
    assert max(held) >= 50 and held[-1] < 10  # the states and timers of idle upstreams are gone
    got = {(r.dial, r.t): r.score for r in spark.table("idle").collect()}
    want = {(r.dial, r.t): r.score for r in series.latency_scores(df).collect()}
    assert set(got) == set(want) and all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want) and got[("u3", 500)] == 9000


def plain_losses(rows, most):
    """The minutes of one cluster in order; at the bound the oldest joins the new one, or a new oldest the one before."""
    held = {}
    for minute, lost in rows:
        held[minute] = held.get(minute, 0) + lost
        if len(held) > most:
            first = min(held)
            n = held.pop(first)
            to = minute if minute != first else min(held)
            held[to] += n
    return held


def test_losses_are_held_over_a_restart_until_delivered(spark, tmp_path):
    rnd = random.Random(8)
    rows = [(rnd.randrange(3), i if i < 150 else i + 1, rnd.randrange(60), rnd.randrange(1, 9), False) for i in range(300)]
    rows = [(c, s, m, n, d) for c, s, m, n, d in rows] + [(c, 150, None, None, True) for c in range(3)] + [(c, 1000, None, None, True) for c in range(3)]
    df = spark.createDataFrame(sorted(rows, key=lambda r: (r[1], r[4])), "cluster_id long, seq long, minute long, lost long, deliver boolean")
    schema = df.schema
    stream = lambda: stateful.bounded_losses(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*"), 10)
    got = []
    for i, (a, z) in enumerate([(0, 40), (40, 170), (170, 171), (171, 2000)]):  # the query ends and starts again between the pieces
        df.where((F.col("seq") >= a) & (F.col("seq") < z)).coalesce(1).write.parquet(f"{tmp_path}/in/p={i}")
        q = stream().writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{tmp_path}/cp").option("path", f"{tmp_path}/out").trigger(availableNow=True).start()
        q.awaitTermination()
        got.append(sorted(map(tuple, spark.read.schema("cluster_id long, minute long, lost long").parquet(f"{tmp_path}/out").collect())))
    entries = df.where("not deliver").select("cluster_id", "seq", "minute", "lost")
    halves = [series.bounded_losses(entries.where(c), 10) for c in ("seq < 150", "seq >= 150")]
    want = [sorted(map(tuple, h.select("cluster_id", "minute", "lost").collect())) for h in halves]
    for h, half in zip(want, ("s < 150", "s >= 150")):
        for c in range(3):
            own = [(m, n) for cl, s, m, n, d in rows if cl == c and not d and (s < 150) == (half == "s < 150")]
            assert {m: n for cl, m, n in h if cl == c} == plain_losses(own, 10)
    assert got[0] == [] and got[1] == want[0] == got[2] and got[3] == sorted(want[0] + want[1])
    assert sum(n for _, _, n in got[3]) == sum(r[3] for r in rows if not r[4])


def test_late_rows_are_counted_whatever_their_age(spark, tmp_path):
    rnd = random.Random(4)
    at = datetime(2024, 1, 1)
    batches = [[(at + timedelta(minutes=20 * b + rnd.randrange(25), seconds=rnd.randrange(60)), rnd.choice("xy")) for _ in range(60)] for b in range(5)]
    batches[3] += [(at + timedelta(seconds=i), "x") for i in range(7)] + [(None, "x")]  # hours old, and without time
    batches[4] += [(at - timedelta(days=400), "y")]
    schema = "ts timestamp, k string"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/p={i}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    layout = windows.schema_of(stream, ["k"])
    out = f"{tmp_path}/out"
    windows.run_windows(stream, ["k"], out, f"{tmp_path}/cp", trigger=None).awaitTermination()
    key = lambda df: sorted(map(tuple, df.select("minute", "k", "cnt").collect()), key=repr)
    all_rows = spark.createDataFrame([r for b in batches for r in b], schema)
    want = key(all_rows.groupBy(F.date_trunc("minute", "ts").alias("minute"), "k").agg(F.count("*").alias("cnt")))
    assert key(windows.counts(spark, out, ["k"], layout)) == want
    late = spark.read.schema(layout).parquet(f"{out}/late")
    assert late.agg(F.sum("cnt")).first()[0] >= 9
    final = spark.read.schema(layout).parquet(f"{out}/final")
    assert final.groupBy("minute", "k").count().where("count > 1").count() == 0 and final.count() > 50
    uncommit(f"{tmp_path}/cp")  # the last micro-batch comes again and replaces itself
    windows.run_windows(stream, ["k"], out, f"{tmp_path}/cp", trigger=None).awaitTermination()
    assert key(windows.counts(spark, out, ["k"], layout)) == want


def test_a_repeated_micro_batch_replaces_its_delivery(spark, tmp_path):
    df = spark.createDataFrame([(i, f"k{i % 3}") for i in range(30)], "seq long, k string")
    stream = pieces(spark, df, "seq", tmp_path, [10, 20])
    made = lambda batch: {"counts": batch.groupBy("w", "k").agg(F.count("*").alias("cnt"))}
    run = lambda at: tracks.run_stream(stream, made, f"{tmp_path}/out", f"{tmp_path}/cp", None, ("counts",), lambda: datetime(2024, 1, 1, 0, at)).awaitTermination()
    read = lambda: sorted((r.w, r.k, r.cnt, r.minute.minute) for r in spark.read.parquet(f"{tmp_path}/out/counts").collect())
    run(5)
    first = read()
    assert sum(r[2] for r in first) == 30 and len({r[0] for r in first}) == 3
    uncommit(f"{tmp_path}/cp")
    run(9)
    assert [r[:3] for r in read()] == [r[:3] for r in first] and [r[3] for r in read()] == [9 if r[0] == 2 else 5 for r in first]
