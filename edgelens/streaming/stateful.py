"""Streaming twins of the operators that remember something of each key, in the RocksDB state store.

Samples of one micro-batch are taken in order of time; the micro-batches may cut a series anywhere, and the rows are those that the
operator over the whole table gives. A sample that is older than one already taken of its key can't be put in its place
any more: it changes nothing and gives no row.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from edgelens.operators.series import BUSY, GAP_S, JIFFIES
from edgelens.runtime import importable

SLOW_STATUS = (502, 503, 504)
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def prepared(df: DataFrame) -> DataFrame:
    """df, once the session can run the operators below: their state store holds typed states and lists."""
    spark = df.sparkSession
    importable(spark)
    if spark.conf.get(PROVIDER, None) != ROCKS:
        spark.conf.set(PROVIDER, ROCKS)
    return df


def in_order(parts: Iterator[pd.DataFrame], by: list[str]) -> pd.DataFrame:
    return pd.concat(list(parts)).sort_values(by, kind="stable")


class Scores(StatefulProcessor):
    """The last score of an upstream and when it was; a timer forgets an upstream that was idle."""

    def __init__(self, alpha: float, half_life_s: float, idle_s: float, floor_us: int) -> None:
        self.alpha, self.half_life_s, self.idle_s, self.floor_us = alpha, half_life_s, idle_s, floor_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "score double, at long, t long")

    def forget_at(self, at: int) -> int:
        """The first millisecond at which a sample would begin anew."""
        return math.floor((at / 1e6 + self.idle_s) * 1000) + 1

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        before = self.last.get() if self.last.exists() else None
        score, at, last_t = before or (None, None, None)
        out = []
        for r in in_order(rows, ["t"]).itertuples(index=False):
            if last_t is not None and r.t <= last_t:
                continue
            us = float(max(r.latency_us, self.floor_us) if r.status in SLOW_STATUS else r.latency_us)
            dt = None if at is None else (r.at - at) / 1e6
            fresh = score is None or dt > self.idle_s
            score = us if fresh else self.alpha * us + (1 - self.alpha) * score * 0.5 ** (max(dt, 0.0) / self.half_life_s)
            at, last_t = int(r.at), int(r.t)
            out.append((key[0], last_t, score))
        if out:
            if before:
                self.handle.deleteTimer(self.forget_at(before[1]))
            self.last.update((score, at, last_t))
            self.handle.registerTimer(self.forget_at(at))
        yield pd.DataFrame(out, columns=["dial", "t", "score"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        yield pd.DataFrame({"dial": pd.Series(dtype=str), "t": pd.Series(dtype="int64"), "score": pd.Series(dtype=float)})


def latency_scores(
    samples: DataFrame, alpha: float = 0.2, half_life_s: float = 30.0, idle_s: float = 600.0, floor_us: int = 5_000_000, late: str = "10 minutes"
) -> DataFrame:
    """(dial, t, score) of a stream of (dial, t, ts, latency_us, status). A gap over idle_s in the samples' own
    time forgets the score, and the state of upstreams idle for so long is dropped once the watermark, late behind the newest
    sample, has passed: the state holds the upstreams of the last minutes, not all ever seen."""
    good = prepared(samples).where("dial is not null and dial <> '' and latency_us > 0").select(
        "dial", F.col("t").cast("long").alias("t"), F.col("ts").cast("timestamp").alias("ts"), F.unix_micros(F.col("ts").cast("timestamp")).alias("at"),
        F.col("latency_us").cast("long").alias("latency_us"), F.coalesce(F.col("status").cast("int"), F.lit(0)).alias("status"),
    )
    processor = Scores(alpha, half_life_s, idle_s, floor_us)
    return good.withWatermark("ts", late).groupBy("dial").transformWithStateInPandas(processor, "dial string, t long, score double", "append", "EventTime")


class Rates(StatefulProcessor):
    """A machine's last sample, and its smoothed rate."""

    def __init__(self, gap_s: float, hz: int, throttled: bool) -> None:
        self.gap_s, self.hz, self.throttled = gap_s, hz, throttled

    def init(self, handle: StatefulProcessorHandle) -> None:
        fields = ", ".join(f"{c} long" for c in JIFFIES)
        self.last = handle.getValueState("last", f"at long, {fields}, throttled long, ewma double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last = self.last.get() if self.last.exists() else None
        out = []
        for r in in_order(rows, ["at"]).to_dict("records"):
            if last is not None and r["at"] <= last[0]:
                continue
            held = None if pd.isna(r["throttled_usec"]) else int(r["throttled_usec"])
            now = [int(r[c]) for c in JIFFIES]
            permille, busy, dt, ewma = 0, None, None, None
            if last is not None:
                dt = (r["at"] - last[0]) / 1e6
                d = dict(zip(JIFFIES, (a - b for a, b in zip(now, last[1 : 1 + len(JIFFIES)]))))
                near, total = 0 < dt <= self.gap_s, sum(d.values())
                if near and total > 0:
                    permille = max(d["steal"], 0) * 1000 // total
                    busy = max(sum(d[c] for c in BUSY), 0) / self.hz / dt
                if self.throttled and near and held is not None and last[-2] is not None and held >= last[-2]:
                    permille = max(permille, math.floor(min(1.0, (held - last[-2]) / (dt * 1e6)) * 1000))
                if dt <= self.gap_s:
                    ewma = last[-1] * math.exp(-dt / 10) + (1 - math.exp(-dt / 10)) * permille
            ewma = float(permille) if ewma is None else ewma
            last = (int(r["at"]), *now, held, ewma)
            out.append((key[0], r["at"], permille, busy, ewma))
        if out:
            self.last.update(last)
        yield pd.DataFrame(out, columns=["machine_id", "at", "steal_permille", "busy", "ewma"]).astype({"busy": float})


def cpu_rates(samples: DataFrame, gap_s: float = GAP_S, hz: int = 100, throttled: bool = False) -> DataFrame:
    """(machine_id, ts, steal_permille, busy, ewma) of a stream of node samples: series.cpu_rates and, with the same gap,
    series.throttle_ewma. Of samples of one machine and time one counts. State: one sample a machine."""
    rows = prepared(samples).where("machine_id is not null and ts is not null").select("machine_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), *[F.col(c).cast("long").alias(c) for c in [*JIFFIES, "throttled_usec"]])
    out = rows.groupBy("machine_id").transformWithStateInPandas(Rates(gap_s, hz, throttled), "machine_id string, at long, steal_permille long, busy double, ewma double", "append", "None")
    return out.select("machine_id", F.timestamp_micros("at").alias("ts"), "steal_permille", "busy", "ewma")


class Sched(StatefulProcessor):
    """A ring of a machine's last cumulative histograms."""

    def __init__(self, bounds: list[float], back: int) -> None:
        self.bounds, self.back = bounds, back

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ring = handle.getListState("ring", "at long, counts array<bigint>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        ring = [(at, list(counts)) for at, counts in self.ring.get()] if self.ring.exists() else []
        out = []
        for r in in_order(rows, ["at"]).itertuples(index=False):
            if ring and r.at <= ring[-1][0]:
                continue
            ring.append((int(r.at), [int(x) for x in r.counts]))
            delta = [max(a - b, 0) for a, b in zip(ring[-1][1], ring[0][1])]
            ring = ring[-self.back :]
            out.append((key[0], r.at, self.p99(delta)))
        if out:
            self.ring.put(ring)
        yield pd.DataFrame(out, columns=["machine_id", "at", "p99"])

    def p99(self, delta: list[int]) -> float:
        """The upper bound of the bucket that holds the 99th percentile, by the least rank that reaches it."""
        rank, seen = (sum(delta) * 99 + 99) // 100, 0
        if not sum(delta):
            return 0.0
        for i, n in enumerate(delta):
            seen += n
            if seen >= rank:
                return self.bounds[i] if self.bounds[i + 1] > 1e9 else self.bounds[i + 1]
        return 0.0


def sched_p99(samples: DataFrame, bounds: list[float], counts: str = "sched_counts", back: int = 10) -> DataFrame:
    """(machine_id, ts, p99) of a stream of node samples: series.sched_p99. State: back histograms a machine."""
    rows = prepared(samples).where(F.col("machine_id").isNotNull() & F.col("ts").isNotNull() & F.col(counts).isNotNull())
    rows = rows.select("machine_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), F.col(counts).cast("array<bigint>").alias("counts"))
    out = rows.groupBy("machine_id").transformWithStateInPandas(Sched(bounds, back), "machine_id string, at long, p99 double", "append", "None")
    return out.select("machine_id", F.timestamp_micros("at").alias("ts"), "p99")


class LossBook:
    """Losses of at most `most` minutes; what is over goes from the oldest minute into a later one, and is never dropped."""

    def __init__(self, most: int, held: dict[int, int] | None = None) -> None:
        self.most, self.held = most, dict(held or {})
        self.oldest = list(self.held)
        heapq.heapify(self.oldest)

    def add(self, minute: int, lost: int) -> None:
        if minute not in self.held:
            heapq.heappush(self.oldest, minute)
        self.held[minute] = self.held.get(minute, 0) + lost
        if len(self.held) > self.most:
            first = heapq.heappop(self.oldest)
            self.held[minute if first != minute else self.oldest[0]] += self.held.pop(first)


class Losses(StatefulProcessor):
    """A cluster's lost minutes until they are delivered."""

    def __init__(self, most: int) -> None:
        self.most = most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.lost = handle.getMapState("lost", "minute long", "lost long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        before = {m[0]: n[0] for m, n in self.lost.iterator()} if self.lost.exists() else {}
        book, out = LossBook(self.most, before), []
        for r in in_order(rows, ["seq"]).itertuples(index=False):
            if r.deliver:
                out += [(key[0], m, n) for m, n in book.held.items()]
                book = LossBook(self.most)
            else:
                book.add(int(r.minute), int(r.lost))
        for m in before.keys() - book.held.keys():
            self.lost.removeKey((m,))
        for m, n in book.held.items():
            if before.get(m) != n:
                self.lost.updateValue((m,), (n,))
        yield pd.DataFrame(out, columns=["cluster_id", "minute", "lost"]).astype("int64")


def bounded_losses(entries: DataFrame, most: int = 1440) -> DataFrame:
    """(cluster_id, minute, lost) of a stream of (cluster_id, seq, minute long, lost, deliver boolean): series.bounded_losses, held in
    state until a row with deliver asks for them. Delivery and release are one commit of the stream: a run that dies
    before it delivers them again from what it held. State: `most` minutes a cluster."""
    rows = prepared(entries).select(*[F.col(c).cast("long").alias(c) for c in ("cluster_id", "seq")], F.coalesce(F.col("minute").cast("long"), F.lit(0)).alias("minute"), F.coalesce(F.col("lost").cast("long"), F.lit(0)).alias("lost"), F.coalesce("deliver", F.lit(False)).alias("deliver"))
    return rows.where("cluster_id is not null").groupBy("cluster_id").transformWithStateInPandas(Losses(most), "cluster_id long, minute long, lost long", "append", "None")
