"""What the readers return goes through the operators, from tables and from streams, with the same result."""

import json
import random
from datetime import datetime, timedelta

import pytest
from conftest import SF
from pyspark.sql import functions as F
from test_stateful import drain

from edgelens.functions import headers as H
from edgelens.operators import exemptions, normalize, rollups, series, waf
from edgelens.sources import readers
from edgelens.sources.facts import views


def by_seq(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


FACTS = ["seq", "status", "origin", "disposition", "vhost_id", "front_proxy", "hash_ip", "ua", "monitor", "admission_class", "bytes_in", "bytes_out", "failure_reason", "path_bucket"]


def test_requests_from_files_in_batch_and_stream(spark, tmp_path):
    own = [f.split()[0] for f in readers.SCHEMAS["requests"].split(",\n")[0].split(", ")]
    assert own[:3] == ["seq", "end_ts", "duration_us"]
    declared = views(spark, SF, "requests")[0]
    schema = readers.read_requests(spark, SF).schema
    there = [f.name for f in schema if f.name in declared.columns]
    declared.select(*[F.col(c).cast(schema[c].dataType) for c in there]).repartition(4).write.json(f"{tmp_path}/in")
    table = normalize.normalize_requests(readers.read_requests(spark, f"{tmp_path}/in", fmt="json"))
    plain = declared.withColumns({"failure_evidence": F.lit(None).cast(schema["failure_evidence"].dataType), "connections": F.lit(None).cast("long")})
    want = by_seq(normalize.normalize_requests(plain), *FACTS)
    assert by_seq(table, *FACTS) == want and len(want) == 1000
    stream = normalize.normalize_requests(readers.read_requests(spark, f"{tmp_path}/in", fmt="json", stream=True))
    assert by_seq(drain(spark, stream.select(*FACTS), "facts", f"{tmp_path}/cp"), *FACTS) == want
    assert rollups.request_counters(normalize.attributed(table)).count() > 0


def plain_sizes(fields):
    return sum(len(n.encode()) + len(v.encode()) + 4 for n, vs in (fields or {}).items() for v in vs or [] if v is not None)


def test_header_fields(spark):
    rows = [
        ({"X-Forwarded-For": ["1.1.1.1, 2.2.2.2", "3.3.3.3"], "ACCEPT": ["é"]}, "1.1.1.1, 2.2.2.2"), ({"x-forwarded-for": []}, None), ({"x-forwarded-for": None}, None), ({}, None), (None, None),
        ({"x-forwarded-for": [None, "b"], "n" * 300: ["v" * 300, ""]}, "b"), ({"xforwardedfor": ["a"]}, None),
    ]
    df = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(rows)], "i long, h map<string,array<string>>").withColumn("f", H.folded(F.col("h")))
    got = {r.i: r for r in df.select("i", H.first_of(F.col("f"), "X-FORWARDED-for").alias("v"), H.wire_size(F.col("f")).alias("n")).collect()}
    for i, (h, first) in enumerate(rows):
        assert got[i].v == first and got[i].n == plain_sizes(h)


def test_absent_columns_have_defaults(spark, tmp_path):
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "a.json").write_text(json.dumps({"seq": 1, "method": "GET", "uri": "/x.css?q", "remote_addr": "1.2.3.4:5", "end_ts": "2024-01-01T00:00:00Z", "vhost_var": "7"}))
    r = normalize.normalize_requests(readers.read_requests(spark, f"{tmp_path}/r", fmt="json")).first()
    assert (r.status, r.origin, r.disposition, r.front_proxy, r.hash_ip, r.monitor, r.admission_class, r.bytes_out, r.vhost_id) == (200, "cluster", "served", "", "1.2.3.4:5", False, "P3", 0, 7)


AUDIT = [
    {"tx_id": "a", "ts_ns": 1_700_000_000_999_999_999, "server_id": "h" * 300, "client_ip": "1.2.3.4", "interrupted": True, "method": "G" * 40, "uri": "/é" * 1100, "rulesets": ["core", "EVIDENCE/2"],
     "headers": {"x-vhost-ID": ["no", "17"], "X-Evidence": ["http=0;coraza_all=0;coraza_rule_ids=942100,942200"]},
     "messages": [{"id": 942100, "severity": 2, "msg": "m" * 300, "data": "d" * 600, "tags": ["t"]}, None, {"id": 942300, "severity": 9}, {"id": -5, "severity": 0, "msg": "x"}]},
    {"tx_id": "b", "ts_ns": -3, "rulesets": ["EVIDENCE/2"], "headers": {"X-Evidence": ["http=1;coraza_all=0;coraza_rule_ids=942100,942999"]}, "messages": [{"id": 942100, "severity": 2}]},
    {"tx_id": "c", "rulesets": ["core"], "messages": [{"id": 1, "severity": 1}]}, {"tx_id": "d", "messages": []}, {"tx_id": "e"},
]


@pytest.mark.parametrize("limit", [waf.CATALOG_RULES, 1])
def test_audit_from_files_in_batch_and_stream(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(waf, "CATALOG_RULES", limit)
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.json").write_text("\n".join(map(json.dumps, AUDIT)))
    catalog = spark.createDataFrame([(942100,), (942200,), (942300,), (None,)], "rule_id long")
    cols = ["tx_id", "rule_id", "exempt", "severity_label", "vhost_id", "ts_s", "was_blocked"]
    found = exemptions.exempt_findings(waf.explode_findings(readers.read_audit(spark, f"{tmp_path}/a", fmt="json")), catalog)
    want = [("a", 0, False, "EMERGENCY", 17, 1700000000, True), ("a", 942100, True, "CRITICAL", 17, 1700000000, True), ("a", 942300, False, "UNKNOWN", 17, 1700000000, True),
            ("b", 942100, False, "CRITICAL", 0, 0, False), ("c", 1, False, "ALERT", 0, 0, False)]
    assert by_seq(found, *cols) == sorted(want, key=repr)
    r = found.where("rule_id = 942100 and tx_id = 'a'").first()
    assert (len(r.msg), len(r.match_data), len(r.host), len(r.method), len(r.uri.encode()), r.tags) == (256, 512, 255, 32, 2047, ["t"])
    if limit > 1:
        stream = exemptions.exempt_findings(waf.explode_findings(readers.read_audit(spark, f"{tmp_path}/a", fmt="json", stream=True)), catalog)
        assert by_seq(drain(spark, stream.select(*cols), "found", f"{tmp_path}/cp"), *cols) == sorted(want, key=repr)


def test_node_samples_from_files(spark, tmp_path):
    at = lambda s: (datetime(2024, 1, 1) + timedelta(seconds=s)).isoformat() + "Z"
    base = {"machine_id": "m", "user": 1000, "nice": 0, "system": 100, "idle": 5000, "iowait": 10, "irq": 1, "softirq": 2, "steal": 50, "throttled_usec": 0}
    lines = [base | {"ts": at(0)}, base | {"ts": at(2), "user": 1200, "steal": 40, "idle": 5010}, base | {"ts": at(3), "user": 1200, "steal": 60, "idle": 5090}, base | {"ts": at(3.5), "user": 0, "idle": 0},
             base | {"ts": at(60)}, base | {"ts": at(61), "softirq": 52, "steal": 100, "throttled_usec": 900_000}]
    (tmp_path / "n").mkdir()
    (tmp_path / "n" / "x.json").write_text("\n".join(map(json.dumps, reversed(lines))))
    samples = series.with_order(readers.read_node_samples(spark, f"{tmp_path}/n", fmt="json"))
    got = [(r.steal_permille, r.busy) for r in series.cpu_rates(samples, width=series.WIDTH * 1000).orderBy("t").collect()]
    # steal fell from 50 to 40: its part is 0, the others count; then all fell together; then a gap
    assert got == [(0, None), (0, 1.0), (200, 0.0), (0, None), (0, None), (500, 0.5)]
    held = series.cpu_rates(samples, throttled=True, width=series.WIDTH * 1000).orderBy("t").collect()
    assert [r.steal_permille for r in held] == [0, 0, 200, 0, 0, 900]


def plain_marker(text):
    """Read by splitting, apart from the operator's pattern."""
    fields = (text or "").split(";")
    if len(fields) != 3 or [f.partition("=")[0] for f in fields] != list(waf.MARKER_FIELDS) or any("=" not in f for f in fields):
        return None
    http, all_, ids = (f.partition("=")[2] for f in fields)
    if http not in ("0", "1") or all_ not in ("0", "1"):
        return None
    ids = ids.split(",") if ids else []
    if any(not (i.isascii() and i.isdigit()) or i[0] == "0" for i in ids) or any(int(a) >= int(b) for a, b in zip(ids, ids[1:])):
        return None
    return http == "1", all_ == "1", [int(i) for i in ids]


def test_random_markers(spark):
    rnd = random.Random(12)
    texts = [None, "", ";;", "http=1;coraza_all=0;coraza_rule_ids=1\n"]
    for _ in range(2000):
        ids = ",".join(rnd.choice([str(rnd.randrange(1, 60)), str(rnd.randrange(1, 60)), "0", "07", "x", ""]) if rnd.random() < 0.2 else str(i * 7 + rnd.randrange(1, 8)) for i in range(rnd.randrange(4)))
        t = f"http={rnd.choice('01')};coraza_all={rnd.choice('01')};coraza_rule_ids={ids}"
        if rnd.random() < 0.2:
            at = rnd.randrange(len(t))
            t = t[:at] + rnd.choice(["", ";", "=", " ", "2", ","]) + t[at + 1 :]
        texts.append(t)
    df = spark.createDataFrame(list(enumerate(texts)), "i long, m string")
    got = {r.i: r.e and (r.e.http, r.e.all, r.e.ids) for r in df.select("i", waf.parse_evidence(F.col("m")).alias("e")).collect()}
    want = {i: plain_marker(t) for i, t in enumerate(texts)}
    assert got == want and 800 < sum(w is not None for w in want.values()) < 1900
