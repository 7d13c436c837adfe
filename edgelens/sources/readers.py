"""Readers of the raw facts with explicit schemas, as tables or as streams of Parquet or JSON files.

Columns that a file lacks are null; columns that it has besides are left out. Nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

HEADERS = "map<string,array<string>>"
#: The columns of each fact, as their producers write them.
SCHEMAS = {
    "requests": f"""seq long, end_ts timestamp, duration_us long, vhost_var string, host string, method string, uri string, path string, query string,
        proto_major int, proto_minor int, remote_addr string, headers {HEADERS}, content_length long, wrote boolean, written_status int, hijacked boolean,
        body_bytes_out long, resp_headers {HEADERS}, err_is_handler boolean, err_status int, err_message string, err_kind string,
        failure_evidence array<struct<message:string,reason:string,connections:bigint>>, connections long, block_reason_var string, upstream_addr string,
        upstream_hostport string, upstream_latency_us long, latency_before_us long, upstream_status int, country string, asn string, request_uuid string,
        challenge_outcome string, challenge_reason string, challenge_source string, verify_outcome string, health_key string, exempt boolean,
        retried_response boolean, cancelled boolean,
        machine_id string, cluster_id long""",
    "connections": "seq long, ts timestamp, cluster_id long, remote_addr string, sni string, ja3 string, ja4 string",
    "l4_closes": "seq long, ts timestamp, cluster_id long, remote_addr string, reason string",
    "waf_audit": f"""tx_id string, ts_ns long, server_id string, client_ip string, interrupted boolean, method string, uri string, headers {HEADERS},
        rulesets array<string>, messages array<struct<id:int,severity:int,msg:string,data:string,tags:array<string>>>""",
    "node_samples": """machine_id string, cluster_id long, ts timestamp, user long, nice long, system long, idle long, iowait long, irq long, softirq long,
        steal long, throttled_usec long, uptime_s double, vcpus double, sched_counts array<bigint>, sched_bounds array<double>, inflight long,
        completions long, latency_ns long, hard_cap_hit boolean, waf_skipped_detect long, waf_skipped_static long, waf_would_skip long,
        shed_p0 long, shed_p1 long, shed_p2 long, shed_p3 long, would_shed long, gomaxprocs int""",
}


def read_fact(spark: SparkSession, fact: str, path: str, fmt: str = "parquet", stream: bool = False) -> DataFrame:
    """One of SCHEMAS from files of a folder; with stream, new files as they come."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(SCHEMAS[fact]).format(fmt).load(path)


def read_requests(spark: SparkSession, path: str, **how) -> DataFrame:
    return read_fact(spark, "requests", path, **how)


def read_connections(spark: SparkSession, path: str, **how) -> DataFrame:
    return read_fact(spark, "connections", path, **how)


def read_audit(spark: SparkSession, path: str, **how) -> DataFrame:
    return read_fact(spark, "waf_audit", path, **how)


def read_node_samples(spark: SparkSession, path: str, **how) -> DataFrame:
    return read_fact(spark, "node_samples", path, **how)
