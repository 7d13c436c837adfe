"""Requests to facts: every derived column in one projection, then the row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from edgelens.functions import columns as C, headers as H
from edgelens.operators import addresses, exemptions

#: What stands for columns that a request's producer left out.
ABSENT = {
    "wrote": False, "hijacked": False, "err_is_handler": False, "retried_response": False, "cancelled": False, "exempt": False, "err_status": 0, "err_message": "", "err_kind": "",
    "block_reason_var": "", "challenge_outcome": "", "challenge_reason": "", "verify_outcome": "", "content_length": 0, "body_bytes_out": 0,
}
MONITOR_HEADER = "x-monitor"


def with_fields(requests: DataFrame, monitor: str = MONITOR_HEADER) -> DataFrame:
    """requests, as sources.readers declares them, with the first values of the header fields of H.FIELDS, the bytes of
    all header lines of both directions, whether the monitor field is `true`, and defaults for what is absent."""
    absent = {n: F.coalesce(n, F.lit(v)) if n in requests.columns else F.lit(v) for n, v in ABSENT.items()}
    rows = requests.withColumns({**absent, "__in": H.folded(F.col("headers")), "__out": H.folded(F.col("resp_headers"))})
    fields = {n: H.first_of(F.col("__in"), name) for n, name in H.FIELDS.items()}
    fields["ua"] = F.coalesce(fields["ua"], F.lit(""))
    lines = {"lines_in": H.wire_size(F.col("__in")), "lines_out": H.wire_size(F.col("__out"))}
    marked = F.coalesce(H.first_of(F.col("__in"), monitor) == "true", F.lit(False))
    return rows.withColumns({**fields, **lines, "monitor": marked}).drop("__in", "__out")


def normalize_requests(requests: DataFrame, monitor: str = MONITOR_HEADER) -> DataFrame:
    """Facts of requests, as sources.readers declares them, in batch or stream: the derived columns of the data model
    (minute, status, origin, disposition, ...) beside theirs. Of a header field the first value counts, in any case of
    its name; every value of every field counts in the bytes."""
    c = F.col
    step = with_fields(requests, monitor).withColumns({
        "minute": C.minute(c("end_ts")), "method_norm": C.method(c("method")),
        "status": C.final_status(c("wrote"), c("written_status"), c("err_is_handler"), c("err_status")),
        "block_reason": C.block_reason(c("block_reason_var"), c("err_is_handler"), c("err_message"), c("err_status")),
        "country_norm": C.country(c("country")), "asn_norm": C.u32(c("asn"), 0), "vhost_id": C.u32(c("vhost_var")),
        "lat_bucket": C.latency_bucket(c("duration_us")), "http_version": C.http_version(c("proto_major"), c("proto_minor")),
        "path": C.byte_cap(C.bare_path(c("uri")), 1024), "path_bucket": C.path_bucket(c("uri")),
        "front_proxy": C.front_proxy([c("cdn_ip"), c("cdn_ray")], [c("xff"), c("real_ip")]), "hash_ip": C.hash_ip(c("xff"), c("remote_addr")),
        "challenge": C.challenge_outcome(c("challenge_outcome"), c("challenge_reason")), "source": C.challenge_source(c("challenge_source")),
        "bytes_in": C.bytes_in(c("method"), c("uri"), c("proto_major"), c("proto_minor"), c("lines_in"), c("content_length")),
        "bytes_out": C.bytes_out(c("wrote"), c("hijacked"), c("written_status"), c("lines_out"), c("body_bytes_out")),
    })
    step = step.withColumns({
        "origin": C.origin(c("block_reason"), c("err_kind"), c("upstream_addr"), c("err_is_handler"), c("retried_response")),
        "disposition": C.disposition(c("block_reason"), c("challenge_outcome")), "status_bucket": C.status_bucket(c("status")),
        "is_static": c("method").isin("GET", "HEAD") & C.is_static(c("path")),
        "admission_class": C.admission_class(c("method"), c("path"), c("fetch_mode"), c("fetch_dest"), c("accept")),
    })
    staged = C.staged_reason(c("failure_evidence"), c("err_message"), c("connections"))
    return step.withColumn("failure_reason", C.failure_reason(c("err_kind"), c("origin"), c("status"), c("wrote"), c("cancelled"), staged))


def observed(facts: DataFrame) -> DataFrame:
    """Without monitor traffic; challenge counts read the frame before this filter."""
    return facts.where(~F.col("monitor"))


def attributed(facts: DataFrame) -> DataFrame:
    """Rows with a vhost, as counters, uniques and health need."""
    return observed(facts).where("vhost_id is not null")


def request_events(facts: DataFrame, v2: bool = True) -> DataFrame:
    """The raw event track with its wire names. Mode v2 adds seven columns, the last of them null without a
    failure; defense_exempt is null unless true. Unsampled: caps.sample_* set sample_rate."""
    c = F.col
    # addresses are told apart before rows are dropped: that reads their column alone, and derives no fact twice
    rows = exemptions.with_forwarded_ip(event_rows(addresses.with_client_ip(facts), v2))
    out = [
        F.date_trunc("second", "end_ts").cast("timestamp_ntz").alias("ts"), "cluster_id", "vhost_id", "client_ip", "forwarded_ip", "front_proxy", c("method_norm").alias("method"),
        "path", "path_bucket", "status", "http_version", C.byte_cap(c("ua"), 512).alias("ua"), "origin", "bytes_in", "bytes_out", "duration_us",
        F.lit(1).cast("long").alias("sample_rate"), F.when(c("exempt"), True).alias("defense_exempt"),
    ]
    if v2:
        out += [
            F.unix_millis(c("end_ts").cast("timestamp")).alias("ts_ms"), C.byte_cap(c("machine_id"), 64).alias("machine_id"), c("seq").alias("machine_seq"), "disposition",
            c("event_host").alias("host"), c("request_uuid").alias("request_id"), F.nullif("failure_reason", F.lit("")).alias("upstream_failure_reason"),
        ]
    return rows.select(*out)


def event_rows(facts: DataFrame, v2: bool = True) -> DataFrame:
    """Rows of the raw event track. Mode v2 keeps rows without a vhost only where a challenge was seen, as
    vhost 0 with their host; legacy mode keeps rows that were not blocked."""
    rows = observed(facts)
    if not v2:
        return rows.where("vhost_id is not null and block_reason = ''")
    rows = rows.where("vhost_id is not null or challenge_outcome <> ''")
    host = F.lower(F.regexp_replace("host", ":[0-9]*$", ""))
    return rows.withColumn("event_host", F.when(F.col("vhost_id").isNull(), C.byte_cap(host, 255)).otherwise("")).withColumn("vhost_id", F.coalesce("vhost_id", F.lit(0)))
