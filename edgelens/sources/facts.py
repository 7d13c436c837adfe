"""The fact views of the telemetry queries over the driver's tables.

Each view is one SELECT in SQL that Spark and DuckDB read alike, over `ev`: event_id as seq, ts, user_id,
event_type, value and k (the number in props). For Spark the header fields of requests are then put into maps, so that
facts are derived from the columns that sources.readers declares; the queries' SQL reads them as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from edgelens.runtime import spread, table

# as a generator the JSON is read once a row: conditions on k are not pushed below it, and a dozen copies of it with them
EV_SPARK = "select event_id as seq, ts, user_id, event_type, value, cast(number as int) as k from events lateral view json_tuple(props, 'k') x as number"
EV_DUCKDB = "select event_id as seq, ts, user_id, event_type, value, cast(json_extract_string(props, '$.k') as int) as k from events"

REQUESTS = """
select seq, ts as end_ts, user_id, k, cast(floor(value * 10000 + 0.5) as bigint) as duration_us,
  case when k % 10 = 9 then null when k % 10 = 8 then 'none' else cast(user_id % 24 * 4 as string) end as vhost_var,
  concat('H', cast(user_id % 20 as string), '.Example.COM', case k % 5 when 0 then ':8443' when 1 then '.' when 2 then ':x' else '' end) as host,
  case event_type when 'view' then 'GET' when 'purchase' then 'POST' when 'signup' then 'put' when 'click' then 'HEAD' else 'DELETE' end as method,
  case k % 8 when 0 then concat('/', cast(user_id as string)) when 1 then '/assets/App.JS' when 2 then '/.well-known/acme-challenge/t'
    when 3 then concat('/Shop/item-', cast(seq as string)) when 4 then '/a//b/c/d?x=1' when 5 then '/img/logo.png#top'
    when 6 then '/v1.2/report-2024.pdf' else '/' end as uri,
  1 + k % 3 as proto_major, case when k % 3 = 0 and k % 2 = 0 then 1 else 0 end as proto_minor,
  concat('10.', cast(user_id % 3 as string), '.', cast(k % 7 as string), '.', cast(user_id % 250 as string), ':', cast(1024 + k as string)) as remote_addr,
  case when k % 6 = 0 then concat('198.51.100.7, 203.0.113.', cast(k as string)) when k % 6 = 1 then 'junk' else null end as xff,
  case when k % 9 = 0 then '2001:DB8:0:0::0001' else null end as cdn_ip,
  concat(event_type, '/', cast(k as string)) as ua,
  case when k % 12 = 5 then 'navigate' else null end as fetch_mode, case when k % 12 = 7 then 'document' when k % 12 = 8 then 'image' else null end as fetch_dest, case when k % 4 = 1 then 'text/html,*/*' else 'application/json' end as accept,
  case when k % 4 = 0 then cast(k * 10 as bigint) when k % 4 = 1 then 0 else -1 end as content_length,
  k % 11 <> 0 as wrote, case when k % 7 = 0 then 500 + k % 5 when k % 7 = 1 then 404 when k % 7 = 2 then 301 else 200 end as written_status,
  k = 42 as hijacked, cast(floor(value * 100 + 0.5) as bigint) as body_bytes_out,
  case when k % 29 = 6 then concat('ray', cast(k as string)) else null end as cdn_ray, case when k % 17 = 2 then '192.0.2.8' else null end as real_ip,
  case when k % 5 = 3 then concat('sid=', cast(user_id as string)) else null end as cookie, case when k % 4 = 2 then 'https://é.example/' else null end as referer,
  case when k = 50 then 'true' when k % 9 = 4 then 'True' else null end as monitor_field,
  case when k % 6 = 5 then 'gzip' else null end as content_encoding, case when k % 10 = 1 then concat('a=', cast(k as string)) else null end as set_cookie,
  case when k % 7 = 2 then null when k % 3 = 0 then 'application/json' else 'text/html; charset=utf-8' end as content_type,
  case when k % 7 = 2 then concat('https://shop.example.com/', cast(user_id as string)) else null end as location,
  k % 13 = 0 or k % 11 = 0 as err_is_handler, case when k % 26 = 0 then 429 when k % 13 = 0 or k % 11 = 0 then 502 else 0 end as err_status,
  case when k % 39 = 0 then 'stop: interruption triggered' when k % 13 = 0 then 'dial failed' when k in (88, 99) and user_id % 3 = 0 then 'odd' when k = 99 and user_id % 3 = 1 then 'dial failed' when k = 99 then 'x: failed' else '' end as err_message,
  case when k = 22 then 'no_upstreams' when k % 11 = 0 and k % 13 = 0 then 'dns_timeout' when k = 11 then 'certificate' when k = 33 then 'dns' when k = 44 then 'reset'
    when k = 66 then 'header_timeout' when k = 88 then 'write' when k % 13 = 0 then 'eof' else '' end as err_kind,
  case when k = 57 then 'geo' else '' end as block_reason_var,
  case when k % 5 = 0 then null else concat('10.1.0.', cast(user_id % 4 as string)) end as upstream_addr,
  cast(floor(value * 1000 + 0.5) as bigint) as upstream_latency_us, case when k % 17 = 3 then cast(floor(value * 1000 + 0.5) as bigint) else null end as latency_before_us,
  case when k % 7 = 0 then 500 + k % 5 when k % 7 = 1 then 404 when k % 7 = 3 then 101 else 200 end as upstream_status,
  case k % 6 when 0 then 'de' when 1 then 'US' when 2 then 'X1' when 3 then 'usa' else null end as country,
  case k % 5 when 0 then cast(64500 + k as string) when 1 then '-1' when 2 then '4294967296' when 3 then 'abc' else null end as asn,
  case k % 14 when 0 then 'issued' when 1 then 'failed' when 2 then 'passed' when 3 then 'passed_recently' when 4 then 'passed_fallback' else '' end as challenge_outcome,
  case when k % 14 = 0 and k % 4 = 0 then 'document' when k % 14 = 1 and k % 3 = 0 then 'api' when k % 14 = 1 then 'token'
    when k % 14 = 3 and k % 2 = 1 then 'fallback' when k % 14 = 2 then 'odd' else '' end as challenge_reason,
  case k % 5 when 0 then 'automatic' when 1 then 'staff' when 2 then '' when 3 then 'strange' else null end as challenge_source,
  case when k % 25 = 4 then 'passed' when k % 25 = 5 then 'failed' else '' end as verify_outcome,
  case when k % 3 = 0 then concat(md5(cast(user_id % 6 as string)), md5('x')) when k % 3 = 1 then 'short' else '' end as health_key,
  k % 17 = 0 as exempt, concat('m', cast(user_id % 3 as string)) as machine_id, cast(1 as bigint) as cluster_id,
  k = 99 and user_id % 5 = 0 as cancelled, k % 11 = 0 and k % 2 = 1 and user_id % 7 = 0 as retried_response, md5(cast(seq as string)) as request_uuid
from ev
"""

CONNECTIONS = """
select seq, ts, cast(1 as bigint) as cluster_id,
  case when k % 19 = 0 then concat('[2001:db8:0:', cast(user_id % 5 as string), '::', cast(k as string), ']:443') when k % 23 = 0 then 'not-an-ip'
    when k % 29 = 0 then concat('::ffff:10.9.8.', cast(user_id as string))
    else concat('10.', cast(user_id % 3 as string), '.', cast(k % 7 as string), '.', cast(user_id % 250 as string), ':5000') end as remote_addr,
  case when k % 31 = 0 then '' else concat(event_type, cast(k % 40 as string), '.example') end as sni,
  substring(md5(event_type), 1, 8) as ja3, case when k % 37 = 0 then '' else substring(md5(cast(k % 6 as string)), 1, 10) end as ja4,
  case k % 7 when 0 then 'ip' when 1 then 'sni' when 2 then 'ja3' when 3 then 'ja4' when 4 then 'abuseipdb' else 'other' end as reason
from ev
"""

NODE_SAMPLES = """
select concat('m', cast(user_id % 4 as string)) as machine_id, cast(1 as bigint) as cluster_id, seq as t, ts, k,
  cast(case when k = 77 then 0 else seq * 60 + k end as bigint) as user, cast(seq * 4 as bigint) as nice, cast(seq * 20 + k % 10 as bigint) as system,
  cast(case when k % 50 = 7 then 0 else seq * 50 end as bigint) as idle, cast(seq * 2 as bigint) as iowait, cast(seq as bigint) as irq, cast(seq + k % 2 as bigint) as softirq,
  cast(case when k % 31 = 5 then 0 else seq * 3 + (case when k % 3 = 0 then 2 else 0 end) end as bigint) as steal,
  cast(case when k % 13 = 0 then null when k % 17 = 0 then 0 else seq * 1500000 + k * 4000000 end as bigint) as throttled_usec,
  cast(k as bigint) as inflight, k % 41 = 0 as hard_cap_hit, cast(seq * 4 + k % 4 as bigint) as shed_total, cast(seq * 100 + k as bigint) as completions,
  case when k > 95 then 2 when k > 85 then 1 else 0 end as level, case when k > 95 then 3 when k > 85 then 1 else 0 end as reasons,
  case when k % 2 = 0 then cast(k as bigint) else -1 end as burst_est,
  cast(seq * 2 + k % 2 as bigint) as waf_skipped_detect, cast(floor(seq / 4) as bigint) as waf_skipped_static, cast(seq * 5 + k % 5 as bigint) as waf_would_skip,
  cast(floor(seq / 900) as bigint) as shed_p0, cast(floor(seq / 300) as bigint) as shed_p1, cast(seq * 4 + k % 4 as bigint) as shed_p2, cast(seq * 7 + k % 7 as bigint) as shed_p3,
  cast(seq * 6 + k % 6 as bigint) as would_shed, cast(k * 37 as bigint) as sched_us, case when k % 2 = 0 then 'calibrated' else 'uncalibrated' end as burst_model,
  case when k > 95 then cast(k as bigint) else 0 end as admission_limit, cast(4 + k % 3 as int) as gomaxprocs
from ev
"""

WAF_AUDIT = """
select l_orderkey as tx_id, l_linenumber as pos, cast(l_partkey % 90 + 942000 as bigint) as rule_id, cast(l_suppkey % 10 as int) as severity,
  concat('Line ', l_returnflag, ' of supplier ', cast(l_suppkey as string), ' ', md5(cast(l_partkey as string))) as msg,
  concat('part ', cast(l_partkey as string), ' of order ', md5(cast(l_orderkey as string))) as data, cast(l_orderkey % 7 as int) as vhost_case,
  case when l_orderkey % 5 = 0 then concat('http=1;coraza_all=0;coraza_rule_ids=', cast(942000 + l_orderkey % 40 as string), ',', cast(942041 + l_orderkey % 40 as string))
    when l_orderkey % 5 = 1 then 'all' else '' end as marker
from lineitem
"""


#: Header fields of the requests view by their column, in the case that some clients write them; a doubled field has two values.
IN_FIELDS = {
    "x-forwarded-FOR": "xff", "CF-Connecting-IP": "cdn_ip", "cf-ray": "cdn_ray", "X-Real-Ip": "real_ip", "USER-AGENT": "ua", "Accept": "accept", "Sec-Fetch-Mode": "fetch_mode",
    "sec-fetch-dest": "fetch_dest", "Cookie": "cookie", "Referer": "referer", "X-Monitor": "monitor_field",
}
OUT_FIELDS = {"Content-Type": "content_type", "location": "location", "Content-Encoding": "content_encoding", "Set-Cookie": "set_cookie"}
DOUBLED = {"cookie", "set_cookie"}


def header_map(fields: dict[str, str]) -> Column:
    """map<string, array<string>> of the fields that are there."""
    entries = [e for n, c in fields.items() for e in (F.lit(n), F.array(F.col(c), *[F.lit("b=2")] * (c in DOUBLED)))]
    return F.map_filter(F.create_map(*entries), lambda n, values: values[0].isNotNull())


def declared(requests: DataFrame) -> DataFrame:
    """The requests view as its producers write it: header fields in maps, and in no other column."""
    maps = requests.withColumns({"headers": header_map(IN_FIELDS), "resp_headers": header_map(OUT_FIELDS)})
    return maps.drop(*IN_FIELDS.values(), *OUT_FIELDS.values())


def views(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    """The named views as DataFrames; nothing stays registered."""
    texts = {"requests": REQUESTS, "connections": CONNECTIONS, "node_samples": NODE_SAMPLES}
    events = spread(table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props"))
    ev = spark.sql(EV_SPARK.replace("from events", "from {events}"), events=events)
    found = {n: spark.sql(texts[n].replace("from ev", "from {ev}"), ev=ev) for n in names}
    return [declared(found[n]) if n == "requests" else found[n] for n in names]
