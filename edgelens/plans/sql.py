"""DuckDB SQL for the telemetry queries, written apart from the DataFrame code. FACTS and CONN are WITH clauses."""

from __future__ import annotations

from edgelens.sources.facts import CONNECTIONS, EV_DUCKDB, NODE_SAMPLES, REQUESTS, WAF_AUDIT

BASE = f"with ev as ({EV_DUCKDB}), requests as ({REQUESTS}), "

PATH_BUCKET = """'/' || array_to_string(list_transform([s for s in string_split(lower(regexp_extract({p}, '^([^?#]*)', 1)), '/') if s <> ''][1:3], lambda s:
  case when strlen(s) > 64 or regexp_full_match(s, '[0-9]+') or regexp_full_match(s, '[0-9a-f]{{8}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{12}}')
    or (strlen(s) >= 8 and regexp_matches(s, '[A-Za-z]') and length(regexp_replace(s, '[^0-9]', '', 'g')) >= 3)
    or regexp_matches(s, '[0-9][.-]|[.-][0-9]') then '*' else s end), '/')"""

# Bounds, methods, sources, reasons and extensions below are fixed values of the data model, written out again for the SQL.
BUCKET = "case " + " ".join(f"when duration_us < {b} then {i}" for i, b in enumerate([1000, 2000, 5000, 10000, 25000, 50000, 100000, 250000, 500000, 1000000, 2500000, 5000000, 10000000, 30000000, 60000000])) + " else 15 end"

FACTS = BASE + f"""
r0 as (select *, case when wrote then written_status when err_is_handler and err_status <> 0 then err_status else 200 end as status,
    case when block_reason_var <> '' then block_reason_var when not err_is_handler then '' when contains(err_message, 'interruption triggered') then 'waf'
      when err_status = 429 then 'rate_limit' else '' end as block_reason,
    regexp_extract(uri, '^([^?#]*)', 1) as path from requests),
r1 as (select *, case when block_reason <> '' then 'cluster_blocked' when err_kind = 'no_upstreams' then 'cluster_proxy_error' when upstream_addr is null then 'cluster'
      when not err_is_handler then 'upstream' when retried_response then 'upstream' else 'cluster_proxy_error' end as origin from r0),
facts as (select *, coalesce(monitor_field = 'true', false) as monitor, date_trunc('minute', end_ts) as minute, date_trunc('day', end_ts) as w,
    case when method in ('GET','POST','PUT','PATCH','DELETE','HEAD','OPTIONS','CONNECT','TRACE') then method else 'OTHER' end as method_norm,
    case block_reason when 'waf' then 'waf_blocked' when 'rate_limit' then 'rate_limited' else case challenge_outcome when 'issued' then 'challenge_issued'
      when 'passed' then 'challenge_passed' when 'passed_fallback' then 'challenge_passed' when 'failed' then 'challenge_failed'
      when 'passed_recently' then 'challenge_passed_prior' else 'served' end end as disposition,
    case when regexp_full_match(coalesce(country, ''), '[A-Za-z]{{2}}') then upper(country) else '' end as country_norm,
    coalesce(case when try_cast(asn as bigint) between 0 and 4294967295 then try_cast(asn as bigint) end, 0) as asn_norm,
    case when try_cast(vhost_var as bigint) between 0 and 4294967295 then try_cast(vhost_var as bigint) end as vhost_id,
    {BUCKET} as lat_bucket, cast(case when status between 100 and 599 then status // 100 else 0 end as int) as status_bucket,
    case when proto_major = 2 then '2' when proto_major = 3 then '3' when proto_major = 1 and proto_minor = 1 then '1.1' else 'other' end as http_version,
    case when coalesce(cdn_ip, cdn_ray) is not null then 'cloudflare' when coalesce(xff, real_ip) is not null then 'forwarded' else '' end as front_proxy,
    case when xff is not null then trim(string_split(xff, ',')[-1]) else remote_addr end as hash_ip,
    case when challenge_outcome = 'issued' and challenge_reason in ('document', 'other') then 'issued_' || challenge_reason
      when challenge_outcome = 'failed' and challenge_reason in ('api', 'stream') then 'not_shown_' || challenge_reason
      when challenge_outcome = 'failed' and challenge_reason in ('token','expired','binding','proof','stale_difficulty','replay','render_cookie','render_pixel','render_dwell','fallback_replay','fallback_limit')
        then 'failed_' || challenge_reason
      when challenge_outcome = 'passed_recently' and challenge_reason = 'fallback' then 'passed_recently_fallback' else challenge_outcome end as challenge,
    case when coalesce(challenge_source, '') = '' then '' when challenge_source in ('automatic','staff','customer','edge_sequence','reputation','unknown') then challenge_source else 'unknown' end as source,
    method in ('GET', 'HEAD') and regexp_matches(lower(path), '\\.(css|js|mjs|map|png|jpg|jpeg|gif|webp|avif|svg|ico|bmp|woff|woff2|ttf|otf|eot|mp4|webm|mp3|ogg|wav|m4a|wasm)$') as is_static,
    case when starts_with(path, '/.well-known/acme-challenge/') or path = '/healthy' then 'P0'
      when method in ('GET', 'HEAD') and (coalesce(fetch_mode, '') = 'navigate' or coalesce(fetch_dest, '') = 'document' or starts_with(accept, 'text/html')) then 'P1'
      when method in ('GET', 'HEAD') and regexp_matches(lower(path), '\\.(css|js|mjs|map|png|jpg|jpeg|gif|webp|avif|svg|ico|bmp|woff|woff2|ttf|otf|eot|mp4|webm|mp3|ogg|wav|m4a|wasm)$') then 'P3' else 'P2' end as admission_class,
    case when origin <> 'cluster_proxy_error' or status not between 500 and 599 or wrote or cancelled then '' when err_kind = 'no_upstreams' then 'no_upstreams_available'
      when err_kind = 'certificate' then 'tls_certificate_error' when err_kind = 'dns' then 'dns_error' when err_kind = 'dns_timeout' then 'dns_timeout'
      when err_kind = 'reset' then 'connection_reset' when err_kind = 'eof' then 'upstream_eof' when err_kind = 'header_timeout' then 'response_header_timeout'
      when err_message = 'dial failed' then 'connection_refused' when err_message = 'x: failed' then 'connect_timeout' when err_message = '' then 'connect_timeout'
      when err_kind = 'write' then 'request_write_error' else 'unknown' end as failure_reason,
    cast(strlen(method) + strlen(uri) + 12 + coalesce(19 + strlen(xff), 0) + coalesce(20 + strlen(cdn_ip), 0) + coalesce(10 + strlen(cdn_ray), 0) + coalesce(13 + strlen(real_ip), 0)
      + 14 + strlen(ua) + 10 + strlen(accept) + coalesce(18 + strlen(fetch_mode), 0) + coalesce(18 + strlen(fetch_dest), 0) + coalesce(10 + strlen(cookie) + 13, 0) + coalesce(11 + strlen(referer), 0)
      + coalesce(13 + strlen(monitor_field), 0) + 2 + greatest(content_length, 0) as bigint) as bytes_in,
    cast(case when not wrote or hijacked then 0 else body_bytes_out + 17 + coalesce(16 + strlen(content_type), 0) + coalesce(12 + strlen(location), 0)
      + coalesce(20 + strlen(content_encoding), 0) + coalesce(14 + strlen(set_cookie) + 17, 0)
      + strlen(case written_status when 200 then 'OK' when 301 then 'Moved Permanently' when 404 then 'Not Found' when 500 then 'Internal Server Error' when 501 then 'Not Implemented'
        when 502 then 'Bad Gateway' when 503 then 'Service Unavailable' when 504 then 'Gateway Timeout' end) end as bigint) as bytes_out,
    {PATH_BUCKET.format(p="uri")} as path_bucket
  from r1)
"""

P12 = f"select page_id, {PATH_BUCKET.format(p="regexp_extract(url, '^[a-z]+://[^/]*(.*)$', 1)")} as path_bucket from pages"


def _cap(n: int) -> str:
    def start(k: int) -> str:
        return f"substr(h, {2 * k + 1}, 1) not in ('8', '9', 'A', 'B')"

    end = f"case when {start(n)} then {n} when {start(n - 1)} then {n - 1} when {start(n - 2)} then {n - 2} else {n - 3} end"
    return f"case when strlen(text) <= {n} then text else decode(unhex(substr(h, 1, 2 * {end}))) end"


P16 = f"select doc_id, {_cap(512)} as capped, {_cap(255)} as capped_255 from (select doc_id, text, hex(encode(text)) as h from documents)"

FNV = """list_reduce(list_prepend(14695981039346656037::uhugeint, [('0x' || hex(encode({t}))[2*i-1:2*i])::int::uhugeint for i in range(1, strlen({t}) + 1)]),
  lambda a, b: (xor(a, b) * 1099511628211::uhugeint) % 18446744073709551616::uhugeint)"""
P27 = FACTS + f"select hash_ip, ua, ({FNV.format(t="s")})::varchar as client_hash from (select distinct hash_ip, ua, hash_ip || chr(31) || ua || chr(31) || 'salt' as s from facts)"

P29 = BASE + """x as (select seq, k from requests)
select seq, case k % 4 when 0 then 'connection_refused' when 1 then case when k % 2 = 0 then 'connect_timeout' else 'connection_refused' end
  when 2 then case when k % 2 = 0 then 'connect_timeout' else 'connection_refused' end end as reason from x"""

_LEGACY = """date_trunc('second', end_ts) as ts, cluster_id, coalesce(vhost_id, 0) as vhost_id, string_split(remote_addr, ':')[1] as client_ip,
  case when cdn_ip is not null then '2001:db8::1' when contains(xff, ',') then trim(string_split(xff, ',')[-1]) else '::' end as forwarded_ip, front_proxy, method_norm as method, path, path_bucket,
  status, http_version, ua, origin, bytes_in, bytes_out, duration_us, 1::bigint as sample_rate, case when exempt then true end as defense_exempt"""
P33 = f"""select {_LEGACY}, epoch_us(end_ts) // 1000 as ts_ms, machine_id, seq as machine_seq, disposition,
  case when vhost_id is null then lower(regexp_replace(host, ':[0-9]*$', '')) else '' end as host, request_uuid as request_id, nullif(failure_reason, '') as upstream_failure_reason
from facts where not monitor and (vhost_id is not null or challenge_outcome <> '')"""
P33_LEGACY = f"select {_LEGACY} from facts where not monitor and vhost_id is not null and block_reason = ''"

_COUNTER = "minute, vhost_id, method_norm, status, origin, country_norm, asn_norm, exempt, count(*) as request_count, cast(sum(bytes_in) as bigint) as bytes_in, cast(sum(bytes_out) as bigint) as bytes_out, cast(sum(duration_us) as bigint) as duration_us_sum"
A1 = f"select {_COUNTER} from facts where not monitor and vhost_id is not null group by all"
A2 = f"select {_COUNTER}, " + ", ".join(f"nullif(count(*) filter (lat_bucket = {i}), 0) as lat_b{i:02d}" for i in range(16)) + " from facts where not monitor and vhost_id is not null group by all"
A3 = f""", u as (select distinct w as minute, vhost_id, hash_ip || chr(31) || ua || chr(31) || 'salt' as s from facts where not monitor and vhost_id is not null),
h as (select s, ({FNV.format(t="s")})::varchar as client_hash from (select distinct s from u))
select minute, vhost_id, count(*) as clients, min(client_hash) as least_hash from u join h using (s) group by all"""

# agents, forwarded lists and accepted types of the view hold nothing that the screen refuses
A18 = """, x as (select *, is_static and content_length = 0 and not regexp_matches(uri, '[?#]') and not contains(uri, '//') and not regexp_matches(uri, '\\..*/') as skippable from facts where not monitor)
select minute, admission_class, skippable, count(*) as cnt from x group by all"""
_EVENTS = "select * from facts where not monitor and (vhost_id is not null or challenge_outcome <> '')"
_DISP = f"""e as ({_EVENTS}),
p as (select *, row_number() over (partition by machine_id, w, disposition <> 'served' order by seq) - 1 as pos from e),
s as (select *, case when disposition = 'served' or pos < 5 then 1 else pos // 5 + 1 end as sample_rate from p)"""
A17 = f", {_DISP} select origin, disposition, count(*) as kept, cast(sum(sample_rate) as bigint) as requests from s where disposition = 'served' or pos % sample_rate = 0 group by all"
C9 = f", {_DISP} select seq, disposition, sample_rate from s where disposition = 'served' or pos % sample_rate = 0"

A12 = """, h as (select *, origin = 'upstream' and (wrote or retried_response) and upstream_latency_us > 0 and (latency_before_us is null or latency_before_us <> upstream_latency_us)
    and (upstream_status = 101 or upstream_status between 200 and 599) as seen from facts
  where not monitor and vhost_id is not null and vhost_id <> 0 and regexp_full_match(health_key, '[0-9a-f]{64}'))
select minute, vhost_id, health_key, count(*) as request_count,
  count(*) filter (seen or (not err_is_handler and origin <> 'cluster_proxy_error' and (wrote or (origin <> 'upstream' and not cancelled)))) as routing_responses,
  count(*) filter (seen) as upstream_responses, count(*) filter (seen and upstream_status between 200 and 399) as upstream_successes,
  count(*) filter (seen and upstream_status between 500 and 599) as upstream_5xx, count(*) filter (origin = 'cluster_proxy_error') as proxy_errors
from h group by all"""

NODES = f"with ev as ({EV_DUCKDB}), n as ({NODE_SAMPLES})"
_COUNTERS = ["waf_skipped_detect", "waf_skipped_static", "waf_would_skip", "shed_p0", "shed_p1", "shed_p2", "shed_p3", "would_shed"]
A14 = NODES + """, m as (select machine_id, date_trunc('minute', ts) as minute, max(level) as max_level, count(*) filter (level = 1) as level1_samples,
    count(*) filter (level = 2) as level2_samples, bit_or(reasons) as reasons, max(sched_us) as max_sched_us, coalesce(min(burst_est) filter (burst_est <> -1), -1) as burst_est,
    arg_max(burst_model, t) as burst_model, max(inflight) as max_inflight, coalesce(min(admission_limit) filter (admission_limit > 0), 0)::bigint as admission_limit,
    arg_max(gomaxprocs, t) as gomaxprocs, """ + ", ".join(f"arg_min({c}, t) as {c}_0" for c in _COUNTERS) + """ from n group by 1, 2),
d as (select *, lead(minute) over w as later, """ + ", ".join(f"cast(lead({c}_0) over w - {c}_0 as bigint) as {c}" for c in _COUNTERS) + """ from m window w as (partition by machine_id order by minute))
select machine_id, minute, max_level, level1_samples, level2_samples, reasons, max_sched_us, burst_est, burst_model, max_inflight, admission_limit, gomaxprocs, """ + ", ".join(_COUNTERS) + """
from d where later is not null and (max_level > 0 or extract(minute from minute) % 10 = 0 or """ + " or ".join(f"{c} > 0" for c in _COUNTERS) + ")"


def _capped(keys: str, n: int, source: str) -> str:
    return f""", c as (select w, {keys}, count(*) as cnt, min(seq) as f from {source} group by all),
r as (select *, row_number() over (partition by w order by f, {keys}) as a from c)"""


_OWN = "(select * from facts where not monitor and vhost_id is not null)"
A10 = _capped("host, path_bucket, verify_outcome", 20, "(select * from facts where not monitor and verify_outcome <> '')") + " select w, host, path_bucket, verify_outcome, cnt from r where a <= 20"
A20 = " select w as minute, vhost_id, origin, count(*) as request_count, cast(sum(duration_us) as bigint) as duration_us_sum from facts where not monitor and vhost_id is not null group by all"
A20_SETS = " select w as minute, vhost_id, count(distinct hash_ip) as clients, max(duration_us) as longest_us from facts where not monitor and vhost_id is not null group by all"
C1 = _capped("vhost_id, origin, method_norm", 20, _OWN) + " select w, vhost_id, origin, method_norm, cnt from r where a <= 20"
C1_OVER = _capped("vhost_id, origin, method_norm", 20, _OWN) + " select w, cast(sum(cnt) as bigint) as overflow, count(*) as keys_dropped from r where a > 20 group by w"
C1_LINEITEM = """with c as (select concat(l_returnflag, l_linestatus) as w, l_suppkey, l_partkey % 10 as part_class, count(*) as cnt, min(l_orderkey * 10 + l_linenumber) as f from lineitem group by all),
r as (select *, row_number() over (partition by w order by f, l_suppkey, part_class) as a from c) select w, l_suppkey, part_class, cnt from r where a <= 50"""

CONN = f"""with ev as ({EV_DUCKDB}), raw as ({CONNECTIONS}),
conn as (select seq, ts, remote_addr, ja3, ja4, reason, date_trunc('day', ts) as w, date_trunc('minute', ts) as minute,
    case when sni = '' then '__empty__' else sni end as sni,
    case when starts_with(remote_addr, '[') then replace(regexp_extract(remote_addr, '^\\[([^\\]]*)', 1), '2001:db8:0:0::', '2001:db8::')
      when starts_with(remote_addr, '::ffff:') then substr(remote_addr, 8) else string_split(remote_addr, ':')[1] end as ip0,
    starts_with(remote_addr, '[') as six
  from raw where remote_addr <> 'not-an-ip'),
"""
# the view's IPv6 addresses are 2001:db8:0:<d>::<k>; <d> 0 collapses into the run of zeros
CONN = CONN.replace("conn as (", "c0 as (").rstrip().rstrip(",") + """,
conn as (select * exclude (ip0), case when six and ip0 = '2001:db8::0' then '2001:db8::' when six and ends_with(ip0, '::0') then left(ip0, length(ip0) - 1) else ip0 end as ip,
    case when six then '2001:db8::' else regexp_extract(ip0, '^(.*)\\.', 1) || '.0' end as prefix,
    cast(case when six then 56 else 24 end as int) as prefix_len from c0)
"""

C2 = _capped("sni", 25, "conn") + """, k as (select w, case when a > 25 then '__overflow__' else sni end as sni, sum(cnt) as cnt from r group by 1, 2)
select w, sni, cast(cnt as bigint) as cnt from k where cnt > 1 or sni = '__overflow__'"""
C3 = """, c as (select w, prefix, sni, count(*) as cnt, min(seq) as f from conn group by all),
r as (select *, row_number() over (partition by w, prefix order by f) as a from c)
select w, prefix, case when a > 8 then '__overflow__' else sni end as sni, cast(sum(cnt) as bigint) as cnt from r group by 1, 2, 3"""
A5 = _capped("prefix, prefix_len", 12, "conn") + " select w, prefix, prefix_len, cnt from r where a <= 12"
A6 = """, c as (select w, ip, sni, 'allowed' as outcome, count(*) as cnt, min(seq) as f from conn group by all),
r as (select *, row_number() over (partition by w, ip order by f, sni) as a from c),
g as (select w, ip, case when a > 3 then '__overflow__' else sni end as sni, outcome, sum(cnt) as cnt, min(f) as f from r group by 1, 2, 3, 4)
select w, ip, sni, outcome, cast(cnt as bigint) as cnt from g qualify row_number() over (partition by w order by f, ip, sni) <= 40"""
_PRINTS = "(select *, 'allowed' as outcome from conn where ja3 <> '' and ja4 <> '')"
A7 = _capped("minute, ja3, ja4, outcome", 30, _PRINTS) + " select w, minute, ja3, ja4, outcome, cnt from r where a <= 30"
A8 = _capped("minute, ja4, ip", 30, _PRINTS) + " select w, minute, ja4, ip, cnt from r where a <= 30"
A9 = _capped("minute, ip, reason", 40, "(select * from conn where reason <> 'other')") + """
select w, case when a > 40 then w else minute end as minute, case when a > 40 then '::' else ip end as ip,
  case when a <= 40 then reason when reason = 'abuseipdb' then 'abuseipdb_overflow' else 'overflow' end as reason, cast(sum(cnt) as bigint) as cnt
from r group by 1, 2, 3, 4"""
C5 = _capped("ip, reason", 40, "(select * from conn where reason <> 'other')") + """
select w, case when a > 40 then '::' else ip end as ip, case when a <= 40 then reason when reason = 'abuseipdb' then 'abuseipdb_overflow' else 'overflow' end as reason, cast(sum(cnt) as bigint) as cnt
from r group by 1, 2, 3"""

def _tiers(keys: str) -> str:
    return _capped(keys, 30, """(select *, string_split(remote_addr, ':')[1] as client_ip, case when regexp_full_match(hn, '[a-z0-9._-]{1,253}') then hn else '' end as host_n
  from (select *, lower(regexp_replace(regexp_replace(host, ':[0-9]*$', ''), '\\.$', '')) as hn from facts where challenge_outcome <> '' and not exempt))""") + """,
q as (select *, source <> '' and (starts_with(challenge, 'issued_') or starts_with(challenge, 'not_shown_')) as page from r),
z as (select *, case when a > 30 and not page then row_number() over (partition by w, a > 30 and not page order by f) end as a2 from q),
t as (select *, a <= 30 or coalesce(a2, 11) <= 10 as kept from z)"""


_TIERS = _tiers("minute, host_n, challenge, source")
A11 = _tiers("minute, host_n, client_ip, challenge, source") + " select minute, host_n as host, client_ip, challenge as outcome, source, cnt as attempt_count from t where kept"
C4 = _TIERS + " select w, minute, host_n, challenge, source, cnt, page, kept from t"
C11 = _TIERS + " select minute, cast(sum(cnt) as bigint) as lost_count from t where not kept and not page group by minute"
# losses come in ascending minutes, so at the bound the oldest of ten always moves into the new one
T11 = _TIERS + """, l as (select epoch_us(minute) // 60000000 as m, sum(cnt) as lost from t where not kept and not page group by 1),
n as (select *, row_number() over (partition by m % 3 order by m) % 10 as c from l)
select m % 3 as cluster_id, max(m) as minute, cast(sum(lost) as bigint) as lost from n group by m % 3, c"""
C6 = _capped("vhost_id, hash_ip, ua", 100, _OWN) + " select w, vhost_id, count(*) as entries from r where a <= 100 group by all"
_POS = f", e as ({_EVENTS}), p as (select *, row_number() over (partition by machine_id, w order by seq) - 1 as pos from e)"
C7 = _POS + " select seq, machine_id, w from p where pos < 50"
C8 = _POS + """, s as (select *, case when pos >= 20 then pos // 20 + 1 else 1 end as sample_rate from p),
x as (select *, row_number() over (partition by machine_id, w order by seq) as n from s where pos % sample_rate = 0) select seq, sample_rate from x where n <= 40"""
C10 = _POS + """, s as (select *, greatest(case when pos >= 20 then pos // 20 + 1 else 1 end,
  case when k / 100.0 <= 0.7 then 1 else cast(1 + round(15 * least(1.0, (k / 100.0::double - 0.7) / 0.3)) as bigint) end) as sample_rate from p)
select seq, cast(sample_rate as bigint) as sample_rate from s where pos % sample_rate = 0"""
_TRACK = """select '{name}' as track, coalesce(sum(cnt), 0)::bigint + (select count(*) from o where not {rule}) as rows_in, (select count(*) from o where not {rule}) as rejects, count(*) filter (a <= {n}) as keys_kept,
  coalesce(sum(cnt) filter (a <= {n}), 0)::bigint as counted, coalesce(sum(cnt) filter (a > {n}), 0)::bigint as overflow, count(*) filter (a > {n}) as keys_dropped
from (select *, row_number() over (partition by w order by f) as a from (select w, {keys}, count(*) as cnt, min(seq) as f from o where {rule} group by all))"""
A19 = f", o as {_OWN} " + " union all ".join(_TRACK.format(name=name, keys=keys, n=n, rule=rule) for name, keys, n, rule in (
    ("counter", "vhost_id, origin, method_norm", 20, "true"), ("http_version", "http_version, status_bucket", 5, "true"),
    ("domain_health", "vhost_id, health_key", 8, "(regexp_full_match(health_key, '[0-9a-f]{64}') and vhost_id <> 0)")))
A20_SKETCHES = " select w as minute, vhost_id, count(distinct hash_ip || chr(31) || ua) as clients, true as near from facts where not monitor and vhost_id is not null group by all"

J1 = """, d as (select 'h' || s_suppkey::varchar || '.example.com' as host, s_suppkey + 100 as v from supplier),
x as (select seq, vhost_id, case when regexp_full_match(hn, '[a-z0-9._-]{1,253}') then hn end as hn
  from (select seq, vhost_id, lower(regexp_replace(regexp_replace(host, ':[0-9]*$', ''), '\\.$', '')) as hn from facts))
select seq, coalesce(d.v, x.vhost_id)::bigint as vhost_id, coalesce(d.v <> x.vhost_id, false) as conflict from x left join d on x.hn = d.host"""

K1 = """, c as (select w, ip, count(*) as cnt from conn group by all)
select w, ip, cnt, row_number() over (partition by w order by cnt desc, ip)::int as rank from c qualify rank <= 10"""
K1_SKETCH = """, c as (select w, ip, count(*) as cnt from conn group by all), t as (select * from c qualify row_number() over (partition by w order by cnt desc, ip) <= 10)
select w, cast(sum(cnt) as bigint) as weight, max(cnt) as heaviest, count(*) as n from t group by w"""
K2 = """, o as (select * from facts where not monitor and vhost_id is not null), v as (select w, vhost_id, min(seq) as f from o group by all),
a as (select w, vhost_id from v qualify row_number() over (partition by w, vhost_id % 16 order by f) <= 1),
c as (select w, vhost_id, path_bucket, status_bucket, count(*) as cnt from o join a using (w, vhost_id) group by all)
select w, vhost_id, path_bucket, status_bucket, cnt, row_number() over (partition by w, vhost_id order by cnt desc, path_bucket, status_bucket)::int as rank from c qualify rank <= 3"""
K2_REJECTS = """, o as (select * from facts where not monitor and vhost_id is not null), v as (select w, vhost_id, min(seq) as f, count(*) as cnt from o group by all),
r as (select *, row_number() over (partition by w, vhost_id % 16 order by f) as a from v) select w, cast(sum(cnt) as bigint) as rejected from r where a > 1 group by w"""
F6_HEALTH = """, x as (select coalesce(regexp_full_match(health_key, '[0-9a-f]{64}'), false) as good, coalesce(vhost_id <> 0, false) as own from facts where not monitor)
select 'domain_health' as track, count(*) as rows_in, count(*) filter (not good or not own) as rejects, count(*) filter (not good) as bad_health_key, count(*) filter (good and not own) as bad_vhost from x"""
F6_CONN = """, x as (select reason <> 'other' as counted, remote_addr <> 'not-an-ip' as address, ja3 <> '' as a, ja4 <> '' as b from raw)
select 'l4_close' as track, count(*) as rows_in, count(*) filter (not counted or not address) as rejects, count(*) filter (not counted) as bad_reason,
  count(*) filter (counted and not address) as bad_ip, 0::bigint as bad_ja3, 0::bigint as bad_ja4 from x
union all select 'fingerprint', count(*), count(*) filter (not a or not b), 0, 0, count(*) filter (not a), count(*) filter (a and not b) from x"""
K3 = f""", d as (select distinct w, ip from conn), h as (select ip, ({FNV.format(t="ip")}) % 16 = 0 as hit from (select distinct ip from d))
select w, count(*) as sampled, count(*) * 16 as estimate, min(ip) as least_ip from d join h using (ip) where hit group by w"""
J6 = BASE + """s as (select 'u' || (user_id % 5)::varchar as dial, end_ts as ts, duration_us::double as score from requests where method <> 'POST'),
p as (select seq as point, end_ts as ts, k, user_id, unnest([0, 1, 2]) as pos from requests where method = 'POST'),
o as (select point from p group by point),
c as (select point, ts, pos, 'u' || ((user_id + pos) % 6)::varchar as dial, (k + pos) % 3 as inflight from p where (k + pos) % 5 <> 0 and k % 7 <> 3),
j as (select c.*, coalesce(s.score * pow(0.5, (epoch_us(c.ts) - epoch_us(s.ts)) / 3600000000.0::double), 0) * (inflight + 1) as sc from c asof left join s on c.dial = s.dial and c.ts >= s.ts),
b as (select * from j qualify row_number() over (partition by point order by sc, pos) = 1)
select o.point, dial, pos, round(sc, 3) as score from o left join b on o.point = b.point"""

AUDIT = f"with a as ({WAF_AUDIT})"
# Fixed values of the data model.
_SEVERITY = "case severity " + " ".join(f"when {i} then '{n}'" for i, n in enumerate(["EMERGENCY", "ALERT", "CRITICAL", "ERROR", "WARNING", "NOTICE", "INFO", "DEBUG"])) + " else 'UNKNOWN' end"
E1 = AUDIT + f" select tx_id, pos, rule_id, {_SEVERITY} as severity_label, left(msg, 256) as msg, left(data, 512) as match_data from a"
E3 = AUDIT + " select distinct tx_id, case when vhost_case < 3 then vhost_case else 0 end::bigint as vhost_id from a"
E4 = AUDIT + """ select tx_id, pos, rule_id, case when tx_id % 5 = 1 then true
  when tx_id % 5 = 0 and (942000 + tx_id % 40) % 40 <> 7 and (942041 + tx_id % 40) % 40 <> 7 then rule_id in (942000 + tx_id % 40, 942041 + tx_id % 40) else false end as exempt from a"""
_HIT = "(contains(lower({0}), 'part 1234 of') or contains(lower({0}), 'line r of supplier'))"
_SHOWN = "case when carried is null or carried or " + _HIT + " then '[masked]' else {0} end"
R2 = AUDIT + f""", c as (select *, case when tx_id % 11 <> 0 then tx_id % 7 = 0 end as carried from a)
select tx_id, pos, {_SHOWN.format("msg")} as msg, {_SHOWN.format("data")} as match_data,
  case when carried is null then '/[masked]' else '/a/' || case when {_HIT.format("data")} then '[masked]' else replace(data, ' ', '%20') end || '?' || case when carried then '[masked]' else 'q=' || tx_id end end as uri
from c"""
J4 = """with t as (select distinct p_name || ' ' || lower(p_brand) as value from part),
m as (select t.value, string_agg(v.value, '|' order by v.value) as managed from t join t v on contains(t.value || '#x', v.value) group by t.value)
select l_orderkey, l_linenumber, managed from lineitem join part on l_partkey = p_partkey join m on m.value = p_name || ' ' || lower(p_brand)"""
R1 = "select o_orderkey as id, lower(o_orderpriority) = '1-urgent' or o_orderstatus in ('P', 'F') as carried from orders"

_J = """, j as (select machine_id, t, ts, row_number() over w as n, (epoch_us(ts) - epoch_us(lag(ts) over w)) / 1e6::double as dt, x.steal - lag(x.steal) over w as s,
    x.busy - lag(x.busy) over w as b, x.busy + x.steal + x.rest - lag(x.busy + x.steal + x.rest) over w as total, throttled_usec - lag(throttled_usec) over w as h
  from (select machine_id, t, ts, throttled_usec, {'busy': n."user" + nice + system + irq + softirq, 'steal': steal, 'rest': idle + iowait} as x from n) window w as (partition by machine_id order by t)),
d as (select *, dt > 0 and dt <= 3600 as near, dt > 0 and dt <= 3600 and total > 0 as ok from j),
r as (select *, case when ok then greatest(s, 0) * 1000 // total else 0 end as steal_permille from d)"""
T2 = NODES + _J + " select machine_id, t, steal_permille, case when ok then round(greatest(b, 0) / 100.0::double / dt, 6) end as busy from r"
T2_THROTTLED = NODES + _J + " select machine_id, t, greatest(steal_permille, case when near and h >= 0 then floor(least(1.0::double, h / (dt * 1e6::double)) * 1000)::bigint else 0 end) as steal_permille from r"
T3 = NODES.replace("with ev", "with recursive ev", 1) + _J + """,
f as (select machine_id, n, t, steal_permille::double as ewma from r where n = 1 union all
  select r.machine_id, r.n, r.t, case when r.dt > 3600 then r.steal_permille::double when r.dt > 0 then f.ewma + (1 - exp(-r.dt / 10)) * (r.steal_permille - f.ewma) else f.ewma end
  from f join r on r.machine_id = f.machine_id and r.n = f.n + 1)
select machine_id, t, round(ewma, 6) as ewma from f"""
T4 = NODES + """, c as (select machine_id, t, [completions::bigint, shed_total::bigint, t::bigint] as x from n),
d as (select machine_id, t, x, coalesce(lag(x, 10) over w, first_value(x) over w) as o from c window w as (partition by machine_id order by t)),
q as (select machine_id, t, x[1] - o[1] as a, x[2] - o[2] as b, x[3] - o[3] as c from d), z as (select *, a + b + c as s, ((a + b + c) * 99 + 99) // 100 as g from q)
select machine_id, t, case when s = 0 then 0.0 when a >= g then 0.001 when a + b >= g then 0.02 else 0.02 end::double as p99 from z"""
T8 = """, x as (select seq, admission_class as c, k as n, user_id % 3 as level, k % 60 + 10 as l from facts)
select seq, c <> 'P0' and n >= case when c = 'P1' then 112 else 90 end as hard,
  case when c = 'P0' then false when n >= case when c = 'P1' then 112 else 90 end then true when level < 2 then false
    when c = 'P3' then n * 2 >= l when c = 'P2' then n >= l else n * 2 >= l * 3 end as shed from x"""
T9 = f"with recursive ev as ({EV_DUCKDB}), requests as ({REQUESTS}), " + """
s as (select 'u' || (user_id % 5)::varchar as dial, seq as t, end_ts, case when upstream_status in (502, 503, 504) then greatest(duration_us, 5000000) else duration_us end as us from requests where duration_us > 0),
e as (select *, row_number() over w as n, (epoch_us(end_ts) - epoch_us(lag(end_ts) over w)) / 1e6::double as dt from s window w as (partition by dial order by t)),
f as (select dial, n, t, us::double as score from e where n = 1 union all
  select e.dial, e.n, e.t, case when e.dt > 7200 then e.us::double else 0.2::double * e.us + 0.8::double * f.score * pow(0.5::double, greatest(e.dt, 0) / 3600.0::double) end
  from f join e on e.dial = f.dial and e.n = f.n + 1)
select dial, t, round(score, 3) as score from f"""
