"""Queries of the static screen, exemptions and identity redaction, each with DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from edgelens.functions import screening
from edgelens.operators import exemptions, normalize, waf
from edgelens.plans import sql as S
from edgelens.plans.queries import audit, findings, query
from edgelens.sources.facts import views

SCREENED = """
select seq, method, case when k % 8 = 1 and k % 3 = 0 then concat(uri, '?v=1.2') when k % 8 = 1 and k % 3 = 2 then concat(uri, '?v=%20') else uri end as target,
  case when k % 4 = 1 or k % 8 = 5 then cast(0 as bigint) else content_length end as body_length,
  case k % 10 when 1 then concat(ua, ' () { :; }') when 3 then 'Mozilla/5.0 (X11; Linux) UNION' when 5 then concat(ua, '--') when 8 then 'a <b>'
    else concat('Mozilla/5.0 (X11; rv:1) re_select ', event_type) end as agent,
  case user_id % 6 when 0 then 'a=1;b=2' when 1 then 'a=1; b=2' when 2 then 'q=%27' when 3 then 'a b=1' else null end as cookie,
  case user_id % 7 when 0 then 'https://h/ETC/x' when 1 then 'https://a b' when 2 then 'https://a/b?c' else null end as referer
from (select *, split_part(ua, '/', 1) as event_type from requests) r
"""

# Fixed values of the data model, written out again for the SQL.
_EXT = "(css|js|mjs|map|png|jpg|jpeg|gif|webp|avif|svg|ico|bmp|woff|woff2|ttf|otf|eot|mp4|webm|mp3|ogg|wav|m4a|wasm)"
_WORDS = "(?i)(^|[^A-Za-z_])(select|union|insert|update|delete|drop|truncate|alter|sleep|pg_sleep|benchmark|waitfor|exec|execute|declare|having|information_schema|load_file|outfile|dumpfile|xp_cmdshell)($|[^A-Za-z_])"
P32 = S.BASE + f"""s as ({SCREENED}), p as (select *, split_part(target, '?', 1) as path, case when contains(target, '?') then target[instr(target, '?') + 1:] else '' end as query,
  coalesce(agent, '') || chr(1) || coalesce(cookie, '') || chr(1) || coalesce(referer, '') as whole from s)
select seq, method in ('GET', 'HEAD') and body_length = 0 and regexp_full_match(path, '/[A-Za-z0-9_.~/-]{{1,256}}') and not contains(path, '..') and not contains(path, '//')
  and not regexp_matches(path, '\\..*/') and regexp_matches(lower(path), '\\.{_EXT}$') and regexp_full_match(query, '[A-Za-z0-9_.=&-]{{0,64}}')
  and not regexp_matches(whole, '[<`]|\\$\\{{|\\(\\)[ \\t]*\\{{') and not regexp_matches(whole, '{_WORDS}') and not contains(whole, '--')
  and regexp_full_match(agent, '[A-Za-z0-9_.~=:/+,();?&! -]*') and not regexp_matches(agent, '(?i)/(bin|etc)/')
  and regexp_full_match(coalesce(cookie, ''), '([A-Za-z0-9_.~=:/+-]|; )*')
  and regexp_full_match(coalesce(referer, ''), '[A-Za-z0-9_.~=:/+,();?&!-]*') and not regexp_matches(coalesce(referer, ''), '(?i)/(bin|etc)/') as skippable
from p"""


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.with_fields(views(spark, sf_dir, "requests")[0])


@query(P32)
def p32_skippable_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which requests a firewall may skip; lengths and headers are varied so that each test decides some."""
    s = spark.sql(SCREENED.replace("{", "{{").replace("}", "}}").replace("from requests", "from {requests}"), requests=_requests(spark, sf_dir))
    headers = F.array(*[F.struct(F.lit(n).alias("name"), F.col(v).alias("value")) for n, v in (("User-Agent", "agent"), ("Cookie", "cookie"), ("Referer", "referer"))])
    return s.select("seq", screening.skippable_static(F.col("method"), F.col("target"), F.col("body_length"), headers).alias("skippable"))


@query(S.BASE + """f as (select seq, case when cdn_ip is not null then '2001:db8::1' when xff is not null and xff <> 'junk' then trim(string_split(xff, ',')[-1]) else '::' end as forwarded_ip from requests)
select seq, forwarded_ip from f""")
def p18_forwarded_ips(spark, sf_dir):
    return exemptions.with_forwarded_ip(_requests(spark, sf_dir)).select("seq", "forwarded_ip")


E5 = """with f as (select l_orderkey as tx_id, l_linenumber as pos, l_partkey % 90 + 942000 as rule_id, 942000 + l_orderkey % 40 as a, 942041 + l_orderkey % 40 as b,
  case l_orderkey % 7 when 0 then 2 when 1 then -1 when 3 then -1 when 4 then 2 when 5 then 2 else 0 end as version from lineitem)
select tx_id, pos, coalesce(case when version = 2 then tx_id % 9 <> 0 and (tx_id % 5 = 1 or (tx_id % 5 = 0 and a % 40 <> 7 and b % 40 <> 7 and rule_id in (a, b)))
  when version = 0 then tx_id % 7 = 2 and tx_id % 4 = 0 end, false) as exempt from f"""


@query(E5)
def e5_evidence_versions(spark, sf_dir):
    """Findings exempt by whichever marker their transaction proves; doubled headers prove nothing."""
    p, tx = exemptions.Proofs(), F.col("tx_id")
    catalog = spark.range(942000, 942100).where("id % 40 <> 7").select(F.col("id").alias("rule_id"))
    sets = (
        F.when(tx % 7 == 1, F.array(F.lit("EVIDENCE/9"))).when(tx % 7 == 2, F.array(F.lit("core"), F.lit(p.first)))
        .when(tx % 7 == 3, F.array(F.lit(p.signature), F.lit("EVIDENCE/9"))).when(tx % 7 == 6, F.array(F.lit("core")))
        .otherwise(F.array(F.lit("core"), F.lit(p.signature)))
    )
    marker = F.when(F.col("marker") == "all", "http=0;coraza_all=1;coraza_rule_ids=").otherwise(F.col("marker"))
    values = F.when(tx % 9 == 0, F.array(marker, marker)).otherwise(F.array(marker))
    headers = F.map_from_arrays(F.array(F.lit("X-Evidence"), F.lit("X-EXEMPT")), F.array(values, F.array(F.when(tx % 4 == 0, "true").otherwise("True"))))
    found = findings(audit(spark, sf_dir)).withColumns({"rulesets": sets, "headers": headers})
    return exemptions.exempt_findings(found, catalog, p).select("tx_id", "pos", "exempt")


@query(S.BASE + """x as (select r.seq, r.k, s.http from requests r left join (select seq, k % 4 = 0 as http from requests where k % 2 = 0) s on r.seq = s.seq)
select seq, coalesce(http, false) as exempt_v2, coalesce(http, k % 3 = 0) as exempt_v1 from x""")
def j7_exempt_requests(spark, sf_dir):
    """Exemption of requests in both modes; half of the requests have a frozen snapshot."""
    r = views(spark, sf_dir, "requests")[0].select("seq", "k", F.when(F.col("k") % 3 == 0, "true").otherwise("no").alias("exempt_var"))
    snapshots = r.where("k % 2 = 0").select("seq", (F.col("k") % 4 == 0).alias("http"))
    new = exemptions.exempt_requests(r, snapshots, v2=True, key="seq").withColumnRenamed("defense_exempt", "exempt_v2")
    return exemptions.exempt_requests(new, snapshots, v2=False, key="seq").select("seq", "exempt_v2", F.col("defense_exempt").alias("exempt_v1"))


MANAGED = [("X-Tag", "view/7"), ("X-Key", "Purchase/"), ("User-Agent", "signup/1"), ("X-Peer", "203.0.113.12, 2001:db8:0::1"), ("X-Peer", "203.0.113.18")]


@query(S.BASE + """f as (select seq, ua, xff, remote_addr, case when cdn_ip is not null then '2001:db8::1' when xff is not null and xff <> 'junk' then trim(string_split(xff, ',')[-1]) else '::' end as f,
  case when xff is not null then trim(string_split(xff, ',')[-1]) else remote_addr end as h from requests)
select seq, case when ua in ('view/7', 'signup/1') or contains(ua, 'purchase/') then '[masked]' else ua end as ua,
  case when f in ('203.0.113.12', '203.0.113.18', '2001:db8::1') then '100::' else f end as forwarded_ip,
  case when xff is not null and h in ('203.0.113.12', '203.0.113.18') then remote_addr else h end as hash_ip from f""")
def r4_redact_identity(spark, sf_dir):
    from edgelens.functions import columns as C

    rows = exemptions.with_forwarded_ip(_requests(spark, sf_dir))
    rows = rows.withColumn("hash_ip", C.hash_ip(F.col("xff"), F.col("remote_addr")))
    return exemptions.redact_identity(rows, MANAGED).select("seq", "ua", "forwarded_ip", "hash_ip")
