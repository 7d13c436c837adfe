"""Exemption of requests and findings by proof, and redaction of what identifies a client.

A transaction proves which kind of marker it carries by the names of the rule sets that saw it. Names of
headers and proofs are parameters.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from edgelens.operators import managed as M, waf
from edgelens.operators.addresses import plain_address as parse_ip
from edgelens.runtime import importable

NO_ADDRESS = "::"


@dataclass(frozen=True)
class Proofs:
    """Names of the rule-set proofs and of the headers that markers come in."""

    family: str = "EVIDENCE/"
    signature: str = "EVIDENCE/2"
    first: str = "HEADER-EXEMPT/1"
    evidence_header: str = "x-evidence"
    first_header: str = "x-exempt"


def single_header(headers: Column, name: str) -> Column:
    """The value of a header, in any case, that is there once with one value; else null.

    headers: map<string, array<string>>."""
    found = F.map_values(F.map_filter(headers, lambda k, v: F.lower(k) == name.lower()))
    return F.when((F.size(found) == 1) & (F.size(F.get(found, F.lit(0))) == 1), F.get(F.get(found, F.lit(0)), F.lit(0)))


def evidence_version(rulesets: Column, proofs: Proofs = Proofs()) -> Column:
    """2 with the proof of markers, -1 with a foreign one of its family, else 0 (also for null)."""
    foreign = F.exists(rulesets, lambda r: r.startswith(proofs.family) & (r != proofs.signature))
    return F.when(foreign, -1).when(F.array_contains(rulesets, proofs.signature), 2).otherwise(0)


def exempt_findings(findings: DataFrame, catalog: DataFrame, proofs: Proofs = Proofs()) -> DataFrame:
    """findings with exempt, by rule where version 2 is proven, by the whole request where only the first is.

    findings: rulesets array<string>, headers map<string, array<string>>, rule_id."""
    version = evidence_version(F.col("rulesets"), proofs)
    first = (version == 0) & F.array_contains("rulesets", proofs.first) & (single_header(F.col("headers"), proofs.first_header) == "true")
    rows = findings.withColumns({
        "__marker": F.when(version == 2, single_header(F.col("headers"), proofs.evidence_header)), "__first": F.coalesce(first, F.lit(False)),
    })
    out = waf.mark_exempt(rows, catalog, "__marker")
    return out.withColumn("exempt", F.col("exempt") | F.col("__first")).drop("__marker", "__first")


def exempt_requests(requests: DataFrame, snapshots: DataFrame, v2: bool, telemetry: bool = True, key: str = "request_uuid", marker: str = "exempt_var") -> DataFrame:
    """requests with defense_exempt: the frozen snapshot of the request speaks first; without one nothing is
    exempt in mode v2, and otherwise the marker decides, if its telemetry is on.

    snapshots: (key, http boolean); several rows of one key count as one that is exempt if all are."""
    one = snapshots.groupBy(key).agg(F.bool_and("http").alias("__http"))
    old = F.lit(False) if v2 or not telemetry else F.coalesce(F.col(marker) == "true", F.lit(False))
    return requests.join(one, key, "left").withColumn("defense_exempt", F.coalesce("__http", old)).drop("__http")


def _each(s: pd.Series, f) -> pd.Series:
    """f of a series, once for each different value."""
    return s.map({x: f(x) for x in s.dropna().unique()})


def with_forwarded_ip(rows: DataFrame, cdn: str = "cdn_ip", xff: str = "xff", out: str = "forwarded_ip") -> DataFrame:
    """rows with the address that the network in front reports: its own header if that parses, else the last
    entry of the forwarded list if that parses, else ::."""
    importable(rows.sparkSession)

    @F.pandas_udf("string")
    def parse(s: pd.Series) -> pd.Series:
        return _each(s, parse_ip).astype(object)  # of nulls alone it is floats, of which Arrow makes no strings

    last = F.element_at(F.split(F.col(xff), ","), -1)
    return rows.withColumn(out, F.coalesce(parse(F.col(cdn)), parse(last), F.lit(NO_ADDRESS)))


def field_carries(text: str | None, values: set[str], ips: set[str]) -> bool:
    """Whether a header field or an element of its list is a managed value, as it is or decoded."""
    for t in M.decoded(text or ""):
        for part in (t, *t.split(",")):
            if part.strip().lower() in values or (ips and parse_ip(part) in ips):
                return True
    return False


def masked_address(ips: set[str]) -> str:
    """The first of 100::, 100::1, ... that is not managed."""
    return next(a for a in ("100::" + (f"{n:x}" if n else "") for n in range(len(ips) + 1)) if a not in ips)


def redact_identity(
    rows: DataFrame, managed: list[tuple[str, str]], ua: str = "ua", forwarded: str = "forwarded_ip", hash_ip: str = "hash_ip",
    remote: str = "remote_addr", xff: str = "xff",
) -> DataFrame:
    """rows whose agent, forwarded address and hashed address show no managed value.

    An agent is masked if it is a managed value, or holds a long one of another header: what is managed under the
    agent's own name is often just how agents begin. A managed forwarded address becomes 100::, a managed last entry of the forwarded list gives way to the connection's address."""
    importable(rows.sparkSession)
    values = {v.strip().lower() for _, v in managed if v.strip()}
    ips = {i for _, v in managed for i in map(parse_ip, v.split(",")) if i}
    inside = sorted({v.strip().lower() for n, v in managed if n.lower() != "user-agent" and len(v.strip().encode()) >= M.LONG_VALUE})
    mark = M.choose_marker(sorted(values))

    @F.pandas_udf("boolean")
    def carried(s: pd.Series) -> pd.Series:
        return _each(s, lambda x: field_carries(x, values, ips)).fillna(False).astype(bool)

    held = carried(F.col(ua))
    for v in inside:
        held = held | F.coalesce(F.lower(ua).contains(v), F.lit(False))
    return rows.withColumns({
        ua: F.when((F.col(ua) != "") & held, mark).otherwise(F.col(ua)),
        forwarded: F.when(F.col(forwarded).isin(sorted(ips)), masked_address(ips)).otherwise(F.col(forwarded)),
        hash_ip: F.when((F.coalesce(F.col(xff), F.lit("")) != "") & carried(F.col(hash_ip)), F.col(remote)).otherwise(F.col(hash_ip)),
    })
