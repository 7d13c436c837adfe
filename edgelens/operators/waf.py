"""Firewall findings: explosion of audit transactions, exemption markers, rule catalogue, requests that carry managed values."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from edgelens.functions import columns as C
from edgelens.operators.addresses import plain_address
from edgelens.operators.managed import decoded
from edgelens.runtime import importable

#: Field names of a marker, fixed values of its format: the request's flag, the flag for all rules, the rule ids.
MARKER_FIELDS = ("http", "coraza_all", "coraza_rule_ids")


def explode_findings(audit: DataFrame, vhost_header: str = "x-vhost-id") -> DataFrame:
    """One row per transaction and fired rule, in batch or stream; null messages are skipped, widths are capped in bytes.

    audit: as sources.readers declares it, messages array<struct<id, severity, msg, data, tags>>. Where the transaction's
    columns are there, its time comes in seconds, its host from server_id, its vhost from its headers."""
    have = set(audit.columns)
    rows = audit.withColumn("m", F.explode(F.filter("messages", lambda m: m.isNotNull()))).drop("messages")
    m = F.col("m")
    out = {
        "rule_id": F.greatest(m["id"].cast("long"), F.lit(0)), "severity": m["severity"], "severity_label": C.severity_label(m["severity"]), "tags": m["tags"],
        "msg": C.byte_cap(F.coalesce(m["msg"], F.lit("")), 256), "match_data": C.byte_cap(F.coalesce(m["data"], F.lit("")), 512),
    }
    out |= {c: C.byte_cap(F.col(c), n) for c, n in (("uri", 2048), ("host", 255), ("method", 32)) if c in have}
    if "server_id" in have:
        out["host"] = C.byte_cap(F.col("server_id"), 255)
    if "ts_ns" in have:
        out["ts_s"] = F.least(F.greatest(F.expr("ts_ns div 1000000000"), F.lit(0)), F.lit(C.U32)).cast("long")
    if "interrupted" in have:
        out["was_blocked"] = F.coalesce("interrupted", F.lit(False))
    if "headers" in have:
        out["vhost_id"] = header_vhost(F.col("headers"), vhost_header)
    return rows.withColumns(out).drop("m")


def header_vhost(headers: Column, name: str) -> Column:
    """The first value of a header, in any case, that is an unsigned 32-bit number; else 0."""
    values = F.flatten(F.map_values(F.map_filter(headers, lambda k, v: F.lower(k) == name.lower())))
    return F.coalesce(F.get(F.array_compact(F.transform(values, lambda v: C.u32(v))), F.lit(0)), F.lit(0))


def parse_evidence(marker: Column, fields: tuple[str, str, str] = MARKER_FIELDS) -> Column:
    """struct<http, all, ids> of a canonical marker with strictly ascending ids; null otherwise."""
    form = "^{}=([01]);{}=([01]);{}=((?:[1-9][0-9]*(?:,[1-9][0-9]*)*)?)\\z".format(*map(re.escape, fields))
    ids = F.transform(F.filter(F.split(F.regexp_extract(marker, form, 3), ","), lambda x: x != ""), lambda x: x.try_cast("long"))
    ascending = F.forall(F.zip_with(F.slice(ids, 1, F.greatest(F.size(ids) - 1, F.lit(0))), F.slice(ids, 2, F.greatest(F.size(ids) - 1, F.lit(0))), lambda a, b: a < b), lambda x: x)
    value = F.struct((F.regexp_extract(marker, form, 1) == "1").alias("http"), (F.regexp_extract(marker, form, 2) == "1").alias("all"), ids.alias("ids"))
    return F.when(marker.rlike(form) & ascending, value)


#: Rules up to which a catalogue is kept in the plan; beyond, markers' rules are joined with it.
CATALOG_RULES = 4096


def mark_exempt(findings: DataFrame, catalog: DataFrame, marker: str = "marker") -> DataFrame:
    """findings with exempt: by the all-flag, or the rule is in the marker's list; a marker that names a
    rule outside the catalogue is void. findings may be a stream; the catalogue (rule_id) is a table."""
    rows = findings.withColumn("__e", parse_evidence(F.col(marker)))
    known = [r.rule_id for r in catalog.where("rule_id is not null").select("rule_id").distinct().limit(CATALOG_RULES + 1).collect()]
    if len(known) > CATALOG_RULES:
        # most findings have no marker of rules and take no part in the join
        named = rows.select(F.when(F.size("__e.ids") > 0, F.col(marker)).alias("__named"), "__e.ids").where("__named is not null").dropDuplicates(["__named"])
        listed = catalog.select(F.col("rule_id").alias("__rule")).distinct()
        void = named.select("__named", F.explode("ids").alias("__rule")).join(listed, "__rule", "left_anti").select("__named").distinct().withColumn("__void", F.lit(True))
        rows = rows.withColumn("__named", F.when(F.size("__e.ids") > 0, F.col(marker))).join(void, "__named", "left")
        valid = F.col("__void").isNull()
    else:
        valid = F.forall("__e.ids", lambda i: F.array_contains(F.lit(sorted(known)).cast("array<bigint>"), i))
    hit = F.col("__e.all") | (F.array_contains("__e.ids", F.col("rule_id")))
    return rows.withColumn("exempt", F.coalesce(valid & hit, F.lit(False))).drop("__e", "__named", "__void")


def unknown_rules(ids: DataFrame, catalog: DataFrame) -> DataFrame:
    return ids.select("rule_id").distinct().join(catalog, "rule_id", "left_anti")


def forms(text: str | None) -> list[str]:
    """What a field may stand for: itself and its list elements, trimmed and folded, as they are or decoded, and the
    addresses among them in canonical form."""
    parts = [p for t in decoded(text or "") for p in (t, *t.split(","))]
    return sorted({p.strip().lower() for p in parts} | {ip for ip in map(plain_address, parts) if ip})


def carries_managed(headers: DataFrame, managed: DataFrame) -> DataFrame:
    """(id, carried): requests with a managed header of which the field or a list element is a managed value after
    trimming and folding, as it is or after up to three rounds of decoding; an address counts in any form.
    headers: (id, name, value); managed: (name, value). Fields of other names are never read; different fields
    are read once, and only those that may hold escapes or addresses leave the JVM."""
    importable(headers.sparkSession)

    @F.pandas_udf("array<string>")
    def each(s: pd.Series) -> pd.Series:
        return s.map(forms)

    @F.pandas_udf("array<string>")
    def addresses(s: pd.Series) -> pd.Series:
        return s.map(lambda v: [ip for ip in map(plain_address, v.split(",")) if ip])

    own = managed.select(F.lower("name").alias("name"), "value").where("trim(value) <> ''")
    fields = headers.select(F.lower("name").alias("name"), "value").distinct().join(own.select("name").distinct(), "name", "left_semi")
    odd = F.col("value").rlike(r"[%+&]|^[\s0-9A-Fa-f:.,]*$")
    plain = F.transform(F.concat(F.array("value"), F.split("value", ",")), lambda v: F.lower(F.trim(v)))
    seen = fields.where(~odd).select("name", "value", F.explode(plain).alias("form")).unionByName(
        fields.where(odd).select("name", "value", F.explode(each("value")).alias("form")))
    # a value managed under any name counts, once the field's own name is managed
    keys = own.select(F.explode(F.concat(F.array(F.lower(F.trim("value"))), addresses("value"))).alias("form")).distinct()
    hits = seen.join(keys, "form", "left_semi").select("name", "value").distinct()
    ids = headers.select("id", F.lower("name").alias("name"), "value").join(hits, ["name", "value"], "left_semi").select("id").distinct().withColumn("carried", F.lit(True))
    return headers.select("id").distinct().join(ids, "id", "left").withColumn("carried", F.coalesce("carried", F.lit(False)))
