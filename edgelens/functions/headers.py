"""Header fields out of map<string, array<string>>: names in any case, each with one value or more. Catalyst only."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Fields that facts are derived from, by the column that holds their first value.
FIELDS = {
    "cdn_ip": "CF-Connecting-IP", "cdn_ray": "CF-Ray", "xff": "X-Forwarded-For", "real_ip": "X-Real-IP", "ua": "User-Agent", "accept": "Accept",
    "fetch_mode": "Sec-Fetch-Mode", "fetch_dest": "Sec-Fetch-Dest", "cookie": "Cookie", "referer": "Referer",
}


def folded(headers: Column) -> Column:
    """array<struct<name, values>> with names in lower case; of null, no fields. Select it before it is read more than once."""
    entries = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("name"), e["value"].alias("values")))
    return F.coalesce(entries, F.array().cast("array<struct<name:string,values:array<string>>>"))


def values_of(fields: Column, name: str) -> Column:
    """All values of a field, from folded()."""
    return F.array_compact(F.flatten(F.transform(F.filter(fields, lambda f: f["name"] == name.lower()), lambda f: F.coalesce(f["values"], F.array().cast("array<string>")))))


def first_of(fields: Column, name: str) -> Column:
    """The first value of a field; null where it is absent."""
    return F.get(values_of(fields, name), F.lit(0))


def wire_size(fields: Column) -> Column:
    """Bytes of all lines `name: value`, one for each value of each field, with their ends."""

    def lines(f: Column) -> Column:
        return F.aggregate(F.array_compact(f["values"]), F.lit(0).cast("long"), lambda n, v: n + F.octet_length(f["name"]) + F.octet_length(v) + 4)

    return F.aggregate(fields, F.lit(0).cast("long"), lambda n, f: n + F.coalesce(lines(f), F.lit(0).cast("long")))
