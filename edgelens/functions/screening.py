"""Static requests that a firewall may skip: Catalyst expressions only.

Every test is a search for something that is not allowed, so that a long header costs one linear scan.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from edgelens.functions import columns as C

# Fixed values of the screen.
SQL_KEYWORDS = [
    "select", "union", "insert", "update", "delete", "drop", "truncate", "alter", "sleep", "pg_sleep", "benchmark", "waitfor",
    "exec", "execute", "declare", "having", "information_schema", "load_file", "outfile", "dumpfile", "xp_cmdshell",
]
INJECTION = r"[<\x00\r\n`]|\$\{|\(\)[ \t]*\{"
COOKIE_REFUSED = r"[^A-Za-z0-9_.~=:/+; -]|--|;(?! )|(?<!;) "
AGENT_REFUSED = r"[^A-Za-z0-9_.~=:/+,();?&! -]|--|(?i:/(?:bin|etc)/)"
REFERER_REFUSED = r"[^A-Za-z0-9_.~=:/+,();?&!-]|--|(?i:/(?:bin|etc)/)"
KEYWORD = r"(?i)(?<![A-Za-z_])(?:" + "|".join(SQL_KEYWORDS) + r")(?![A-Za-z_])"


def header_safe(name: Column, value: Column) -> Column:
    """Whether a header may pass unseen by the firewall; a null value may."""
    n = F.lower(name)
    strict = F.when(n == "transfer-encoding", value != "")
    for who, characters in (("cookie", COOKIE_REFUSED), ("user-agent", AGENT_REFUSED), ("referer", REFERER_REFUSED)):
        strict = strict.when(n == who, value.rlike(characters) | value.rlike(KEYWORD))
    refused = value.rlike(INJECTION) | strict.otherwise(False)
    return ~F.coalesce(refused, F.lit(False))


def skippable_static(method: Column, uri: Column, content_length: Column, headers: Column) -> Column:
    """A GET or HEAD without a body for a plain path of a static file with a plain query and safe headers.

    uri is the raw target; headers: array<struct<name, value>>. Only the last segment may hold a dot. Nulls in
    uri or method give false; an unknown length (null or below 0) is a body."""
    path, query = F.regexp_extract(uri, r"(?s)^([^?]*)", 1), F.regexp_extract(uri, r"(?s)\?(.*)", 1)
    plain = path.rlike(r"^/[A-Za-z0-9_.~/-]{1,256}\z") & ~path.rlike(r"\.\.|//|\.[^/]*/") & query.rlike(r"^[A-Za-z0-9_.=&-]{0,64}\z")
    ok = method.isin("GET", "HEAD") & (content_length == 0) & plain & C.is_static(path) & F.forall(headers, lambda h: header_safe(h["name"], h["value"]))
    return F.coalesce(ok, F.lit(False))
