"""Derived columns of requests: Catalyst expressions only."""

from __future__ import annotations

from http import HTTPStatus

from pyspark.sql import Column, functions as F

# Fixed values of the data model.
METHODS = ["GET", "POST", "PUT", "PATCH", "DELETE", "HEAD", "OPTIONS", "CONNECT", "TRACE"]
LATENCY_BOUNDS_US = [1_000, 2_000, 5_000, 10_000, 25_000, 50_000, 100_000, 250_000, 500_000, 1_000_000, 2_500_000, 5_000_000, 10_000_000, 30_000_000, 60_000_000]
CHALLENGE_SOURCES = ["automatic", "staff", "customer", "edge_sequence", "reputation", "unknown"]
STATIC_EXTENSIONS = [
    "css", "js", "mjs", "map", "png", "jpg", "jpeg", "gif", "webp", "avif", "svg", "ico", "bmp",
    "woff", "woff2", "ttf", "otf", "eot", "mp4", "webm", "mp3", "ogg", "wav", "m4a", "wasm",
]
COMPOSED_OUTCOMES = {
    "issued": ["document", "other"],
    "failed": ["token", "expired", "binding", "proof", "stale_difficulty", "replay", "render_cookie", "render_pixel", "render_dwell", "fallback_replay", "fallback_limit"],
    "passed_recently": ["fallback"],
}
NOT_SHOWN = ["api", "stream"]
SEVERITIES = ["EMERGENCY", "ALERT", "CRITICAL", "ERROR", "WARNING", "NOTICE", "INFO", "DEBUG"]
#: Reason phrases whose wording changed; the data model counts the older one.
OLDER_PHRASES = {413: "Request Entity Too Large", 414: "Request URI Too Long", 416: "Requested Range Not Satisfiable", 422: "Unprocessable Entity"}
FNV_HIGH, FNV_LOW, FNV_PRIME_LOW = 3421674724, 2216829733, 435

U32 = 0xFFFFFFFF


def minute(ts: Column) -> Column:
    """Floored to the UTC minute, without zone."""
    return F.date_trunc("minute", ts).cast("timestamp_ntz")


def day(ts: Column) -> Column:
    return F.date_trunc("day", ts).cast("timestamp_ntz")


def method(m: Column) -> Column:
    return F.when(m.isin(METHODS), m).otherwise("OTHER")


def u32(text: Column, default: int | None = None) -> Column:
    """Decimal text in the range of unsigned 32-bit integers."""
    n = F.when(text.rlike("^[0-9]{1,10}$"), text.try_cast("long"))
    n = F.when(n <= U32, n)
    return n if default is None else F.coalesce(n, F.lit(default).cast("long"))


def final_status(wrote: Column, written: Column, is_handler: Column, err_status: Column) -> Column:
    return F.when(wrote, written).when(is_handler & (err_status != 0), err_status).otherwise(200)


def block_reason(var: Column, is_handler: Column, message: Column, err_status: Column) -> Column:
    return (
        F.when(var != "", var).when(~is_handler, "").when(message.contains("interruption triggered"), "waf")
        .when(err_status == 429, "rate_limit").otherwise("")
    )


def origin(reason: Column, kind: Column, upstream: Column, is_handler: Column, retried: Column) -> Column:
    return (
        F.when(reason != "", "cluster_blocked").when(kind == "no_upstreams", "cluster_proxy_error")
        .when(F.coalesce(upstream, F.lit("")) == "", "cluster").when(~is_handler, "upstream")
        .when(retried, "upstream").when(kind == "local_response", "cluster").otherwise("cluster_proxy_error")
    )


def disposition(reason: Column, outcome: Column) -> Column:
    return (
        F.when(reason == "waf", "waf_blocked").when(reason == "rate_limit", "rate_limited")
        .when(outcome == "issued", "challenge_issued").when(outcome.isin("passed", "passed_fallback"), "challenge_passed")
        .when(outcome == "failed", "challenge_failed").when(outcome == "passed_recently", "challenge_passed_prior").otherwise("served")
    )


def country(c: Column) -> Column:
    return F.when(c.rlike("^[A-Za-z]{2}$"), F.upper(c)).otherwise("")


def latency_bucket(us: Column) -> Column:
    out = F.when(us < LATENCY_BOUNDS_US[0], 0)
    for i, bound in enumerate(LATENCY_BOUNDS_US[1:], 1):
        out = out.when(us < bound, i)
    return out.otherwise(len(LATENCY_BOUNDS_US))


def status_bucket(status: Column) -> Column:
    return F.when(status.between(100, 599), F.floor(status / 100)).otherwise(0).cast("int")


def http_version(major: Column, minor: Column) -> Column:
    return F.when(major == 2, "2").when(major == 3, "3").when((major == 1) & (minor == 1), "1.1").otherwise("other")


def byte_cap(text: Column, limit: int) -> Column:
    """The longest prefix of whole characters in at most limit bytes."""
    raw = F.encode(text, "UTF-8")

    def starts(n: int) -> Column:  # a character starts after n bytes
        return ~F.substring(F.hex(F.substring(raw, n + 1, 1)), 1, 1).isin("8", "9", "A", "B")

    end = F.lit(limit - 3)
    for n in (limit - 2, limit - 1, limit):
        end = F.when(starts(n), n).otherwise(end)
    return F.when(F.octet_length(text) <= limit, text).otherwise(F.decode(raw.substr(F.lit(1), end), "UTF-8"))


def bare_path(uri: Column) -> Column:
    return F.regexp_extract(uri, r"(?s)^([^?#]*)", 1)


def path_bucket(uri: Column) -> Column:
    """First three segments, those that look like ids as *."""

    def fold(s: Column) -> Column:
        dynamic = (
            (F.octet_length(s) > 64) | s.rlike("^[0-9]+$") | s.rlike("^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$")
            | ((F.octet_length(s) >= 8) & s.rlike("[A-Za-z]") & s.rlike("[0-9](?:[^0-9]*[0-9]){2}")) | s.rlike("[0-9][.-]|[.-][0-9]")
        )
        return F.when(dynamic, "*").otherwise(s)

    segments = F.slice(F.filter(F.split(F.lower(bare_path(uri)), "/"), lambda s: s != ""), 1, 3)
    return byte_cap(F.concat(F.lit("/"), F.array_join(F.transform(segments, fold), "/")), 128)


def front_proxy(cdn: list[Column], forwarded: list[Column]) -> Column:
    """By whichever kind of header field is there."""

    def there(fields: list[Column]) -> Column:
        return F.coalesce(*[F.nullif(f, F.lit("")) for f in fields], F.lit("")) != ""

    return F.when(there(cdn), "cloudflare").when(there(forwarded), "forwarded").otherwise("")


def hash_ip(xff: Column, remote: Column) -> Column:
    return F.when(F.coalesce(xff, F.lit("")) != "", F.trim(F.element_at(F.split(xff, ","), -1))).otherwise(remote)


def bytes_in(method_: Column, uri: Column, major: Column, minor: Column, lines: Column, length: Column) -> Column:
    """Request line, header lines (their bytes), blank line and body."""
    proto = F.length(F.concat(F.lit("HTTP/"), major.cast("string"), F.lit("."), minor.cast("string")))
    return (F.octet_length(method_) + F.octet_length(uri) + proto + 4 + lines + 2 + F.greatest(length, F.lit(0))).cast("long")


def bytes_out(wrote: Column, hijacked: Column, status: Column, lines: Column, body: Column) -> Column:
    """Status line, header lines (their bytes), blank line and body; 0 where nothing was written or the connection was
    taken over."""
    phrase = F.lit(0)
    for code, text in sorted(({s.value: s.phrase for s in HTTPStatus} | OLDER_PHRASES).items()):
        phrase = F.when(status == code, len(text)).otherwise(phrase)
    return F.when(~wrote | hijacked, 0).otherwise(len("HTTP/1.1 ") + 3 + 1 + phrase + 2 + lines + 2 + body).cast("long")


def challenge_outcome(outcome: Column, reason: Column) -> Column:
    out = F.when((outcome == "failed") & reason.isin(NOT_SHOWN), F.concat(F.lit("not_shown_"), reason))
    for name, reasons in COMPOSED_OUTCOMES.items():
        out = out.when((outcome == name) & reason.isin(reasons), F.concat(outcome, F.lit("_"), reason))
    return out.otherwise(outcome)


def challenge_source(source: Column) -> Column:
    return F.when(F.coalesce(source, F.lit("")) == "", "").when(source.isin(CHALLENGE_SOURCES), source).otherwise("unknown")


def is_static(path: Column) -> Column:
    extension = F.lower(F.regexp_extract(F.element_at(F.split(path, "/"), -1), r"\.([^.]+)$", 1))
    return extension.isin(STATIC_EXTENSIONS)


def admission_class(method_: Column, path: Column, fetch_mode: Column, fetch_dest: Column, accept: Column, platform: tuple[str, ...] = ("/.well-known/acme-challenge/",)) -> Column:
    own = F.lit(False)
    for p in platform:
        own = own | path.startswith(p)
    read = method_.isin("GET", "HEAD")
    page = (F.coalesce(fetch_mode, F.lit("")) == "navigate") | (F.coalesce(fetch_dest, F.lit("")) == "document") | F.coalesce(accept, F.lit("")).startswith("text/html")
    return F.when(own | (path == "/healthy"), "P0").when(read & page, "P1").when(read & is_static(path), "P3").otherwise("P2")


def failure_reason(kind: Column, origin_: Column, status: Column, wrote: Column, cancelled: Column, staged: Column) -> Column:
    """Why a proxy error without an answer happened; what staged evidence says comes before write errors."""
    names = {
        "no_upstreams": "no_upstreams_available", "certificate": "tls_certificate_error", "dns_timeout": "dns_timeout", "dns": "dns_error",
        "reset": "connection_reset", "eof": "upstream_eof", "header_timeout": "response_header_timeout",
        "write_timeout": "request_write_timeout", "write": "request_write_error",
    }
    out = F.when((origin_ != "cluster_proxy_error") | ~status.between(500, 599) | wrote | cancelled, "")
    for k, name in names.items():
        if k.startswith("write"):
            out = out.when(staged.isNotNull(), staged)
        out = out.when(kind == k, name)
    return out.otherwise("unknown")


def staged_reason(evidence: Column, message: Column, connections: Column) -> Column:
    """The vote of staged evidence: array<struct<message, reason, connections>>; null if none speaks."""
    fits = F.filter(
        evidence,
        lambda e: F.when(message == "", e["connections"] == connections).otherwise(
            (e["message"] == message) | message.endswith(F.concat(F.lit(": "), e["message"]))
        ),
    )
    reasons = F.array_distinct(F.transform(fits, lambda e: e["reason"]))
    return F.when(F.size(reasons) == 1, reasons[0]).when(F.size(reasons) > 1, "unknown")


def fnv64(text: Column) -> Column:
    """FNV-1a of the UTF-8 bytes, as decimal(20,0); in two 32-bit limbs, since bigint overflow raises."""
    each = F.split(F.decode(F.encode(text, "UTF-8"), "ISO-8859-1"), "")  # a character for each byte, and one empty for no bytes

    def step(s: Column, c: Column) -> Column:
        x = s["lo"].bitwiseXOR(F.ascii(c).cast("long"))
        low = x * FNV_PRIME_LOW
        high = s["hi"] * FNV_PRIME_LOW + x * 256 + F.shiftrightunsigned(low, 32)
        new = F.struct(high.bitwiseAND(U32).alias("hi"), low.bitwiseAND(U32).alias("lo"))
        return F.when(c == "", s).otherwise(new)

    start = F.struct(F.lit(FNV_HIGH).cast("long").alias("hi"), F.lit(FNV_LOW).cast("long").alias("lo"))
    h = F.aggregate(each, start, step)
    return (h["hi"].cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(11,0)") + h["lo"].cast("decimal(20,0)")).cast("decimal(20,0)")


def client_hash(ip: Column, ua: Column, salt: str) -> Column:
    sep = F.lit("\x1f")
    return fnv64(F.concat(ip, sep, ua, sep, F.lit(salt)))


def severity_label(s: Column) -> Column:
    out = F.when(s == 0, SEVERITIES[0])
    for i, name in enumerate(SEVERITIES[1:], 1):
        out = out.when(s == i, name)
    return out.otherwise("UNKNOWN")
