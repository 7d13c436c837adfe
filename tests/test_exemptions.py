import pytest
from pyspark.sql import functions as F

from edgelens.functions import screening
from edgelens.operators import exemptions, waf


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("name,text,want", [
    ("Cookie", "a=1; b=2", True), ("Cookie", "a=1;b=2", False), ("Cookie", "a=1; ", True), ("Cookie", "a=1;", False), ("Cookie", "a b", False), ("cookie", "a=%27", False),
    ("Cookie", "a--b", False), ("Cookie", "a=drop", False), ("Cookie", "a=drop_it", True), ("User-Agent", "Mozilla/5.0 (X11; rv:1)", True),
    ("User-Agent", "x /bin/sh", False), ("User-Agent", "x SELECT y", False), ("User-Agent", "reselect", True), ("User-Agent", "é", False), ("Referer", "https://a/b c", False),
    ("Referer", "https://a/b?c=d", True), ("X-Any", "() \t{ x", False), ("X-Any", "${jndi", False), ("X-Any", "a\nb", False), ("X-Any", "select 'x' --", True),
    ("Transfer-Encoding", "chunked", False), ("Transfer-Encoding", "", True), ("X-Any", None, True),
])
def test_header_screen(spark, name, text, want):
    assert value(spark, screening.header_safe(F.lit(name), F.lit(text).cast("string"))) is want


@pytest.mark.parametrize("uri,length,want", [
    ("/a.js", 0, True), ("/a.js", -1, False), ("/a.js", None, False), ("/a.js", 5, False), ("/d/a.JS?v=1", 0, True), ("/v1.2/a.js", 0, False), ("/a/../b.js", 0, False),
    ("//a.js", 0, False), ("/a%2e.js", 0, False), ("/a.js?x=%20", 0, False), ("/a.js?" + "x" * 65, 0, False), ("/" + "a" * 253 + ".js", 0, True), ("/" + "a" * 254 + ".js", 0, False),
    ("/a.js\n", 0, False), ("/a.js#f", 0, False), ("/a.txt", 0, False), (None, 0, False), ("", 0, False),
])
def test_skippable_static(spark, uri, length, want):
    headers = F.array(F.struct(F.lit("Accept").alias("name"), F.lit("*/*").alias("value")))
    got = screening.skippable_static(F.lit("GET"), F.lit(uri).cast("string"), F.lit(length).cast("long"), headers)
    assert value(spark, got) is want


def test_long_headers_do_not_overflow(spark):
    headers = F.array(F.struct(F.lit("Cookie").alias("name"), F.repeat(F.lit("a=1; "), 40_000).alias("value")))
    assert value(spark, screening.skippable_static(F.lit("GET"), F.lit("/a.js"), F.lit(0), headers))


@pytest.mark.parametrize("sets,want", [([], 0), (["core"], 0), (["EVIDENCE/2"], 2), (["EVIDENCE/2", "EVIDENCE/3"], -1), (["EVIDENCE/"], -1), (["HEADER-EXEMPT/1"], 0)])
def test_evidence_version(spark, sets, want):
    assert value(spark, exemptions.evidence_version(F.array(*map(F.lit, sets)).cast("array<string>"))) == want
    assert value(spark, exemptions.evidence_version(F.lit(None).cast("array<string>"))) == 0


def test_single_header(spark):
    rows = [({"A": ["x"]},), ({"a": ["x", "y"]},), ({"a": ["x"], "A": ["x"]},), ({"b": ["x"]},), ({"a": []},), (None,)]
    df = spark.createDataFrame(rows, "h map<string,array<string>>")
    assert [r.v for r in df.select(exemptions.single_header(F.col("h"), "a").alias("v")).collect()] == ["x", None, None, None, None, None]


def test_exempt_requests_of_missing_and_repeated_snapshots(spark):
    r = spark.createDataFrame([("a", "true"), ("b", "true"), ("c", None), (None, "true")], "request_uuid string, exempt_var string")
    s = spark.createDataFrame([("a", True), ("a", False), ("c", True), (None, True)], "request_uuid string, http boolean")
    got = lambda **k: {x.request_uuid: x.defense_exempt for x in exemptions.exempt_requests(r, s, **k).collect()}
    assert got(v2=True) == {"a": False, "b": False, "c": True, None: False}
    assert got(v2=False) == {"a": False, "b": True, "c": True, None: True}
    assert got(v2=False, telemetry=False) == {"a": False, "b": False, "c": True, None: False}


@pytest.mark.parametrize("text,want", [(" 1.2.3.4 ", "1.2.3.4"), ("1.2.3.4:80", None), ("::FFFF:1.2.3.4", "1.2.3.4"), ("2001:DB8:0::1", "2001:db8::1"), ("", None), (None, None)])
def test_parse_ip(text, want):
    assert exemptions.parse_ip(text) == want


@pytest.mark.parametrize("text,want", [("tok", True), (" TOK ", True), ("a, tok", True), ("xtok", False), ("t%6Fk", True), ("t%256Fk", True), ("0:0::1", True), ("", False), (None, False)])
def test_field_carries(text, want):
    assert exemptions.field_carries(text, {"tok"}, {"::1"}) is want


def test_masked_address():
    assert exemptions.masked_address(set()) == "100::" and exemptions.masked_address({"100::", "100::1"}) == "100::2"
