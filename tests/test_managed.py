"""Managed values: matching against brute force, and what redaction masks."""

import hashlib
import html
import random
import re

import pytest
from pyspark.sql import functions as F

from edgelens.operators import managed


@pytest.mark.parametrize("url,carried,want", [
    ("/a/secretvalue/b?x=1", False, "/a/[masked]/b?x=1"), ("/a/b?x=secret%56alue&y=2", False, "/a/b?[masked]&y=2"), ("/a/tok", False, "/a/tok"),
    ("/a/tok?q=1", True, "/a/[masked]?[masked]"), ("/secret/value", False, "/secret/value"),
    ("/a?", True, "/a?"), ("/a/tok.x", True, "/a/[masked]"), ("/a/tokx", True, "/a/tokx"), ("/a/xtok?", True, "/a/xtok?"), ("/h/::ffff:1.2.3.4/x", True, "/h/[masked]/x"), ("/h/1.2.3.4", False, "/h/1.2.3.4"),
    ("/x/a/b=c&d?e", False, "/[masked]?[masked]"), ("/x?y=a%2Fb%3Dc%26d%3Fe", False, "/x?[masked]"), ("/a%2Fb=c&d%3Fe/k", False, "/[masked]/k"), ("/x?a%2Fb=c&d?e&z", False, "/x?[masked]"),
])
def test_redaction_of_urls(url, carried, want):
    assert managed.masked_target(url, managed.Matcher(["SecretValue", "tok", "1.2.3.4", "a/b=c&d?e"]), carried, "[masked]") == want


def test_redaction_of_a_value_with_a_question_mark():
    cut = lambda u, values=("secret?value1",), carried=False: managed.masked_target(u, managed.Matcher(list(values)), carried, "[masked]")
    assert cut("/a/secret?value1&x=2") == "/a/[masked]?[masked]&x=2" and cut("/a/secret?value2&x=2") == "/a/secret?value2&x=2"
    assert cut("/a/b?x=secret%3Fvalue1") == "/a/b?[masked]" and cut("/b/secret?v&x=2", ["b/secret?v&x"]) == "/[masked]?[masked]"
    assert cut("/a/secret?value1&x=2", carried=True) == "/a/[masked]?[masked]"


def test_redaction_of_random_targets():
    """No value of eight bytes or more is left in any round of decoding; targets without one stay as they are."""
    rnd = random.Random(5)
    values = ["secret?value1", "tokenvalue", "a/b=c&d?e%f", "plus+and+more", "pässwörd99"]
    encode = [lambda c: c, lambda c: "".join(f"%{b:02X}" for b in c.encode()), lambda c: "".join(f"%25{b:02x}" for b in c.encode()), lambda c: f"&#{ord(c)};" if c.isalnum() else c]
    forms = [f.lower() for v in values for f in (v, v.replace("+", " "))]
    left = lambda t: any(v in r.lower() for r in managed.decoded(t) for v in forms)
    masked, matcher = 0, managed.Matcher(values)
    for _ in range(4000):
        parts = [rnd.choice(["/", "?", "&", "x", "seg", "=", "%", "+", "value1", "secret", "%3F"]) for _ in range(rnd.randrange(1, 9))]
        if rnd.random() < 0.6:
            f = rnd.choice(encode)
            parts.insert(rnd.randrange(len(parts)), "".join(rnd.choice([f, encode[0]])(c) for c in rnd.choice(values)))
        url = "/" + "".join(parts)
        for carried in (False, True):
            out = managed.masked_target(url, matcher, carried, "[masked]")
            assert not left(out), (url, out)
            if not carried and not left(url):
                assert out == url
            masked += out != url
    assert masked > 2000


def test_what_is_empty_or_unknown(spark):
    rows = [("/a?q", "m", None, True), ("", "", None, True), ("/a", "has secretvalue", False, True), ("/a", "m", False, True), ("/a?q", "m", True, True), ("", "", True, True), (None, None, False, True),
            ("/secretvalue/b?q", "m", False, False), ("/tok", "", False, False), ("/tok", "tok", False, None)]
    df = spark.createDataFrame(rows, "uri string, msg string, carried boolean, version boolean").withColumn("match_data", F.upper("msg"))
    own = spark.createDataFrame([("h", "SecretValue"), ("h", "tok"), ("h", " ")], "name string, value string")
    out = [(r.uri, r.msg, r.match_data) for r in managed.redact(df, own, known="version").collect()]
    k = "[masked]"
    assert out == [("/" + k, k, k), ("", "", ""), ("/a", k, k), ("/a", "m", "M"), ("/a?" + k, k, k), ("", "", ""), (None, None, None), (f"/{k}/b?{k}", k, k), ("/" + k, "", ""), ("/" + k, k, k)]
    assert managed.choose_marker(["masked"]) == "[*]" and managed.choose_marker(["masked", "*", "-"], managed.URL_MARKS) == ""
    assert [r.uri for r in managed.redact(df, own.limit(0)).where("carried = false").limit(1).collect()] == ["/a"]


def test_redaction_with_a_limit(spark):
    rows = [("/a/" + "b" * 40,), ("/secretvalue/" + "b" * 40,), ("/x/%20" + "b" * 9000,), ("/x?y&z=%20" + "b" * 9000,), ("/x/" + "b" * 9000 + "%20",), ("/a/b%20",)]
    df = spark.createDataFrame(rows, "uri string").withColumn("carried", F.lit(False))
    own = spark.createDataFrame([("h", "SecretValue")], "name string, value string")
    assert [r.uri for r in managed.redact(df, own, texts=(), limit=20).collect()] == ["/a/" + "b" * 17, "/[masked]/" + "b" * 10, "/x/[masked]", "/x?y&[masked]", "/x/" + "b" * 17, "/a/b%20"]


def plain_decoded(text):
    """A round a time, written apart from the traced one."""
    for _ in range(4):
        yield text
        raw = re.sub(rb"%[uU][0-9a-fA-F]{2}([0-9a-fA-F]{2})|%([0-9a-fA-F]{2})", lambda m: bytes([int(m[1] or m[2], 16)]), text.encode("latin-1").replace(b"+", b" "))
        text = html.unescape(raw.decode("latin-1")).replace("\0", "")


def test_matches_of_a_large_dictionary_equal_brute_force(spark):
    rnd = random.Random(9)
    values = sorted({"".join(rnd.choice("abXY-/+ ") for _ in range(rnd.randrange(6, 14))).strip() for _ in range(3000)})
    values = [v for v in values if v]
    encode = [lambda c: c, lambda c: f"%{ord(c):02x}", lambda c: f"%25{ord(c):02X}", lambda c: f"%u00{ord(c):02x}", lambda c: f"&#{ord(c)};"]
    texts = []
    for _ in range(300):
        f = rnd.choice(encode)
        texts.append("".join(rnd.choice([f, encode[0]])(c) for c in rnd.choice(values).upper()) + rnd.choice(["", "x", "-a"]) + "".join(rnd.choice("abxy") for _ in range(12)))
    texts += [None, ""]

    def plain(text):
        seen = [t.lower() for t in plain_decoded(text or "")]
        return sorted(v for v in values if len(v) >= 8 and any(w in t for t in seen for w in (v.lower(), v.lower().replace("+", " "))))

    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    own = spark.createDataFrame([("n", v) for v in values], "name string, value string")
    got = {r.i: r.managed for r in managed.match_values(df, own, "text").collect()}
    want = {i: plain(t) for i, t in enumerate(texts)}
    assert got == want and sum(map(bool, want.values())) > 200


def test_a_hundred_thousand_values_do_not_grow_the_plan(spark):
    own = spark.range(100_000).select(F.lit("n").alias("name"), F.concat(F.lit("managed-"), F.md5(F.col("id").cast("string"))).alias("value"))
    df = spark.range(3000).select("id", F.concat(F.lit("/x/MANAGED-"), F.upper(F.md5((F.col("id") * 50).cast("string"))), F.lit("%20")).alias("text"))
    large, small = (managed.match_values(df, d, "text") for d in (own, own.limit(3)))
    size = lambda d: len(d._jdf.queryExecution().optimizedPlan().toString())
    assert abs(size(large) - size(small)) < 100
    got = {r.id: r.managed for r in large.collect()}
    assert all((len(m) == 1 and m[0] == "managed-" + hashlib.md5(str(50 * i).encode()).hexdigest()) == (50 * i < 100_000) for i, m in got.items())
