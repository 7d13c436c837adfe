"""Texts without a managed value are not traced, and give what tracing gives."""

import random

from conftest import SF
from pyspark.sql import functions as F

from edgelens.operators import managed as M
from edgelens.plans import queries as Q

PIECES = ["part", " ", "%20", "%2520", "+", "1234", "&amp;", "&", "\x00", "?", "/", "abc", "%61bc", "%u0061", "é", "10.0.0.7", "key-value", "KEY%2Dvalue", "&#107;ey-value", "%"]


def texts(n):
    rnd = random.Random(3)
    return ["".join(rnd.choice(PIECES) for _ in range(rnd.randrange(14))) for _ in range(n)]


def test_decodings_are_the_bytes_of_traced_rounds():
    for t in texts(3000):
        raw = t.encode()
        assert list(M.decodings(raw)) == [r.raw for r in M.rounds(raw)]


def test_found_is_what_traced_rounds_hold():
    m = M.Matcher(["part 1234", "abc", "key-value", "::ffff:10.0.0.7"])
    hits = 0
    for t in texts(3000):
        raw = t.encode()
        for tokens in (False, True):
            want = [(r.start[a], r.end[z - 1], v) for r in M.rounds(raw) for a, z, v in m.spans(r.raw, tokens)]
            assert list(m.found(raw, tokens)) == want
            hits += bool(want)
    assert hits > 300


def test_texts_without_values_are_not_traced(monkeypatch):
    monkeypatch.setattr(M, "rounds", None)
    m = M.Matcher(["part 1234 of", "abc"])
    targets = ["/a/part%20123?q=%2520", "/a/part+123?q=1", "/a?", "/a/%ab%c", ""]
    assert M.masked_targets(targets, m, [False] * 5, "*") == targets
    assert M.masked_targets(targets, m, [True] * 5, "*") == ["/a/part%20123?*", "/a/part+123?*", "/a?", "/a/%ab%c", ""]
    assert m.holding([b"xpart 1234 o", b"f", b"part+1234%20of", b"part%201234", b" of"]) == {2}  # nothing across texts


def test_targets_searched_together_are_masked_as_alone():
    rnd = random.Random(5)
    for values in (["part 1234", "abc", "key-value"], ["part 1234", "10.0.0.7"]):
        m = M.Matcher(values)
        some = texts(2000) + ["/" + "x%20" * 2000 + "abc"]
        carried = [rnd.random() < 0.3 for _ in some]
        for limit in (None, 40):
            assert M.masked_targets(some, m, carried, "*", limit) == [M.masked_target(t, m, c, "*", limit) for t, c in zip(some, carried)]


def test_part_targets_are_matched_once(spark, monkeypatch):
    sizes, taken = [], M.match_values

    def watched(rows, managed, text, out="managed"):
        sizes.append(rows.count())
        return taken(rows, managed, text, out)

    monkeypatch.setattr(M, "match_values", watched)
    lines = Q.j4_managed_values(spark, SF).count()
    assert sizes == [spark.read.parquet(f"{SF}/part.parquet").count()] and sizes[0] < lines / 10
