"""The queries over whole tables, and each stage of the pipeline, against plain versions written apart from the operators."""

import base64
import hashlib
import math
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import xxhash
from conftest import SF
from pyspark.sql import functions as F
from test_llm import brute_fingerprint, edits, line, plain_groups, plain_line_dedup
from tokenizers import Tokenizer

import corpus_pipeline
from edgelens.llm import queries, simhash

QUERIES = queries.queries()


def documents(spark, folder=SF):
    return spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()


BOTH = pytest.mark.parametrize("folder", [SF, "/root/testdata/sf0.01"])


@BOTH
def test_op1_of_all_documents(spark, folder):
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    got = {r.doc_id: r for r in QUERIES["op1_bpe_codec"](spark, folder).collect()}
    for d in documents(spark, folder):
        ids = t.encode(d.text or "", add_special_tokens=False).ids
        want = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        assert (got[d.doc_id].ids_sha256, got[d.doc_id].decoded_sha256, got[d.doc_id].n_tokens) == (*want, len(ids))


@BOTH
def test_op4_of_all_documents(spark, folder):
    import zlib

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got, start = {r.doc_id: r for r in QUERIES["op4_token_file"](spark, folder).collect()}, 0
    for d in documents(spark, folder):
        ids = np.array(t.encode(d.text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        assert (got[d.doc_id].start, got[d.doc_id].n_tokens, got[d.doc_id].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


class PlainLanguage:
    """Nearest of four centroids a language, from dictionaries of hashed byte grams."""

    def __init__(self, rows):
        taught = [(d.doc_id, d.lang, self.grams(d.text or ""), d.text or "") for d in rows if d.lang is not None]
        seen = Counter(g for _, _, c, _ in taught for g in c)
        self.idf = {g: math.log((1 + len(taught)) / (1 + n)) + 1 for g, n in seen.items()}
        self.unseen, self.centroids, self.floor = math.log(1 + len(taught)) + 1, [], {}
        for lang in sorted({x[1] for x in taught}):
            own = sorted((x for x in taught if x[1] == lang), key=lambda x: (xxhash.xxh64_intdigest(int(x[0]).to_bytes(8, "little"), 42) + 2**63) % 2**64)[:256]
            v = [self.unit(c) for _, _, c, text in sorted(own, key=lambda x: x[0]) if any(ch.isalpha() for ch in text)]
            picked = [0]
            while len(picked) < min(4, len(v)):
                picked.append(min(range(len(v)), key=lambda i: max(self.dot(v[i], v[p]) for p in picked)))
            c = [v[p] for p in picked]
            for _ in range(12):
                near = [max(range(len(c)), key=lambda k: self.dot(x, c[k])) for x in v]
                for k in range(len(c)):
                    total = Counter()
                    for x, n in zip(v, near):
                        if n == k:
                            total.update(x)
                    c[k] = self.scaled(total) if total else c[k]
            self.centroids += [(lang, x) for x in c]
            self.floor[lang] = 0.5 * float(np.quantile([max(self.dot(x, y) for y in c) for x in v], 0.01))

    @staticmethod
    def grams(text):
        b = bytes([x if x > 127 or chr(x).isalpha() else 32 for x in text.lower().encode()])
        b = b" " + b + b" "
        bucket = lambda g, bits: int.from_bytes(g, "big") * 2654435761 % 2**32 >> 32 - bits
        return Counter([("two", bucket(b[i : i + 2], 11)) for i in range(len(b) - 1)] + [("three", bucket(b[i : i + 3], 12)) for i in range(len(b) - 2)])

    @staticmethod
    def dot(a, b):
        return sum(w * b.get(g, 0.0) for g, w in a.items())

    @staticmethod
    def scaled(v):
        n = math.sqrt(sum(x * x for x in v.values()))
        return {g: x / n for g, x in v.items()}

    def unit(self, counts):
        return self.scaled({g: math.log1p(n) * self.idf.get(g, self.unseen) for g, n in counts.items()})

    def predict(self, text):
        """(language, score, rejected)"""
        if not any(c.isalpha() for c in text or ""):
            return "und", 0.0, True
        v = self.unit(self.grams(text))
        score, lang = max(((self.dot(v, c), lang) for lang, c in self.centroids), key=lambda x: x[0])
        return lang, score, score < self.floor[lang]


def test_op5_against_a_plain_classifier(spark):
    import zlib

    rows = documents(spark)
    model = PlainLanguage([d for d in rows if zlib.crc32(str(d.doc_id).encode()) % 5])
    got = {r.doc_id: r for r in QUERIES["op5_language"](spark, SF).collect()}
    for d in rows:
        lang, score, rejected = model.predict(d.text)
        assert got[d.doc_id].lang_pred == lang and got[d.doc_id].score == pytest.approx(score, abs=2e-4) and got[d.doc_id].rejected == rejected


@BOTH
def test_op6_against_sums_and_true_likeness(spark, folder):
    rows = documents(spark, folder)
    got = {r.doc_id: r for r in QUERIES["op6_multiset_fingerprint"](spark, folder).collect()}

    def lanes(text):
        total = [0] * 32
        for p in text.split("\n"):
            h = hashlib.shake_128(p.encode()).digest(128)
            total = [(a + int.from_bytes(h[4 * i : 4 * i + 4], "little")) % 2**32 for i, a in enumerate(total)]
        return total

    def grams(text):
        raw = [p.encode() for p in text.split("\n")]
        return Counter(p[i : i + 16] for p in raw if p for i in range(max(1, len(p) - 15)))

    def likeness(a, b):
        x, y = grams(a), grams(b)
        return sum(n * y[g] for g, n in x.items()) / math.sqrt(sum(n * n for n in x.values()) * sum(n * n for n in y.values()) or 1)

    off = []
    for d, after in zip(rows, rows[1:] + rows[:1]):
        text, other, r = d.text or "", after.text or "", got[d.doc_id]
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        for fp, t in ((r.fingerprint, text), (r.edited_fingerprint, edited)):
            assert np.frombuffer(base64.b64decode(fp), dtype="<u4")[:32].tolist() == lanes(t)
        if text and edited and other:
            off += [r.near_edited - likeness(text, edited), r.near_next - likeness(text, other)]
    assert max(map(abs, off)) < 0.3 and np.sqrt(np.mean(np.square(off))) < 0.08


def test_op8_of_all_documents(spark):
    folder = "/root/testdata/sf0.01"
    rows = documents(spark, folder)
    fps = [brute_fingerprint(d.text) for d in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    bits = np.array(fps, dtype=np.uint64)
    for i, j in np.argwhere(np.bitwise_count(bits[:, None] ^ bits[None, :]) <= 2):
        a, b = sorted((find(i), find(j)))
        root[b] = a
    got = {r.doc_id: r for r in QUERIES["op8_simhash_groups"](spark, folder).collect()}
    for i, d in enumerate(rows):
        assert (got[d.doc_id].fingerprint, got[d.doc_id].component_id) == (f"{fps[i]:016x}", rows[find(i)].doc_id)
    assert len({find(i) for i in range(len(rows))}) < len(rows)


def test_components_of_a_long_chain_in_random_order(spark):
    names = np.random.default_rng(6).permutation(4000).tolist()
    edges = [(names[i], names[i + 1]) for i in range(3999) if i != 2000]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    low, high = min(names[:2001]), min(names[2001:])
    assert got == {n: low for n in names[:2001] if n != low} | {n: high for n in names[2001:] if n != high}


def test_near_duplicates_edges(spark):
    schema = "doc_id long, text string, Component string"
    rows = [(1, "a b c d", "x"), (1, "a b c d", "x"), (None, "A b C d", "y"), (2, None, "z"), (3, "", "z"), (4, "word " * 50_000, "l")]
    got = sorted([(r.doc_id, r.component) for r in simhash.near_duplicates(spark.createDataFrame(rows, schema)).collect()], key=str)
    assert got == sorted([(1, 1), (1, 1), (None, 1), (2, 2), (3, 2), (4, 4)], key=str)
    assert simhash.near_duplicates(spark.createDataFrame([], schema)).count() == 0 == simhash.similar_documents(spark.createDataFrame([], schema)).count()


def plain_copies(doc_id, source, mean, seed):
    u = int(hashlib.md5(f"{seed}|{doc_id}|{source or ''}".encode()).hexdigest()[:13], 16) / 2**52
    n, p, c = 0, math.exp(-mean), math.exp(-mean)
    while c <= u:
        n += 1
        p *= mean / n
        c += p
    return n


def test_each_stage_of_the_pipeline(spark):
    """Every stage on its predecessor's rows: documents of the table, edited copies, odd and null texts and sources."""
    base = documents(spark)
    extra = [t for i in range(3) for t in edits(i)] + [None, "", "1 2 3", "ok", "Ok ok", line(1, 200) + "\n" + line(2, 60), line(3, 30) + "\n" + line(2, 60)]
    rows = [(d.doc_id, d.text, d.lang, d.source, d.n_chars) for d in base]
    rows += [(10_000 + i, t, None, [None, "rare", "src0"][i % 3], len(t or "")) for i, t in enumerate(extra)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).withColumn("Text", F.col("text"))
    stages, seen = dict(corpus_pipeline.STAGES), {}
    assert list(stages) == ["language_id", "line_dedup", "near_dedup", "mix", "tokenize"]
    for name, f in stages.items():
        docs = f(spark, docs, SF).persist()
        seen[name] = sorted(docs.collect(), key=lambda r: r.doc_id)
    model = PlainLanguage(base)
    assert [r.doc_id for r in seen["language_id"]] == sorted(i for i, t, *_ in rows if not model.predict(t)[2])
    before = seen["language_id"]
    assert [(r.doc_id, r.text, r.n_chars) for r in seen["line_dedup"]] == [(r.doc_id, t, len(t)) for r, t in zip(before, plain_line_dedup([r.text for r in before]))]
    before = seen["line_dedup"]
    root = plain_groups([r.text for r in before])
    assert seen["near_dedup"] == [r for i, r in enumerate(before) if root[i] == i] and len(seen["near_dedup"]) < len(before)
    before = seen["near_dedup"]
    size, weight = Counter(r.source or "" for r in before), {"src0": 0.5, "src1": 2.0}
    whole = sum(weight.get(s, 1.0) for s in size)
    mean = {s: weight.get(s, 1.0) * len(before) / whole / n for s, n in size.items()}
    want = [r for r in before for _ in range(plain_copies(r.doc_id, r.source, mean[r.source or ""], corpus_pipeline.MIX_SEED))]
    assert seen["mix"] == want
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    for r, x in zip(seen["tokenize"], want):
        ids = t.encode(x.text, add_special_tokens=False).ids
        assert (r.doc_id, list(r.token_ids), r.n_tokens) == (x.doc_id, ids, len(ids)) and r.decoded_sha256 == hashlib.sha256(t.decode(ids).encode()).hexdigest()
