"""Operators 11 to 13 against brute force, and their stated edge cases. Their SQL twins run in test_llm.py."""

import hashlib
import math
import random
import re

import numpy as np
from conftest import SF
from pyspark.sql import functions as F

import corpus_pipeline
from edgelens.llm import codes, language, mixing, negatives, queries, simhash, substrings, tokenfile, topk, url_filter

QUERIES = queries.queries()
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


# 13 --------------------------------------------------------------------------------------------


def plain_substrings(rows, window):
    """rows: (id, text); for each (kept text, words, words taken out)."""
    first, split = {}, []
    for own, text in rows:
        words = WORDS.findall((text or "").encode())
        split.append(words)
        for i in range(len(words) - window + 1 if own is not None else 0):
            key = tuple(words[i : i + window])
            first[key] = min(own, first.get(key, own))
    out = []
    for (own, text), words in zip(rows, split):
        gone = [False] * len(words)
        for i in range(len(words) - window + 1 if own is not None else 0):
            if first[tuple(words[i : i + window])] < own:
                gone[i : i + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone) if not g).decode()
        out.append((own, None if text is None else kept, len(words), sum(gone)))
    return out


def test_op13_of_all_documents(spark):
    for folder in (SF, "/root/testdata/sf0.01"):
        rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
        want = sorted((i, n, gone, hashlib.sha256((t or "").encode()).hexdigest()) for i, t, n, gone in plain_substrings(rows, 50))
        assert sorted(map(tuple, QUERIES["op13_substring_dedup"](spark, folder).select("doc_id", "n_words", "n_removed", "kept_sha256").collect())) == want
        assert sum(w[2] for w in want) > 0


def test_substrings_of_random_passages(spark):
    rnd = random.Random(13)
    passages = [" ".join(rnd.choice("ab cd é日 x y".split(" ")) + str(rnd.randrange(40)) for _ in range(rnd.randrange(5, 60))) for _ in range(12)]
    rows = []
    for i in range(150):
        text = rnd.choice([" ", "\n", "\t \r", "\x0b\x0c"]).join(rnd.choice(passages) if rnd.random() < 0.7 else f"own{rnd.random()}" for _ in range(rnd.randrange(6)))
        rows.append((rnd.choice([i, i, i, 7, None]), text))
    rows += [(200, None), (201, ""), (202, " \t "), (203, passages[0]), (203, passages[0]), (-5, passages[1] + " tail"), (204, "w " * 5000), (205, "w " * 3000)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, N_words string, more int")
    for window, gram in ((10, 5), (10, 10), (3, 1)):
        out = substrings.dedup_substrings(docs, window, gram)
        assert out.columns == ["doc_id", "text", "more", "n_words", "n_removed"]
        key = lambda r: (r[0] is None, r[0] or 0, r[1] or "", r[2])
        got = sorted(((r.doc_id, r.text, r.n_words, r.n_removed) for r in out.collect()), key=key)
        assert got == sorted(plain_substrings(rows, window), key=key)
    assert substrings.dedup_substrings(docs.limit(0)).count() == 0


def test_substrings_in_small_pieces_and_a_full_sketch(spark, monkeypatch):
    rnd = random.Random(14)
    base = [f"w{rnd.randrange(300)}" for _ in range(400)]
    texts = [" ".join(base[a:b]) for a, b in ((0, 400), (30, 200), (100, 390), (0, 60))] + ["z" * 900 + " " + " ".join(base[50:150])]
    for text in texts:
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        whole = substrings.word_hashes(raw)
        monkeypatch.setattr(substrings, "PIECE", 64)
        cut = substrings.word_hashes(raw)
        monkeypatch.undo()
        short = np.array([len(w) <= 64 for w in text.split()])
        assert (whole[short] == cut[short]).all()
    # a sketch that lets everything through loses nothing and removes no more
    monkeypatch.setattr(substrings, "MAX_CELLS", 1 << 4)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(tuple(r) for r in substrings.dedup_substrings(docs).collect())
    assert got == sorted(plain_substrings(list(enumerate(texts)), 50))


# 11 --------------------------------------------------------------------------------------------


def plain_negatives(rows, anchors, positives=5, negatives_=3, least=50, most=95, scale=256):
    own = {}
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        cand = (label, tuple(math.floor(scale * float(np.float32(x))) for x in v))
        own[i] = min(own.get(i, cand), cand)
    out = set()
    for a in filter(anchors, own):
        score = {i: sum(x * y for x, y in zip(own[a][1], v)) for i, (_, v) in own.items() if i != a and len(v) == len(own[a][1])}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if own[i][0] == own[a][0]][:positives]:
            fit = [i for i in order if own[i][0] != own[a][0] and least * score[p] <= 100 * score[i] <= most * score[p]]
            out |= {(a, p, r, n, score[p], score[n]) for r, n in enumerate(fit[:negatives_], 1)}
    return out


def test_negatives_of_clusters_and_odd_rows(spark, monkeypatch):
    rnd = np.random.default_rng(11)
    centres = rnd.normal(size=(6, 8))
    rows = [(int(i), [float(x) for x in (centres[i % 6] + 0.3 * rnd.normal(size=8)) * rnd.choice([0.1, 1, 5])], int(i % 6 // 2)) for i in range(900)]
    rows += [(i, [1.0] * 8, 0) for i in range(900, 960)]  # ties
    rows += [(5, [9.0] * 8, 0), (5, [8.0] * 8, 0), (None, [1.0] * 8, 0), (961, None, 0), (962, [], 1), (963, [1.0] * 8, None), (964, [float("nan")] * 8, 1)]
    rows += [(965, [None] + [1.0] * 7, 1), (966, [float("inf")] * 8, 1), (967, [0.0] * 8, 2), (970, [1.0, 2.0], 2), (980, [1e30] * 8, 1), (990, [2.0, 1.0], 1), (995, [2.0, 2.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    want = plain_negatives([r for r in rows if r[0] != 980], lambda i: i % 10 == 0)
    for size in (4096, 60):
        monkeypatch.setattr(negatives, "BUCKET_ROWS", size)
        got = negatives.hard_negatives(df.withColumn("Score", F.lit("x")), F.col("id") % 10 == 0)
        assert {tuple(r) for r in got.collect()} == want and len(want) > 500
    assert negatives.hard_negatives(df.limit(0), F.col("id") % 10 == 0).count() == 0


def test_negatives_send_nothing_whole_to_the_driver(spark, monkeypatch):
    rnd = np.random.default_rng(12)
    df = spark.createDataFrame([(i, [float(x) for x in rnd.normal(size=8)], i % 3) for i in range(400)], "vec_id long, embedding array<float>, label int")
    plans, taken = [], negatives.stage

    def watched(rows, name):
        plans.append((name, rows._jdf.queryExecution().executedPlan().toString()))
        return taken(rows, name)

    monkeypatch.setattr(negatives, "stage", watched)
    monkeypatch.setattr(negatives, "BUCKET_ROWS", 60)
    out = negatives.hard_negatives(df, F.col("id") % 10 == 0)
    plans.append(("result", out._jdf.queryExecution().executedPlan().toString()))
    assert not [name for name, plan in plans if "Broadcast" in plan] and sum("SortMergeJoin" in plan for _, plan in plans) == 4
    assert out.count() > 100


def test_coordinate_lists_prune_and_lose_nothing():
    rnd = np.random.default_rng(12)
    centres = rnd.normal(size=(40, 16))
    x = centres[rnd.integers(0, 40, 3000)] + 0.05 * rnd.normal(size=(3000, 16))
    v = np.floor(4096 * x / np.linalg.norm(x, axis=1)[:, None]).astype(np.int64)  # a bucket's rows are of like length
    b = negatives.Bucket(np.arange(3000), np.zeros(3000, np.int64), v, negatives.sorted_lists(v))
    q = v[:200]
    exact = q @ v.T
    least = np.sort(exact, axis=1)[:, -20]
    may = negatives.candidates(b, q, least, 5)
    assert (may >= (exact >= least[:, None])).all()
    assert may.mean() < 0.1


# 12 --------------------------------------------------------------------------------------------


def plain_codes(rows, parts, entries, rounds, scale):
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    kept = [r for r in kept if len(r[1]) % parts == 0]
    width = len(min(kept, key=order)[1]) // parts if kept else 1
    kept = sorted((r for r in kept if len(r[1]) == width * parts), key=order)
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for step in range(rounds + 1):
        near = [[min(range(len(books[p])), key=lambda e: (apart(c[p], books[p][e]), e)) for p in range(parts)] for c in cut]
        if step == rounds:
            break
        for p in range(parts):
            for e in range(len(books[p])):
                own = [c[p] for c, n in zip(cut, near) if n[p] == e]
                books[p][e] = [sum(x) // len(own) for x in zip(*own)] if own else books[p][e]
    return sorted(((i, n, sum(apart(c[p], books[p][n[p]]) for p in range(parts))) for (i, _), c, n in zip(kept, cut, near)), key=repr), books


def test_codes_equal_plain_k_means(spark):
    rnd = np.random.default_rng(15)
    centres = rnd.normal(size=(9, 8))
    rows = [(int(i), [float(x) for x in centres[rnd.integers(9)] + rnd.choice([0.01, 0.5]) * rnd.normal(size=8)]) for i in rnd.permutation(400)]
    rows += [(7, [0.5] * 8)] * 3 + [(None, [0.5] * 8), (500, None), (501, []), (502, [float("nan")] * 8), (503, [None] * 8), (504, [1.0] * 4), (505, [1.0] * 7), (-3, [2.0, 1.0, 3.0])]
    df = spark.createDataFrame([(i, v, "c") for i, v in rows], "vec_id long, embedding array<float>, Code string")
    for parts, entries, rounds in ((4, 20, 4), (2, 256, 2), (1, 3, 5), (8, 1, 1)):
        out, books = codes.compress(df, ["vec_id", "Code"], parts, entries, rounds, 64)
        want, plain = plain_codes(rows, parts, entries, rounds, 64)
        assert out.columns == ["vec_id", "code", "error"]
        assert sorted(((r.vec_id, r.code, r.error) for r in out.collect()), key=repr) == want and [b.tolist() for b in books] == plain
    empty, books = codes.compress(df.limit(0), ["vec_id"])
    assert empty.count() == 0 and codes.digest(books) == hashlib.sha256(b"").hexdigest()
    far, _ = codes.compress(spark.createDataFrame([(1, [1e30] * 4), (2, [1e5] * 4), (3, [-1e5] * 4)], "vec_id long, embedding array<double>"), ["vec_id"])
    assert sorted((r.vec_id, r.error) for r in far.collect()) == [(2, 0), (3, 0)]


def test_balls_spare_work_and_change_nothing():
    rnd = np.random.default_rng(16)
    centres = rnd.integers(-4000, 4000, size=(64, 16))
    x = centres[rnd.integers(0, 64, 5000)] + rnd.integers(-60, 60, size=(5000, 16))
    book = codes.Book(centres + rnd.integers(-5, 5, size=(64, 16)))
    code, d = book.first(x)
    book = codes.Book(book.entries + rnd.integers(-5, 5, size=(64, 16)))
    again, d2 = book.again(x, code)
    want, want_d = book.first(x)
    assert (again == want).all() and (d2 == want_d).all()
    assert book.kept > 4000 and book.compared < 0.1 * x.shape[0] * 64
    wild = rnd.integers(0, 64, 5000)  # from any assignment
    again, d2 = book.again(x, wild)
    assert (again == want).all() and (d2 == want_d).all()
    ties = codes.Book(np.array([[0, 0], [2, 0], [0, 0], [2, 0]]))
    assert ties.again(np.array([[1, 0], [0, 0], [2, 0]]), np.array([3, 2, 3]))[0].tolist() == [0, 0, 1]


# earlier operators: rows that share their ids ---------------------------------------------------------


def test_mixing_of_null_and_repeated_ids(spark):
    rows = [(None, "s", "same")] * 6000 + [(7, "s", f"t{i}") for i in range(2000)] + [(i, "s", "x") for i in range(100, 2100)] + [(1, None, "n")] * 300 + [(1, "", "n")] * 300
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    out = mixing.mix(df, {"s": 10.0, None: 1.0, "": 0.0}, target=20_000)
    got = out.groupBy("doc_id", "source").count().collect()
    n = {(r.doc_id, r.source): r["count"] for r in got}
    # 10 / 11 of 20,000 over 10,000 rows of s, 1 / 11 over 300 of null, none of the empty source
    assert abs(n[(None, "s")] - 10909) < 500 and abs(n[(7, "s")] - 3636) < 300 and abs(n[(1, None)] - 1818) < 200 and (1, "") not in n
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spread = out.where("doc_id is null").groupBy(F.spark_partition_id()).count().collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(spread) > 1 and max(r["count"] for r in spread) < 0.6 * n[(None, "s")]
    key = lambda d: sorted(map(tuple, d.select("doc_id", "source", "text", "copy").collect()), key=repr)
    assert key(out) == key(mixing.mix(df.repartition(3), {"s": 10.0, None: 1.0, "": 0.0}, target=20_000))
    apart = {r["copy"] for r in out.where("doc_id = 7").collect()}
    assert {0, 1, 2} <= apart


def test_language_sample_of_null_and_repeated_ids(spark, monkeypatch):
    words = {"aa": "brumal corvid dulcet", "bb": "xyzzy quokka zax", "cc": "ñandú año niño"}
    rows = [(None, lang, f"{t} {t} {i}") for lang, t in words.items() for i in range(40)] + [(1, "aa", words["aa"])] * 3000
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(4)
    seen = []
    stacked = language.vectors
    monkeypatch.setattr(language, "SAMPLE_PER_LANGUAGE", 20)
    model = language.train(df)
    assert stacked is language.vectors and model["langs"] == ["aa", "bb", "cc"] and not seen
    out = language.predict(df.select("doc_id", "lang", "text").withColumn("Lang_pred", F.lit("x")), model)
    assert out.where("lang_pred <> lang").count() == 0 and out.count() == len(rows)
    keyed = df.select("*", language.row_key("doc_id", "text").alias("key"))
    assert keyed.where("lang = 'aa'").select("key").distinct().count() == 41
    assert language.train(df.limit(0)) is None
    assert {r.lang_pred for r in language.predict(df, None).collect()} == {"und"}
    long = spark.createDataFrame([(5, None, (words["bb"] + " ") * 20000), (6, "aa", ""), (7, "bb", None)], "doc_id long, lang string, text string")
    assert [r.lang_pred for r in language.predict(long, model).orderBy("doc_id").collect()] == ["bb", "und", "und"]


def test_top_k_of_repeated_ids_lengths_and_huge_components(spark, monkeypatch):
    rnd = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rnd.integers(-9, 9, size=6)]) for i in range(200)] + [(3, [-20.0] * 6), (300, [1.0, 2.0]), (320, [3.0, 1.0]), (340, [1e30] * 6), (360, [3e8] * 6), (380, [1.0] * 5 + [float("nan")])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    own = {}
    for i, v in rows:
        if i not in (340, 360, 380):
            q = tuple(math.floor(64 * x) for x in v)
            own[i] = min(q, own.get(i, q))
    want = set()
    for a in (i for i in own if i % 20 == 0):
        score = {i: sum(x * y for x, y in zip(own[a], v)) for i, v in own.items() if i != a and len(v) == len(own[a])}
        want |= {(a, r, i, score[i]) for r, i in enumerate(sorted(score, key=lambda i: (-score[i], i))[:7], 1)}
    for size in (1 << 22, 480):  # 480 bytes: blocks of ten vectors
        monkeypatch.setattr(topk, "BLOCK_BYTES", size)
        assert {tuple(r) for r in topk.top_k(df, F.col("id") % 20 == 0, k=7).collect()} == want


def boilerplate(n, rnd, copies=4):
    """Texts that share 120 of 200 words, and similar copies of a few of them."""
    shared = [f"b{rnd.randrange(10**6)}" for _ in range(120)]
    texts = [" ".join(shared + [f"o{rnd.randrange(10**6)}" for _ in range(80)]) for _ in range(n)]
    for i in range(0, 40 * copies, 40):
        words = texts[i].split()
        texts.append(" ".join(words[:-6]))
        texts.append(" ".join(words[:150] + ["x", "y", "z"] + words[150:]))
    return texts


def test_wide_buckets_are_split_and_lose_no_similar_pair(spark, monkeypatch):
    work = {}
    taken = simhash.split

    def watched(parts, nodes):
        out = taken(parts, nodes)
        for name, rows in (("before", parts), ("after", out)):
            each = rows.groupBy("bucket").agg(F.sum(F.col("minor").cast("int")).alias("m"), F.count("*").alias("n"))
            work[name] = each.agg(F.sum(F.col("m") * F.col("n"))).first()[0]
        return out

    monkeypatch.setattr(simhash, "split", watched)
    monkeypatch.setattr(simhash, "SPLIT_MINORS", 16)
    cost = {}
    for n in (400, 800):
        texts = boilerplate(n, random.Random(1))
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        got = {r.doc_id: r.component for r in simhash.similar_documents(df).collect()}
        assert all(got[n + 2 * j] == got[n + 2 * j + 1] == got[40 * j] == 40 * j for j in range(4))
        assert len(set(got.values())) == n  # texts that share their boilerplate alone are not similar
        cost[n] = dict(work)
    assert cost[800]["after"] < 0.2 * cost[800]["before"]
    assert cost[800]["after"] <= 2.6 * cost[400]["after"] + 5000
    print(cost)


def test_joins_by_shuffle_give_what_broadcasts_give(spark, monkeypatch):
    rows = lambda name: sorted(map(str, QUERIES[name](spark, SF).collect()))
    want = {n: rows(n) for n in ("op9_poisson_mix", "op10_url_verdicts")}
    df = spark.createDataFrame([(i // 3, ["a", None, ""][i % 3], "t") for i in range(900)] * 2, "doc_id long, source string, text string")
    mixed = lambda: sorted(map(str, mixing.mix(df, {"a": 3.0}).collect()))
    twins = mixed()
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    monkeypatch.setattr(mixing, "BROADCAST_TWINS", 0)
    monkeypatch.setattr(url_filter, "MAX_FILTER_BLOCKS", 0)
    assert {n: rows(n) for n in want} == want and mixed() == twins


def test_token_files_of_null_and_repeated_ids(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    rows = [(3, "b b"), (None, "n"), (3, "a a a"), (3, "b b"), (None, None), (1, "é" * 3000)]
    out = tokenfile.new_path(spark)
    tokenfile.write(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), path, out)
    got = sorted(((r.doc_id, r.start, r.n_tokens) for r in tokenfile.digests(spark, out).collect()), key=lambda r: r[1])
    start, want = 0, []
    for i, text in sorted(((i, x or "") for i, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        n = len(t.encode(text, add_special_tokens=False).ids) + 1
        want.append((i, start, n))
        start += n
    assert got == want


def test_stages_of_empty_long_and_repeated_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    empty = spark.createDataFrame([], schema)
    for name, f in corpus_pipeline.STAGES:
        assert f(spark, empty, SF).count() == 0, name
    rnd = random.Random(3)
    word = lambda: rnd.choice("brumal corvid dulcet eidolon frangible gossamer halcyon ineffable".split()) + str(rnd.randrange(500))
    long = "\n".join(" ".join(word() for _ in range(30)) for _ in range(900))
    rows = [(1, long, "en", "s")] + [(2, "few words of a short text " + word(), "en", "s")] * 6 + [(None, " ".join(word() for _ in range(40)), "en", None) for _ in range(5)]
    docs = spark.createDataFrame([(*r, len(r[1])) for r in rows], schema)
    counts = []
    for name, f in corpus_pipeline.STAGES:
        docs = f(spark, docs, SF).persist()
        counts.append(docs.count())
        assert docs.where("doc_id = 1").count() >= (0 if name in ("mix", "tokenize") else 1)
    assert counts[:3] == [12, 12, 7]  # the six repeats are one document
