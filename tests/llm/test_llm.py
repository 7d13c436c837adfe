"""The training-data operators against libraries, brute force and their stated edge cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import xxhash
from compare import same
from conftest import SF
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from edgelens.llm import bpe, chat, fingerprint, language, linededup, mixing, queries, simhash, tokenfile, topk, url_filter

DOCS = "doc_id long, text string, lang string, source string, n_chars long, Text_2 string"


def docs(spark, texts, **more):
    rows = [(i, t, more.get("lang", "en"), more.get("source", "s"), len(t or ""), "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    same(queries.queries()[name](spark, SF), duck, queries.oracle_sql()[name])


# 1 ---------------------------------------------------------------------------------------------

ODD = [None, "", " ", "The cat's  naïve 日本 x", "a<|endoftext|>B <|startoftext|>x", "ΑΣ Σ ΟΔΟΣ İ", "é x\x1cy", "12345 ½ don't I'LL", "same", "same", "ab" * 3000]


def test_bpe_equals_the_library(spark):
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    rnd = random.Random(1)
    texts = ODD + ["".join(rnd.choice("erinthon ") for _ in range(rnd.choice([3, 40, 2500]))) for _ in range(60)]
    out = {r.doc_id: r for r in bpe.encode_decode(docs(spark, texts).withColumn("token_ids", F.lit(1)), P.path("word_bpe_49k.json")).collect()}
    for i, x in enumerate(texts):
        want = t.encode(x or "", add_special_tokens=False).ids
        assert out[i].token_ids == want and out[i].decoded == t.decode(want, skip_special_tokens=False)
    assert bpe.encode_decode(docs(spark, ["a"]).limit(0), P.path("word_bpe_49k.json")).count() == 0


def test_bpe_streams_long_words_and_bytes():
    c = bpe.codec(P.path("word_bpe_49k.json"))
    rnd = random.Random(2)
    for alphabet in ("ab", "haha", "erinthon"):
        word = "".join(rnd.choice(alphabet) for _ in range(5000))
        ids = [c.inner[b] for b in word.encode()]
        ids[-1] = c.last[word.encode()[-1]]
        assert np.frombuffer(c.word(word), dtype=np.int32).tolist() == c.transducer.apply(ids)
        assert len(c.transducer.buffer) == 0
    d = bpe.Decoder.__new__(bpe.Decoder)
    import codecs

    d.bytes = codecs.getincrementaldecoder("utf-8")("replace")
    d.codec = type("C", (), {"raw": [bytes([b]) for b in "é日".encode()]})
    assert "".join(d.feed([i]) for i in range(5)) + d.finish() == "é日"


# 2 ---------------------------------------------------------------------------------------------


def test_top_k_brute_force_ties_and_bad_vectors(spark):
    rnd = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rnd.normal(size=4)]) for i in range(60)] + [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(60, 100)]
    rows += [(100, None), (120, [1.0, None, 0.0, 0.0]), (140, [float("nan")] * 4), (160, [float("inf")] * 4), (180, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_k(df, F.col("id") % 20 == 0, k=7).collect()}
    good = {i: np.floor(64 * np.array(v)).astype(int) for i, v in rows[:100]}
    for q in range(0, 100, 20):
        best = sorted((-int(good[q] @ v), i) for i, v in good.items() if i != q)[:7]
        assert [got[q, k + 1] for k in range(7)] == [(i, -s) for s, i in best]
    assert len(got) == 35
    few = topk.top_k(df.where("vec_id < 3"), F.col("id") % 20 == 0, k=7).collect()
    assert sorted(r.vec_id for r in few) == [1, 2] and topk.top_k(df.limit(0), F.col("id") == 0).count() == 0


# 3 ---------------------------------------------------------------------------------------------


def test_chat_trees_pick_branches_and_escape(spark):
    rows = [(1, 0, None, 0.0, "system", "[s]"), (1, 1, 0, 1.0, "user", "a\\b [/INST] </s>"), (1, 2, 1, 5.0, "assistant", "good \\l"), (1, 3, 1, 2.0, "assistant", "bad"), (1, 4, 2, 1.0, "tool[x]", None),
            (2, 9, 77, 0.0, "user", "orphan"), (2, 9, 77, 0.0, "user", "orphan")]
    df = spark.createDataFrame(rows, "conv long, msg long, parent long, score double, role string, text string")
    out = chat.format_chats(df, branches=2).withColumn("t", chat.parse_turns(F.col("formatted"))).withColumn("loss", chat.loss_text(F.col("t"), F.col("loss_spans")))
    got = {(r.conv, r.leaf): r for r in out.collect()}
    assert set(got) == {(1, 4), (1, 3), (2, 9)}
    assert [(t.role, t.text) for t in got[1, 4].t] == [("system", "[s]"), ("user", "a\\b [/INST] </s>"), ("assistant", "good \\l"), ("tool[x]", "")]
    assert got[1, 4].loss == "good \\l" and got[1, 3].loss == "bad" and got[2, 9].n_turns == 1 and got[2, 9].loss == ""
    assert chat.format_chats(df.limit(0)).count() == 0


def chat_turns(spark, rows, branches=1):
    df = spark.createDataFrame(rows, "conv long, msg long, parent long, score double, role string, text string")
    out = chat.format_chats(df, branches=branches).select("conv", "leaf", chat.parse_turns(F.col("formatted")).alias("t"))
    return {(r.conv, r.leaf): [(t.role, t.text) for t in r.t] for r in out.collect()}


def test_chat_odd_roles_and_texts_come_back(spark):
    odd = ["my ROLE x", "ROLE ", "", "INST", "ROLE INST", "a]b[c<d\\r", "\\", "x] [/INST", "user ", " [", "\\b\\l\\t\\r"]
    rows = [(c, i, i - 1 if i else None, 0.0, r, t) for c, t in enumerate(odd) for i, r in enumerate(odd)]
    assert chat_turns(spark, rows) == {(c, len(odd) - 1): [(r, t) for r in odd] for c, t in enumerate(odd)}


def test_chat_reply_circles_have_the_smallest_message_as_root(spark):
    rows = [(1, 1, 1, 0.0, "user", "self"), (1, 2, None, 1.0, "user", "beside"),
            (2, 7, 9, 0.0, "user", "b"), (2, 8, 7, 0.0, "user", "c"), (2, 9, 8, 0.0, "user", "d"), (2, 10, 9, 0.0, "user", "tail"),
            (3, 0, None, 0.0, "user", "r"), *[(3, i, i - 1, 0.0, "user", str(i)) for i in range(1, 40)]]
    got = chat_turns(spark, rows, branches=5)
    assert got[1, 1] == [("user", "self")] and got[1, 2] == [("user", "beside")]
    assert got[2, 10] == [("user", x) for x in ("b", "c", "d", "tail")] and len(got[3, 39]) == 40 and len(got) == 4


def test_chat_long_conversation_with_ties_and_repeats(spark):
    rows = [(1, i // 2, "user", f"t{i // 2}" + "x" * (100_000 if i == 50 else 0)) for i in range(600)] + [(None, 0, None, None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r.conv: r for r in chat.format_chats(chat.linear_messages(turns)).select("conv", "n_turns", chat.parse_turns(F.col("formatted")).alias("t")).collect()}
    assert [t.text for t in out[1].t] == [t for _, _, t in sorted((r[1], r[2], r[3]) for r in rows[:-1])] and out[None].n_turns == 1


# 4 ---------------------------------------------------------------------------------------------


def test_token_file_round_trip(spark):
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = ODD + ["a  b", " x\n\n y", "tab\t z  ", "\x01 q"]
    path = tokenfile.new_path(spark)
    tokenfile.write(docs(spark, texts).repartition(3), P.path("byte_bpe_50k.json"), path)
    got = {r.doc_id: r for r in tokenfile.read(spark, path).collect()}
    start = 0
    for i, x in enumerate(texts):
        ids = np.array(t.encode(x or "", add_special_tokens=False).ids + [0], dtype="<u4")
        assert (got[i].start, got[i].n_tokens, bytes(got[i].ids)) == (start, len(ids), ids.tobytes()), x
        start += len(ids)
    assert tokenfile.digests(spark, path).where("doc_id = 1").first().ids_crc32 == zlib.crc32(b"\0\0\0\0")
    empty = tokenfile.new_path(spark)
    tokenfile.write(docs(spark, ["a"]).limit(0), P.path("byte_bpe_50k.json"), empty)
    assert tokenfile.digests(spark, empty).count() == 0


@pytest.mark.parametrize("ids", [[0], [5] * 3000, list(range(5000)), [2**32 - 1, 0, 7], [1, 2, 3, 2**31] * 700])
def test_blocks_round_trip(ids):
    a = np.array(ids, dtype=np.uint32)
    p = tokenfile.pack_segment(a)
    assert (tokenfile.unpack_segment(p) == a).all()
    assert (tokenfile.unpack_block(memoryview(p), int(tokenfile.block_starts(p)[-1])) == a[(len(a) - 1) // 1024 * 1024 :]).all()


# 5 ---------------------------------------------------------------------------------------------


def test_language_on_held_out_rows(spark, duck):
    out = {r.doc_id: r for r in queries.queries()["op5_language"](spark, SF).collect()}
    truth = dict(duck.sql("select doc_id, lang from documents").fetchall())
    held = [r for r in out.values() if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out.values())
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) >= 0.97 and all(0 <= r.score <= 1 for r in out.values())


def test_language_edges(spark):
    model = language.train(docs(spark, ["the cat and the dog are here", None, "12"]).unionByName(docs(spark, ["der hund und die katze"], lang="de")))
    out = [(r.lang_pred, r.rejected) for r in language.predict(docs(spark, [None, "", "1 2 !", "the dog", "und die"]), model).orderBy("doc_id").collect()]
    assert [x[0] for x in out] == ["und", "und", "und", "en", "de"] and out[0][1]
    assert language.predict(docs(spark, ["x"]), language.train(docs(spark, ["a"], lang=None))).first().lang_pred == "und"


# 6 ---------------------------------------------------------------------------------------------


def test_fingerprints_against_direct_sums(spark):
    texts = ["a\nb\nlonger paragraph of text here", "b\na\nlonger paragraph of text here", None, "", "x" * 5000 + "\n" + "tail words in a line", "é日\n" * 9]
    got = {r.doc_id: r for r in fingerprint.neighbour_fingerprints(docs(spark, texts)).collect()}
    plain = [t or "" for t in texts]
    for i, t in enumerate(plain):
        after, half = plain[(i + 1) % len(plain)], len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[i].n_chars == len(t)
        assert got[i].fingerprint == fingerprint.text_of(fingerprint.vector(t)) and got[i].edited_fingerprint == fingerprint.text_of(fingerprint.vector(edited))
    assert got[0].fingerprint == got[1].fingerprint and got[0].near_next == 1.0  # order does not count
    assert fingerprint.neighbour_fingerprints(docs(spark, ["one"])).count() == 1
    assert fingerprint.neighbour_fingerprints(docs(spark, ["one"]).limit(0)).count() == 0


# 7 ---------------------------------------------------------------------------------------------


def line(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(n))


def test_line_dedup(spark):
    run = [line(i, 13) for i in range(5)]
    long = line(99, 60)
    texts = ["\n".join(["own a", *run, "own b"]), "\n".join(["other", "", *run, line(7, 9)]), "\n".join(["x", long]), "\n".join([long, "y z"]), "\n".join(run[:2]), None, "", "\n".join([line(5, 31)] * 4), "\n".join([long, "y z"])]
    got = {r.doc_id: r.text for r in linededup.dedup_lines(docs(spark, texts)).collect()}
    assert got[0] == texts[0] and got[1] == "\n".join(["other", "", line(7, 9)]) and got[2] == texts[2] and got[3] == "y z"
    assert got[4] == texts[4] and got[5] is None and got[6] == "" and got[7].split("\n")[0] == line(5, 31)
    assert got[8] == "" or got[8] == "y z"
    assert linededup.dedup_lines(docs(spark, ["a"]).limit(0)).count() == 0


def brute_line_dedup(texts, threshold=50):
    """Texts without the lines of runs of threshold words that began earlier, run by run."""
    seen, out = set(), []
    for text in texts:
        lines = [x for x in text.split("\n") if x]
        gone, own = set(), set()
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                if sum(len(x.split()) for x in lines[a:b]) >= threshold:
                    own.add(tuple(lines[a:b]))
                    if tuple(lines[a:b]) in seen:
                        gone |= set(range(a, b))
        seen |= own
        out.append("\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out


def test_line_dedup_finds_runs_first_seen_after_a_shared_gram(spark):
    a, b, c = line(41, 30), line(42, 30), line(43, 30)
    texts = ["\n".join(x) for x in ([line(1, 9), a, line(2, 9)], [line(3, 9), a, b], [a, b, line(4, 9)], [c, b, line(5, 9)], [line(6, 9), c, b])]
    got = [r.text for r in linededup.dedup_lines(docs(spark, texts)).orderBy("doc_id").collect()]
    assert got == brute_line_dedup(texts) and got[2] == line(4, 9) and got[4] == line(6, 9)


# 8 ---------------------------------------------------------------------------------------------


def brute_fingerprint(text, k=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    hs = [xxhash.xxh64_intdigest(" ".join(w[i : i + k]).encode(), 42) for i in range(max(1, len(w) - k + 1))] if w else []
    return sum(1 << b for b in range(64) if hs and 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash_fingerprints_and_components(spark):
    texts = [None, "", " \t", "One two", "one TWO", "a b c d e f", "É é", *[line(i, 40) for i in range(20)], line(3, 40)]
    got = {r.doc_id: r for r in simhash.near_duplicates(docs(spark, texts)).collect()}
    assert [got[i].fp % 2**64 for i in range(len(texts))] == [brute_fingerprint(t) for t in texts]
    assert got[2].component == 0 and got[4].component == 3 and got[27].component == 10


def test_vantage_tree_finds_every_pair():
    rnd = np.random.default_rng(4)
    base = rnd.integers(0, 2**63, size=1500, dtype=np.uint64)
    near = base[:400] ^ (np.uint64(1) << rnd.integers(0, 63, size=400, dtype=np.uint64)) ^ (np.uint64(1) << rnd.integers(0, 63, size=400, dtype=np.uint64))
    fps = np.unique(np.concatenate([base, near]))
    close = {(i, j) for i, j in np.argwhere(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2) if i < j}
    nodes = simhash.build_tree(fps[::3].copy(), 2, 8)
    rows, leaves = simhash.route(fps, nodes, 2)
    members = {}
    for r, leaf in zip(rows.tolist(), leaves.tolist()):
        members.setdefault(leaf, set()).add(r)
    assert nodes and len(members) > 1
    assert all(any({i, j} <= m for m in members.values()) for i, j in close)
    found = {(min(a, b), max(a, b)) for x, y in simhash._close_pairs(fps, 2) for a, b in zip(x.tolist(), y.tolist())}
    assert found == close


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 41)) and all(got[i] == 100 for i in range(101, 140))
    assert simhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_similar_documents(spark):
    a, b = line(1, 200), line(2, 200)
    words = a.split()
    texts = [a, " ".join(words[:-4] + ["new"] * 4), b, b + " more", None, " ", line(3, 200), a]
    got = {r.doc_id: r.component for r in simhash.similar_documents(docs(spark, texts)).collect()}
    assert got[0] == got[1] == got[7] == 0 and got[2] == got[3] == 2 and got[6] == 6 and got[5] == 4


# 9, 10 -----------------------------------------------------------------------------------------


def test_mixing_edges(spark):
    d = docs(spark, ["a"] * 300).withColumn("source", F.when(F.col("doc_id") < 200, F.lit("big")).when(F.col("doc_id") < 260, F.lit("small")))
    out = mixing.mix(d, {"big": 1.0, "small": 1.0, None: 0.0}, target=4000)
    n = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    assert set(n) == {"big", "small"} and all(1700 < x < 2300 for x in n.values()) and "Text_2" in out.columns
    assert sorted(map(tuple, out.select("doc_id", "copy").collect())) == sorted(map(tuple, mixing.mix(d.repartition(7), {"big": 1.0, "small": 1.0, None: 0.0}, target=4000).select("doc_id", "copy").collect()))
    assert mixing.mix(d.limit(0)).count() == 0


def test_url_rules(spark):
    rules = spark.createDataFrame([("org", "/", "allow"), ("a.org", "/x", "block"), ("a.org", "/x", "block")], "host string, path string, verdict string")
    urls = [None, "a.org/x", "http://A.ORG/xyz?q", "http://b.a.org/y#f", "http://notorg/x", "https://org", "http://b.a.org/x", "http://b.a.org/x"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(df, rules).collect()}
    assert got[0] == ("", "", None, "allow") == got[1] and got[2] == ("a.org", "/xyz", "a.org/x", "block")
    assert got[3][2:] == ("org/", "allow") and got[4][2] is None and got[5] == ("org", "", None, "allow") and got[6] == got[7] == ("b.a.org", "/x", "a.org/x", "block")
    assert url_filter.judge(df, rules.limit(0)).where("verdict = 'allow'").count() == len(urls)


def test_url_rules_of_long_hosts_and_many_rules(spark):
    deep = ".".join("x" for _ in range(50_000))
    rules = [(f"s{i}.com", f"/{'p' * (i % 4)}", "block" if i % 2 else "allow") for i in range(3000)] + [("b.c", "/", "block")]
    urls = [f"http://{deep}.b.c/y", f"http://{deep}/", "http://" + "a" * 100_000 + ".b.c/" + "z" * 100_000] + [f"https://w{i % 7}.s{i}.com/{'p' * (i % 5)}" for i in range(0, 6000, 7)]
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, Verdict string")
    got = {r.page_id: r.rule for r in url_filter.judge(df, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
    for i, u in enumerate(urls):
        host, path = u.split("://")[1].split("/")[0], "/" + u.split("://")[1].partition("/")[2]
        fits = [h + p for h, p, _ in rules[-1:] + rules[: i + 1 if i > 2 else 0] + rules[(i - 3) * 7 : (i - 3) * 7 + 1] if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert got[i] == (max(fits, key=len) if fits else None), u[:80]


def test_pipeline_stages(spark):
    import corpus_pipeline

    d = spark.read.parquet(f"{SF}/documents.parquet")
    once = corpus_pipeline.identify_language(spark, d, SF)
    assert once.columns == corpus_pipeline.COLUMNS and once.count() >= 0.98 * d.count()
    out = corpus_pipeline.run(spark, SF)
    assert {"token_ids", "n_tokens"} <= set(out.columns) and out.where("size(token_ids) <> n_tokens").count() == 0
    assert 0 < out.count() < 2 * d.count()


def plain_shingles(text, k=5):
    w = (text or "").lower().split()
    return {" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def plain_groups(texts, least=0.8):
    """The smallest index of each text's group, by comparing all pairs."""
    sets, root = [plain_shingles(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return root


def edits(i):
    w, new = line(500 + i, 300).split(), line(700 + i, 60).split()
    return [" ".join(x) for x in (w, w[:250], w[48:], w + new, new[:50] + w, w[:130] + new[:24] + w[154:], w[:90] + w[120:])]


def test_similar_documents_finds_contiguous_edits(spark):
    texts = [t for i in range(30) for t in (edits(i)[0], edits(i)[1 + i % 6])]
    got = {r.doc_id: r.component for r in simhash.similar_documents(docs(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == plain_groups(texts) and len(set(got.values())) == 30


def test_similar_documents_checks_before_thinning(spark):
    w = line(900, 400).split()
    chain = [" ".join(w[k : k + 200]) for k in range(0, 200, 18)]  # neighbours are similar, others are not
    texts = ["ok", " ".join(["ok"] * 10), " ".join(["ok"] * 20), *chain, *[t for i in range(6) for t in edits(i)]]
    got = {r.doc_id: r.component for r in simhash.similar_documents(docs(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == plain_groups(texts) and got[0] == 0 and got[2] == 1


def test_near_dedup_of_null_and_repeated_ids(spark):
    import corpus_pipeline

    a, b, c, d = (line(i, 100) for i in range(800, 804))
    rows = [(None, a), (None, b), (1, c), (1, d), (2, c + " more"), (None, a), (3, b)]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.drop_near_duplicates(spark, df, SF).select("doc_id", "text").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, a), (3, b), (1, c), (1, d)], key=str)


def plain_line_dedup(texts, threshold=50):
    """Texts in order without the lines that stand in a run of threshold words which begins at an earlier place too."""
    first, out = {}, []
    for d, text in enumerate(texts):
        rows = (text or "").split("\n")
        at = [i for i, x in enumerate(rows) if x.split()]
        lines, w, gone = [rows[i].strip(" ") for i in at], [len(rows[i].split()) for i in at], set()
        for a in range(len(lines)):
            n = 0
            for b in range(a, len(lines)):
                n += w[b]
                if n - w[a] >= threshold and n - w[b] >= threshold:
                    break
                if n >= threshold and first.setdefault("\n".join(lines[a : b + 1]), (d, a)) < (d, a):
                    gone |= set(at[a : b + 1])
        out.append(None if text is None else "\n".join(x for i, x in enumerate(rows) if i not in gone))
    return out


def test_line_dedup_of_all_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect()
    got = linededup.dedup_lines(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).orderBy("doc_id").collect()
    want = plain_line_dedup([r.text for r in rows])
    assert [r.text for r in got] == want and sum(a != b.text for a, b in zip(want, rows)) > 20


def test_line_dedup_of_branching_runs(spark):
    """Passages cut and joined at random, so that heads and tails of runs have first places of their own."""
    rnd = random.Random(8)
    pool = [line(2000 + i, rnd.choice([1, 3, 8, 14, 30, 55])) for i in range(30)]
    texts = []
    for _ in range(120):
        x = []
        for _ in range(rnd.randrange(1, 5)):
            a = rnd.randrange(30)
            x += pool[a : a + rnd.randrange(1, 12)] + ([line(rnd.random(), 6)] if rnd.random() < 0.5 else [""])
        texts.append("\n".join(x))
    got = [r.text for r in linededup.dedup_lines(docs(spark, texts)).orderBy("doc_id").collect()]
    assert got == plain_line_dedup(texts)


def test_line_dedup_edges(spark):
    """Very long text, repeated rows, null ids, a clashing column."""
    big = "\n".join(line(i, 9) for i in range(3000))
    rows = [(1, big), (1, big), (None, big), (2, "own\n" + big + "\nend"), (3, None), (3, "")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, N_lines_removed string")
    got = linededup.dedup_lines(df)
    assert got.columns == ["doc_id", "text", "n_lines_removed"]
    got = sorted([(r.doc_id, r.text, r.n_lines_removed) for r in got.collect()], key=repr)
    # the null id comes first and keeps the passage
    assert got == sorted([(1, "", 3000), (1, "", 3000), (None, big, 0), (2, "own\nend", 3000), (3, None, 0), (3, "", 0)], key=repr)


def test_line_dedup_counts_words_between_white_space(spark):
    tabs, wide, rest = line(61, 60).replace(" ", "\t"), line(62, 30).replace(" ", "   "), line(63, 55).replace(" ", "\u00a0")
    tsv = "\n".join(line(64 + i, 6).replace(" ", "\t") for i in range(12))
    texts = ["\n".join(x) for x in ([line(1, 9), tabs], [tabs, line(2, 9)], [wide, line(3, 9)], [line(4, 9), wide], [rest, "a"], ["b", rest], [tsv, "c"], ["d", tsv])]
    got = [r.text for r in linededup.dedup_lines(docs(spark, texts)).orderBy("doc_id").collect()]
    assert got == brute_line_dedup(texts) and got[1] == line(2, 9) and got[3] == texts[3] and got[5] == "b" and got[7] == "d"


def test_mixing_of_a_rare_source_in_a_large_table(spark):
    d = spark.range(24000).select(F.col("id").alias("doc_id"), F.when(F.col("id") > 0, F.concat(F.lit("s"), F.col("id") % 19)).alias("source"))
    out = mixing.mix(d).select("doc_id", "source", "copy")
    own = sorted(r["copy"] for r in out.where("source is null").collect())
    assert own == list(range(len(own))) and 1000 < len(own) < 1400 and 23000 < out.count() < 25000
    assert own == sorted(r["copy"] for r in mixing.mix(d.repartition(5)).where("source is null").collect())
