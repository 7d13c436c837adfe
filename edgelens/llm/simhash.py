"""SimHash near-duplicates through a vantage-point tree of fingerprints (operator 8).

Fingerprint: A-Z lower-cased, words between ASCII white space, shingles of some words joined by single
spaces, repeats included; a bit is set if more than half of the shingles' XXH64 (seed 42) have it. A text
with fewer words than a shingle is one shingle; one without words has fingerprint 0.

Linking: different fingerprints go down a vantage-point tree. At a node with vantage v and bound m, those
at distance <= m of v go inside and the others outside; those inside at m - radius + 1 or more go outside
as well, since by the triangle inequality only they can have a partner there. So every pair within the
radius meets in a leaf. The upper tree is built from a bounded sample and routes all fingerprints; each
leaf is one group, in which the tree goes on in memory and small nodes compare all their members. A leaf
returns a spanning forest of its close pairs, never all pairs, so a dense group stays linear in output;
components over all leaves follow by star contraction.

near_duplicates() links by one fingerprint of shingles. similar_documents() serves a wish for similar texts
(Jaccard of five-word shingles of 0.8 or more), which differ in far more bits than a tree of 64-bit
fingerprints can prune. To the groups that the tree joins it adds SimHashes of small groups of shingles
selected by min-hash, of which similar texts share one whatever kind of edit parts them, and keeps the
links that the exact similarity confirms. That finds nearly all of them cheaply; what chance or the splitting of
wide buckets loses is found by prefixes: with shingles in one order, rare ones first, two similar texts share one
among the first few of both, so texts of different groups that share one are compared too.

Defined results: null and empty texts and texts without words have fingerprint 0 and are linked as any
other; equal texts share a fingerprint; repeated rows are rows of the same component; an empty table
gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from edgelens.llm.common import append_columns, hot_limit, row_key
from edgelens.runtime import importable, stage

SEED = 42
SAMPLE = 1 << 20  # fingerprints on the driver, about so many at most, 8 MiB
MIX = np.uint64(0x9E3779B97F4A7C15)  # vantages are taken in the order of products with it, whatever order the sample comes in
LEAF_ROWS = 4096  # expected members of an upper leaf, while the sample allows: up to 2**27 fingerprints; beyond, one in 2**15 of all, 8 bytes each
LEAST_SAMPLE = 32  # sampled members under which a node is not split
SCAN_ROWS = 256  # members that a node in memory compares with one another
PART = 1 << 15  # shingles hashed at a time
PICKS, GROUP = 96, 6  # shingles selected by min-hash, and of them in a group
GROUP_PART = 1 << 12  # shingles ordered at a time
#: A bucket in which more members than this stand apart from its largest part, as texts with one boilerplate do, is split by a
#: further group, up to so many times. Similar texts share about 8 of 32 groups, and few of these lie in their boilerplate.
SPLIT_MINORS, SPLIT_LEVELS = 1024, 4
BROADCAST_KEYS = 1 << 18  # keys of 16 bytes, 6 MiB
ORDER_TEXTS, ORDER_CELLS = 1 << 13, 1 << 20  # texts by which the order of shingles is fitted, and its cells: any order is exact, a fitted one is fast


def fingerprint(text: str | None, words: int = 3) -> int:
    """The 64-bit SimHash of a text."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    n = max(1, len(w) - words + 1)
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_digest
    for i in range(0, n, PART):
        part = w[i : min(i + PART, n) + words - 1]
        shingles = map(b" ".join, zip(*[part[k:] for k in range(words)])) if len(w) >= words else [b" ".join(w)]
        raw = np.frombuffer(b"".join([digest(s, SEED) for s in shingles]), dtype=np.uint8)
        ones += np.unpackbits(raw).reshape(-1, 64).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def add_fingerprint(docs: DataFrame, text_col: str = "text", words: int = 3, out_col: str = "fp") -> DataFrame:
    """docs with out_col, the fingerprint's bits as a signed long."""

    def maker():
        def run(texts: pa.Array):
            fps = np.fromiter((fingerprint(t.as_py(), words) for t in texts), dtype=np.uint64, count=len(texts))
            return [pa.array(fps.view(np.int64))]

        return run

    return append_columns(docs, [text_col], [(out_col, "long")], maker)


def distances(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def choose_bound(d: np.ndarray, radius: int) -> int | None:
    """The bound near the median that sends fewest members both ways; None if no bound splits."""
    count = np.bincount(d, minlength=65 + radius)
    below = np.cumsum(count)
    n = len(d)
    best = None
    for m in range(65):
        inside, both = below[m], below[m] - (below[m - radius] if m >= radius else 0)
        outside = n - inside + both
        if inside < n and outside < n and max(inside, outside) <= 0.9 * n:
            cost = inside * inside + outside * outside
            if best is None or cost < best[0]:
                best = (cost, m)
    return best[1] if best else None


def build_tree(sample: np.ndarray, radius: int, leaves: int) -> list[tuple]:
    """Nodes (vantage, bound, inside, outside) in an array; a child below 0 is leaf -1 - child."""
    nodes: list[tuple] = []
    n_leaves = 0
    least = max(LEAST_SAMPLE, len(sample) // max(1, leaves))

    def grow(members: np.ndarray) -> int:
        nonlocal n_leaves
        if len(members) > least:
            for v in members[:: max(1, len(members) // 8)][:8]:
                d = distances(members, v)
                m = choose_bound(d, radius)
                if m is not None:
                    at = len(nodes)
                    nodes.append(())
                    inside = grow(members[d <= m])
                    outside = grow(members[d > m - radius])
                    nodes[at] = (int(v), m, inside, outside)
                    return at
        n_leaves += 1
        return -n_leaves

    grow(sample)
    return nodes


def route(fps: np.ndarray, nodes: list[tuple], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, leaves): the leaves that each fingerprint belongs to."""
    rows_out, leaves_out = [], []
    stack = [(0 if nodes else -1, np.arange(len(fps)))]
    while stack:
        node, rows = stack.pop()
        if not len(rows):
            continue
        if node < 0:
            rows_out.append(rows)
            leaves_out.append(np.full(len(rows), -1 - node, dtype=np.int64))
            continue
        v, m, inside, outside = nodes[node]
        d = distances(fps[rows], np.uint64(v))
        stack += [(inside, rows[d <= m]), (outside, rows[d > m - radius])]
    if not rows_out:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(rows_out), np.concatenate(leaves_out)


def _close_pairs(fps: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within the radius, each at least once; the tree goes on until nodes are small."""
    stack = [np.arange(len(fps))]
    while stack:
        rows = stack.pop()
        if len(rows) > SCAN_ROWS:
            m = None
            for v in rows[:: max(1, len(rows) // 4)][:4]:
                d = distances(fps[rows], fps[v])
                m = choose_bound(d, radius)
                if m is not None:
                    stack += [rows[d <= m], rows[d > m - radius]]
                    break
            if m is not None:
                continue
        for i in range(0, len(rows), SCAN_ROWS):
            a = rows[i : i + SCAN_ROWS]
            b = rows[i:]
            near = np.argwhere(distances(fps[a][:, None], fps[b][None, :]) <= radius)
            near = near[near[:, 0] < near[:, 1]]
            if len(near):
                yield a[near[:, 0]], b[near[:, 1]]


def leaf_links(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, member) of a spanning forest of the close pairs in a leaf, by index; each is a close pair,
    and of the pairs compared together the closest come first."""
    parent = list(range(len(fps)))
    one, other = [], []

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in _close_pairs(fps, radius):
        order = np.argsort(distances(fps[a], fps[b]), kind="stable")
        for x, y in zip(a[order].tolist(), b[order].tolist()):
            i, j = find(x), find(y)
            if i != j:
                parent[max(i, j)] = min(i, j)
                one.append(x)
                other.append(y)
    return np.array(one, dtype=np.int64), np.array(other, dtype=np.int64)


def links(fingerprints: DataFrame, radius: int = 2) -> DataFrame:
    """(seed, a, b): links that join all different fingerprints of a seed within the radius, directly or
    through others. fingerprints: (seed int, fp long), distinct; each seed has a tree of its own."""
    importable(fingerprints.sparkSession)
    totals = {r["seed"]: r["n"] for r in fingerprints.groupBy("seed").agg(F.count("*").alias("n")).collect()}  # a row per seed
    share = max(1, -(-sum(totals.values()) // SAMPLE))
    sample = fingerprints.select("seed", "fp").where(F.pmod(F.xxhash64("fp"), F.lit(share)) == 0).toArrow()  # as rows of Python objects it would be hundreds of MB
    seed_of, sampled = sample["seed"].to_numpy(), sample["fp"].to_numpy()
    trees = {}
    for seed, n in totals.items():
        own = sampled[seed_of == seed].view(np.uint64)
        trees[seed] = build_tree(own[np.argsort(own * MIX)], radius, -(-n // LEAF_ROWS))

    def spread(batches):
        for b in batches:
            seeds, fps = b.column(0).to_numpy(), b.column(1).to_numpy()
            for seed in np.unique(seeds).tolist():
                own = fps[seeds == seed]
                rows, leaves = route(own.view(np.uint64), trees[seed], radius)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), seed, dtype=np.int32)), pa.array(leaves), pa.array(own[rows])], ["seed", "leaf", "fp"])

    def inside(pdf: pd.DataFrame) -> pd.DataFrame:
        fps = np.sort(pdf["fp"].to_numpy(dtype=np.int64))
        a, b = leaf_links(fps.view(np.uint64), radius)
        return pd.DataFrame({"seed": np.full(len(a), pdf["seed"].iloc[0], dtype=np.int32), "a": fps[a], "b": fps[b]})

    routed = fingerprints.select("seed", "fp").mapInArrow(spread, "seed int, leaf long, fp long")
    return routed.groupBy("seed", "leaf").applyInPandas(inside, "seed int, a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each component, for nodes on an edge (a, b).

    Alternates large-star and small-star contraction until nothing changes, however many rounds that takes
    (O(log^2 n) whatever the diameter); the edges never grow in number.
    """
    edges = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "cc-edges")

    def mark(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    seen = mark(edges)
    while seen[0]:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.where("a <> b").distinct(), "cc-large")
        # small star: of a node's smaller neighbours the smallest takes the others and the node
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        edges = stage(small.where("a <> b").distinct(), "cc-small")
        now = mark(edges)
        if now == seen:
            break
        seen = now
    return edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")


def near_duplicates(
    docs: DataFrame, words: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, fp, component): component is the smallest id among the documents reachable by links."""
    fps = stage(add_fingerprint(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")), "__text", words).select("__id", "fp"), "simhash")
    different = stage(fps.groupBy("fp").agg(F.min("__id").alias("first")), "simhash-different")
    root = components(links(different.select(F.lit(0).alias("seed"), "fp"), radius))
    named = different.join(root, different["fp"] == root["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = stage(named, "simhash-roots")
    smallest = named.groupBy("root").agg(F.min("first").alias("component"))
    named = named.join(smallest, "root").select("fp", "component")
    return fps.join(named, "fp").select(F.col("__id").alias(id_col), "fp", "component")


def shingle_set(text: str | None, words: int) -> tuple[np.ndarray, bytes]:
    """Distinct 64-bit hashes of the word shingles, sorted, and 128 bits that name the set; a shorter text is one shingle."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return np.zeros(0, dtype=np.int64), bytes(16)
    shingles = map(b" ".join, zip(*[w[k:] for k in range(words)])) if len(w) >= words else [b" ".join(w)]
    digest = xxhash.xxh3_128_digest
    both = np.frombuffer(b"".join([digest(x, SEED) for x in set(shingles)]), dtype="<i8").reshape(-1, 2)
    both = both[np.argsort(both[:, 0])]
    return both[:, 0].copy(), digest(both.tobytes(), SEED)


@lru_cache(maxsize=4)
def _orders(groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Masks and factors of the orders, and the picks of each group, which all picks serve equally often."""
    rnd = np.random.default_rng(SEED)
    mask, factor = rnd.integers(0, 2**64, size=(2, PICKS, 1), dtype=np.uint64)
    whole = [rnd.permutation(PICKS).reshape(-1, GROUP) for _ in range(-(-groups * GROUP // PICKS))]
    return mask, factor | np.uint64(1), np.concatenate(whole)[:groups]


def group_fingerprints(hashes: np.ndarray, groups: int) -> list[int]:
    """SimHashes of groups of GROUP of PICKS shingles, each the least of all under an order of its own.

    Two sets agree in a pick with their Jaccard similarity as the probability, wherever they differ. At 0.8
    they share none of 32 groups with probability 0.0005, at 0.1 they share one with 0.00005."""
    if not len(hashes):
        return []
    mask, factor, members = _orders(groups)
    best, picks = None, None
    for i in range(0, len(hashes), GROUP_PART):
        part = hashes[i : i + GROUP_PART].view(np.uint64)
        order = (part[None, :] ^ mask) * factor
        at = order.argmin(axis=1)
        low, own = order[np.arange(len(at)), at], part[at]
        best, picks = (low, own) if best is None else (np.minimum(best, low), np.where(low < best, own, picks))
    bits = np.unpackbits(picks[members].astype("<u8").view(np.uint8).reshape(groups, GROUP, 8), axis=2)
    return np.packbits(2 * bits.sum(axis=1) > GROUP, axis=1).view("<i8").reshape(-1).tolist()


def parities(hashes: np.ndarray) -> list[int]:
    """Whether an odd number of hashes falls on each of a power of two of bits, two a hash or more: two sets differ
    in at least as many elements as such bits. Halves fold by exclusive or."""
    size = 64
    while size < 2 * len(hashes):
        size *= 2
    odd = np.bincount((hashes.view(np.uint64) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8").tolist()


def with_sides(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    """pairs (x, y) with the columns of both keys' rows in table (key, columns), named after x and y.

    The few keys of very many pairs have their row copied, a copy for each part of their pairs, so that no task
    takes all pairs of one key."""
    limit = hot_limit(2 * pairs.count())
    asked = pairs.select(F.explode(F.array("x", "y")).alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    hot = F.broadcast(stage(asked.where(F.col("n") > limit).select("key", F.ceil(F.col("n") / limit).cast("int").alias("parts")), "hot-keys"))
    for a, b in (("x", "y"), ("y", "x")):
        pairs = pairs.join(hot.withColumnsRenamed({"key": a, "parts": "p" + a}), a, "left")
        pairs = pairs.withColumn("p" + a, F.pmod(F.xxhash64(b), F.coalesce("p" + a, F.lit(1))).cast("int"))
    each = table.join(hot, "key", "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
    for a in "xy":
        side = each.select(F.col("key").alias(a), F.col("part").alias("p" + a), *[F.col(c).alias(c + a) for c in columns])
        pairs = pairs.join(side, [a, "p" + a])
    return pairs


def may_be_similar(similarity: float) -> Column:
    """Whether texts x and y, of sizes n and parities odd, are not too far apart for the similarity: never false for
    a similar pair, and true for few others."""

    def halved(o: Column, other: Column) -> Column:
        n = F.size(other)
        return F.when(F.size(o) <= n, o).otherwise(F.zip_with(F.slice(o, 1, n), F.slice(o, n + 1, n), lambda a, b: a.bitwiseXOR(b)))

    sizes = F.least("nx", "ny") >= similarity * F.greatest("nx", "ny")  # so one has at most twice the bits of the other
    apart = F.zip_with(halved(F.col("oddx"), F.col("oddy")), halved(F.col("oddy"), F.col("oddx")), lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    differ = F.aggregate(apart, F.lit(0), lambda n, b: n + b)
    return F.when(sizes, differ <= (1 - similarity) / (1 + similarity) * (F.col("nx") + F.col("ny")) + 1e-6).otherwise(False)


def confirmed(pairs: DataFrame, nodes: DataFrame, rows: DataFrame, words: int, similarity: float) -> DataFrame:
    """Of the pairs (x, y) of keys those whose texts have at least the similarity. nodes: (key, n, odd), the size and
    the parities of a text's shingles; rows: (key, text)."""
    pairs = stage(with_sides(pairs, nodes, "n", "odd").where(may_be_similar(similarity)).select("x", "y"), "similar-near")
    asked = stage(pairs.select(F.explode(F.array("x", "y")).alias("key")).distinct(), "similar-asked")
    asked = F.broadcast(asked) if asked.count() <= BROADCAST_KEYS else asked

    def exact():
        def run(texts: pa.Array):
            return [pa.array([shingle_set(t.as_py(), words)[0] for t in texts], type=pa.list_(pa.int64()))]

        return run

    texts = rows.select("key", "text").join(asked, "key", "left_semi").dropDuplicates(["key"])
    sets = stage(append_columns(texts, ["text"], [("s", "array<long>")], exact).select("key", "s"), "similar-shingles")
    both = F.size(F.array_intersect("sx", "sy"))
    close = (both >= similarity * (F.size("sx") + F.size("sy") - both)).alias("close")
    return stage(with_sides(pairs, sets, "s").where(close).select(F.col("x").alias("a"), F.col("y").alias("b")), "similar-edges")


def parted(rows: DataFrame) -> DataFrame:
    """rows (bucket, seed, size, node, root) of the buckets that hold several parts, with minor: whether outside the largest."""
    heads = rows.groupBy("bucket", "root").agg(F.count("*").alias("k")).groupBy("bucket").agg(F.max(F.struct("k", "root"))["root"].alias("main"), F.count("*").alias("roots"))
    return rows.join(heads.where("roots > 1"), "bucket").select("bucket", "seed", "size", "node", "root", (F.col("root") != F.col("main")).alias("minor"))


def split(parts: DataFrame, nodes: DataFrame) -> DataFrame:
    """parted() rows in which wide buckets are replaced by those of their members that share a further group as well, of a later
    seed, until buckets are small or SPLIT_LEVELS deep; what is wide then stays. nodes: (node, fps)."""
    for _ in range(SPLIT_LEVELS):
        wide = parts.groupBy("bucket").agg(F.sum(F.col("minor").cast("int")).alias("minors")).where(F.col("minors") > SPLIT_MINORS)
        wide = stage(wide.select("bucket"), "similar-wide")
        if wide.isEmpty():
            break
        further = nodes.select("node", F.posexplode("fps").alias("j", "fp"))
        deep = parts.join(wide, "bucket", "left_semi").select("bucket", "seed", "node", "root").join(further, "node").where("j > seed")
        deep = deep.select(F.xxhash64("bucket", "j", "fp").alias("bucket"), F.col("j").alias("seed"), "node", "root")
        shared = deep.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
        deep = stage(deep.join(shared, "bucket"), "similar-deep")
        parts = stage(parts.join(wide, "bucket", "left_anti").unionByName(parted(deep)), "similar-split")
    return parts


def shingle_order(texts: DataFrame, n_texts: int, words: int) -> np.ndarray:
    """How often the shingles of each cell, by their lowest bits, occur in about ORDER_TEXTS of the n_texts texts (key, text).

    The driver takes the counts as Arrow columns of 8 bytes a cell: rows of Python objects would be hundreds of MB."""

    def count(batches):
        seen = np.zeros(ORDER_CELLS, dtype=np.int64)
        for b in batches:
            for t in b.column(0):
                np.add.at(seen, shingle_set(t.as_py(), words)[0] & (ORDER_CELLS - 1), 1)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["cell", "n"])

    share = -(-n_texts // ORDER_TEXTS)
    some = texts.where(F.pmod(F.xxhash64("key"), F.lit(max(1, share))) == 0).repartition(texts.sparkSession.sparkContext.defaultParallelism)
    cells = some.select("text").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    cells = cells.select(F.col("cell").cast("int").alias("cell"), F.least("n", F.lit(1 << 30)).cast("int").alias("n")).toArrow()  # ORDER_CELLS rows at most
    order = np.zeros(ORDER_CELLS, dtype=np.int32)
    order[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    return order


def prefixes(hashes: np.ndarray, order: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(heads, rest): the first shingles of a text in the order. Of two similar texts a head of the smaller one is among the
    heads or the rest of the other: they share 2 s / (1 + s) of the smaller and s of the larger one or more."""
    n = len(hashes)
    first = lambda least: n - int(np.ceil(least * n - 1e-9)) + 1 if n else 0
    ranked = hashes[np.lexsort((hashes, order[hashes & (len(order) - 1)]))]
    heads, both = first(2 * similarity / (1 + similarity)), first(similarity)
    return ranked[:heads], ranked[heads:both]


def prefix_buckets(texts: DataFrame, roots: DataFrame, words: int, similarity: float) -> DataFrame:
    """(bucket, seed, size, node, root): the texts that share a shingle of their prefixes, where they are of several groups.
    texts: (key, text), different shingles each; roots: (node, root). Buckets of the same texts are one."""
    spark = texts.sparkSession
    importable(spark)
    order = spark.sparkContext.broadcast(shingle_order(texts, roots.count(), words))

    def maker():
        def run(column: pa.Array):
            both = [prefixes(shingle_set(t.as_py(), words)[0], order.value, similarity) for t in column]
            return [pa.array([b[i] for b in both], type=pa.list_(pa.int64())) for i in (0, 1)]

        return run

    own = append_columns(texts, ["text"], [("heads", "array<long>"), ("rest", "array<long>")], maker).select(F.col("key").alias("node"), "heads", "rest")
    own = stage(own.join(roots, "node").select("node", F.xxhash64("root").alias("group"), "heads", "rest"), "similar-prefixes")
    side = lambda c, head: own.select(F.explode(c).alias("bucket"), "node", "group", F.lit(head).alias("head"))
    each = side("heads", 1).unionByName(side("rest", 0))
    apart = each.groupBy("bucket").agg(F.min("group").alias("low"), F.max("group").alias("high"), F.max("head").alias("head")).where("low <> high and head = 1")
    met = stage(each.join(apart.select("bucket"), "bucket").select("bucket", "node"), "similar-met")
    same = met.groupBy("bucket").agg(F.count("*").alias("size"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("sum"))
    named = met.join(same, "bucket").select(F.xxhash64("size", "sum").alias("bucket"), F.lit(0).alias("seed"), "size", "node").distinct()
    return named.join(roots, "node")


def across(parts: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """(x, y): of parted() rows whatever is outside a bucket's largest part with all other parts, unless size or parities
    forbid it."""
    parts = parts.withColumn("blocks", F.ceil(F.col("size") / SCAN_ROWS).cast("int"))
    parts = stage(parts.join(nodes.select("node", "n", "odd"), "node"), "similar-sides")
    side = lambda a: [F.col("node").alias(a), *[F.col(c).alias(c + a) for c in ("n", "odd", "root", "minor")]]
    one = parts.where("minor").select("bucket", F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block"), *side("x"))
    other = parts.select("bucket", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), *side("y"))
    apart = (F.col("rootx") != F.col("rooty")) & ((F.col("x") < F.col("y")) | ~F.col("minory"))
    rest = one.join(other, ["bucket", "block"]).where(apart & may_be_similar(similarity)).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    return rest.distinct()


def similar_groups(
    docs: DataFrame, words: int = 5, similarity: float = 0.8, groups: int = 32, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(key, id, root): the documents, by a 128-bit hash of id and text, and the groups that links of at least the
    similarity join. Texts with equal shingles are one node; texts without words are similar to each other."""

    def maker():
        def run(texts: pa.Array):
            sets = [shingle_set(t.as_py(), words) for t in texts]
            return [
                pa.array([name for _, name in sets], type=pa.binary()),
                pa.array([len(s) for s, _ in sets], type=pa.int32()),
                pa.array([group_fingerprints(s, groups) for s, _ in sets], type=pa.list_(pa.int64())),
                pa.array([parities(s) for s, _ in sets], type=pa.list_(pa.int64())),
            ]

        return run

    rows = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    ids = append_columns(rows, ["text"], [("same", "binary"), ("n", "int"), ("fps", "array<long>"), ("odd", "array<long>")], maker)
    ids = stage(ids.select("id", "key", "same", "n", "fps", "odd"), "similar-ids")
    nodes = ids.groupBy("same").agg(F.min(F.struct("key", "n", "fps", "odd")).alias("r")).select("same", "r.*")
    nodes = stage(nodes.withColumnRenamed("key", "node"), "similar-nodes")
    # buckets: a shared fingerprint of a group, or a component of the trees
    each = nodes.select("node", "n", F.posexplode("fps").alias("seed", "fp")).select(F.xxhash64("seed", "fp").alias("bucket"), "seed", "node", "n")
    trees = near_duplicates(rows, id_col="key").select(F.col("key").alias("node"), F.xxhash64(F.lit(-1), "component").alias("bucket")).distinct()
    each = each.unionByName(nodes.join(trees, "node").select("bucket", F.lit(-1).alias("seed"), "node", "n"))
    shared = each.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = stage(each.join(shared, "bucket"), "similar-buckets")
    # of a bucket the text that shares most with others, as the least edited copy does, is checked exactly with the
    # rest, in large buckets another one too: that joins what most buckets hold
    weight = members.groupBy("node").agg(F.sum("size").alias("weight"))
    first = members.join(weight, "node").groupBy("bucket").agg(
        F.max(F.struct("weight", "node"))["node"].alias("first"), F.min_by("node", F.xxhash64("bucket", "node")).alias("other"))
    stars = members.join(first, "bucket").withColumn("center", F.explode(F.when(F.col("size") > SCAN_ROWS, F.array("first", "other")).otherwise(F.array("first"))))
    pairs = stars.select(F.least("center", "node").alias("x"), F.greatest("center", "node").alias("y")).where("x <> y").distinct()
    pairs = stage(pairs, "similar-pairs")
    sketches = nodes.select(F.col("node").alias("key"), "n", "odd")
    edges = confirmed(pairs, sketches, rows, words, similarity)
    # then across the parts of buckets that confirmed links do not join yet
    parts = members.select("bucket", "seed", "size", "node").join(components(edges), "node", "left").withColumn("root", F.coalesce("root", "node"))
    parts = split(stage(parted(stage(parts, "similar-parts")), "similar-split"), nodes)
    rest = stage(across(parts, nodes, similarity).join(pairs, ["x", "y"], "left_anti"), "similar-rest")
    edges = stage(edges.unionByName(confirmed(rest, sketches, rows, words, similarity)), "similar-found")
    # texts that these groups still part, by the shingles of their prefixes: exact for all that buckets lost
    roots = stage(nodes.select("node").join(components(edges), "node", "left").select("node", F.coalesce("root", "node").alias("root")), "similar-roots")
    texts = rows.select("key", "text").join(nodes.select(F.col("node").alias("key")), "key", "left_semi").dropDuplicates(["key"])
    met = across(parted(stage(prefix_buckets(texts, roots, words, similarity), "similar-shared")), nodes, similarity)
    met = stage(met.join(pairs, ["x", "y"], "left_anti").join(rest, ["x", "y"], "left_anti"), "similar-last")
    edges = edges.unionByName(confirmed(met, sketches, rows, words, similarity))
    root = components(edges)
    named = nodes.select("same", "node").join(root, "node", "left").select("same", F.coalesce("root", "node").alias("root"))
    return ids.select("key", "id", "same").join(named, "same").select("key", "id", "root")


def similar_documents(
    docs: DataFrame, words: int = 5, similarity: float = 0.8, groups: int = 32, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, component) of similar_groups(): the component is the smallest id."""
    out = stage(similar_groups(docs, words, similarity, groups, id_col, text_col), "similar-groups")
    smallest = out.groupBy("root").agg(F.min("id").alias("component"))
    return out.join(smallest, "root").select(F.col("id").alias(id_col), "component")
