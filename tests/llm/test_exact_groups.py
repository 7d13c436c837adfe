"""Groups of similar texts lose no link, whatever the buckets of their first search lose."""

import random

import numpy as np
import pytest

from edgelens.llm import simhash


def texts(n, rnd):
    """Texts in families whose members differ in some words: similar, nearly so, or not."""
    out = []
    for _ in range(n // 6):
        w = [f"w{rnd.randrange(10**6)}" for _ in range(rnd.randrange(4, 160))]
        for k in range(6):
            x = list(w)
            for _ in range(rnd.randrange(1 + len(w) // 20) if k else 0):
                x[rnd.randrange(len(x))] = f"n{rnd.randrange(10**6)}"
            out.append(" ".join(x))
    return out


def brute(texts, similarity):
    sets = [set(simhash.shingle_set(t, 5)[0].tolist()) for t in texts]
    root = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if len(a & b) >= similarity * len(a | b):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return root


@pytest.mark.parametrize("groups,similarity", [(1, 0.8), (32, 0.4)])
def test_no_link_is_lost(spark, groups, similarity):
    own = texts(240, random.Random(8))
    df = spark.createDataFrame(list(enumerate(own)), "doc_id long, text string")
    got = {r.doc_id: r.component for r in simhash.similar_documents(df, similarity=similarity, groups=groups).collect()}
    assert [got[i] for i in range(len(own))] == brute(own, similarity)


def test_similar_sets_share_a_prefix():
    rnd, met = np.random.default_rng(4), 0
    order = rnd.integers(0, 50, size=64).astype(np.int32)
    for _ in range(4000):
        a = rnd.choice(1000, size=rnd.integers(1, 60), replace=False)
        b = np.unique(np.concatenate([a[rnd.random(len(a)) < 0.92], rnd.choice(1000, size=rnd.integers(0, 5))]))
        if not len(b) or len(np.intersect1d(a, b)) < 0.8 * len(np.union1d(a, b)):
            continue
        (small, _), large = simhash.prefixes(min(a, b, key=len), order, 0.8), np.concatenate(simhash.prefixes(max(a, b, key=len), order, 0.8))
        assert len(np.intersect1d(small, large))
        met += 1
    assert met > 500
