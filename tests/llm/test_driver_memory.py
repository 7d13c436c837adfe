"""What the near-duplicate stage brings to the driver takes bytes, not Python objects, for each value."""

import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from edgelens.llm import simhash

N = 200_000


def peak(f):
    """(result of f, MB that this process's Python took at most)"""
    tracemalloc.start()
    try:
        return f(), tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def texts(spark):
    """(key, text): 400 texts of 500 words each, no word twice."""
    word = F.concat(F.lit("w"), F.col("id").cast("string"))
    return spark.range(N).groupBy(F.expr("id div 500").alias("key")).agg(F.concat_ws(" ", F.collect_list(word)).alias("text")).localCheckpoint()


def test_the_order_of_shingles_comes_as_columns(spark):
    simhash.importable(spark)
    df = texts(spark)
    order, mb = peak(lambda: simhash.shingle_order(df, df.count(), 5))
    want = np.zeros(simhash.ORDER_CELLS, dtype=np.int64)
    for r in df.collect():
        np.add.at(want, simhash.shingle_set(r.text, 5)[0] & (simhash.ORDER_CELLS - 1), 1)
    assert (order == want).all() and (want > 0).sum() > 150_000
    assert mb < 16, mb


def test_the_order_is_fitted_to_a_bounded_share_of_the_texts(spark, monkeypatch):
    monkeypatch.setattr(simhash, "ORDER_TEXTS", 40)
    simhash.importable(spark)
    df = texts(spark)
    order = simhash.shingle_order(df, df.count(), 5)
    assert 15 * 496 < order.sum() < 80 * 496
    assert not simhash.shingle_order(df.limit(0), 0, 5).any()


def test_the_sample_of_fingerprints_comes_as_columns(spark):
    fps = spark.range(N).select(F.lit(0).alias("seed"), F.xxhash64("id").alias("fp")).localCheckpoint()
    _, mb = peak(lambda: simhash.links(fps))
    assert mb < 16, mb


def test_a_sampled_tree_links_all(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SAMPLE", 1000)
    monkeypatch.setattr(simhash, "LEAF_ROWS", 64)
    one = F.xxhash64("id")
    fps = spark.range(4000).select(F.explode(F.array(one, one.bitwiseXOR(F.lit(3)))).alias("fp")).select(F.lit(0).alias("seed"), "fp").localCheckpoint()
    got = {frozenset((r.a, r.b)) for r in simhash.links(fps).collect()}
    assert got == {frozenset((r.a, r.b)) for r in spark.range(4000).select(one.alias("a"), one.bitwiseXOR(F.lit(3)).alias("b")).collect()}
