"""Exact top-k search by distributed histogram selection (operator 2).

Vectors become integers. Queries and candidates are packed into blocks, and every pair of a query block
and a candidate block is scored as one matrix product: query blocks are repeated once for each stratum of
candidate blocks and meet them in an equi-join on the stratum. The k-th highest score of each query is
located by refinement: histograms of the scores' leading digits, summed over all pairs, give the digit
that holds it; the next round counts within that digit, until a digit is one value. The last round keeps
the scores at or above it, and equal scores go to the smaller id.

A block pair reports counts only from its own k-th highest score upward, since the global k-th highest
cannot lie below it, and returns at most its own k best, so what leaves a task is bounded by k for each
query, whatever the ties. Nothing is broadcast; blocks have a fixed size.

Defined results: vectors that are null, empty or hold null or non-finite components take no part; of
repeated ids the smallest vector counts; a candidate with the query's id is the query's own row; vectors
of other lengths than the query's are no candidates for it; fewer than k candidates are all returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from edgelens.llm.common import integer_vectors
from edgelens.runtime import importable, stage

QUERY_ROWS, CANDIDATE_ROWS = 512, 8192
BLOCK_BYTES = 4 << 20
DIGIT_BITS = 8
LARGEST = float(1 << 60)  # squared lengths, and so scores, stay below
EXACT_FLOAT = 1 << 53


def quantised(vectors: DataFrame, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """(id, v array<long>) of the usable vectors, one row per id."""
    rows = integer_vectors(vectors, vec_col, scale, LARGEST).select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col("__v").alias("v")).where("id is not null")
    return rows.groupBy("id").agg(F.min("v").alias("v"))


def packed(rows: DataFrame, size: int, more: list[str]) -> DataFrame:
    """Blocks (dim, n, ids, v, more...) of up to size rows, and BLOCK_BYTES of vectors, that have vectors of one length."""
    names = ["dim", "n", "ids", "v", *more]

    def flush(part: dict) -> pa.RecordBatch:
        cols = [[part["dim"]], [len(part["ids"])], [np.array(part["ids"], dtype=np.int64).tobytes()], [np.concatenate(part["v"]).astype(np.int64).tobytes()]]
        cols += [[np.array(part[m], dtype=np.int64).tobytes()] for m in more]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names)

    def run(batches: Iterator[pa.RecordBatch]):
        parts: dict[int, dict] = {}
        for b in batches:
            extra = [b.column(2 + i).to_pylist() for i in range(len(more))]
            flat, off = b.column(1).values.to_numpy(), b.column(1).offsets.to_numpy()
            for i, key in enumerate(b.column(0).to_pylist()):
                v = flat[off[i] : off[i + 1]]
                p = parts.setdefault(len(v), {"dim": len(v), "ids": [], "v": [], **{m: [] for m in more}})
                p["ids"].append(key)
                p["v"].append(v)
                for m, values in zip(more, extra):
                    p[m].append(values[i])
                if len(p["ids"]) >= min(size, max(1, BLOCK_BYTES // (8 * len(v)))):
                    yield flush(parts.pop(len(v)))
        for p in parts.values():
            yield flush(p)

    schema = "dim long, n long, ids binary, v binary" + "".join(f", {m} binary" for m in more)
    return rows.select("id", "v", *more).mapInArrow(run, schema)


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products: in floating point where no sum can leave its exact range."""
    bound = (np.abs(q).max(initial=0).astype(np.float64) + 1) * (np.abs(c).max(initial=0).astype(np.float64) + 1) * q.shape[1]
    if bound < EXACT_FLOAT:
        return (q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
    return q @ c.T


def top_k(
    vectors: DataFrame, is_query, k: int = 20, scale: int = 64, id_col: str = "vec_id", vec_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, id_col, score) of the k best candidates of every row for which the condition
    is_query on the column id holds."""
    spark = vectors.sparkSession
    importable(spark)
    rows = stage(quantised(vectors, scale, id_col, vec_col), "topk-vectors")
    blocks = stage(packed(rows, CANDIDATE_ROWS, []), "topk-blocks")
    facts = rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c)).alias("norm")).first()
    n_blocks = blocks.count()
    strata = max(1, min(n_blocks, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    candidates = blocks.select(F.pmod(F.xxhash64("ids"), F.lit(strata)).alias("stratum"), "dim", F.col("n").alias("cn"), F.col("ids").alias("cids"), F.col("v").alias("cv"))
    # no score is larger in size than the largest squared norm
    bits = max(1, int(facts["norm"] or 0).bit_length() + 2)
    levels = -(-bits // DIGIT_BITS)
    queries = rows.where(is_query)
    # the lower end of the digit that holds the k-th highest score
    state = queries.select("id", F.lit(-(1 << (levels * DIGIT_BITS - 1))).cast("long").alias("low"))
    names = {"hist": ("id long, bin long, n long", ["id", "bin", "n"]), "keep": ("query_id long, vec_id long, score long", ["query_id", "vec_id", "score"])}

    def pairs(state: DataFrame, width_bits: int, mode: str) -> DataFrame:
        packed_queries = packed(queries.join(state, "id"), QUERY_ROWS, ["low"])
        spread = packed_queries.withColumn("stratum", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(strata - 1).cast("long"))))
        joined = spread.join(candidates, ["stratum", "dim"])
        schema, cols = names[mode]

        def run(batches):
            for b in batches:
                for r in b.to_pylist():
                    qid, low = np.frombuffer(r["ids"], dtype=np.int64), np.frombuffer(r["low"], dtype=np.int64)
                    cid = np.frombuffer(r["cids"], dtype=np.int64)
                    q = np.frombuffer(r["v"], dtype=np.int64).reshape(-1, r["dim"])
                    c = np.frombuffer(r["cv"], dtype=np.int64).reshape(-1, r["dim"])
                    s = _scores(q, c)
                    own = np.iinfo(np.int64).min
                    s[qid[:, None] == cid[None, :]] = own
                    kth = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k] if s.shape[1] > k else np.full(len(s), own)
                    at_least = np.maximum(kth, low)
                    if mode == "hist":
                        x, y = np.nonzero((s >= at_least[:, None]) & (s > own))
                        # all above the open digit count in one bin past its end
                        digit = np.minimum((s[x, y] - low[x]) >> width_bits, 1 << DIGIT_BITS)
                        key, n = np.unique(x * ((1 << DIGIT_BITS) + 1) + digit, return_counts=True)
                        x, digit = key // ((1 << DIGIT_BITS) + 1), key % ((1 << DIGIT_BITS) + 1)
                        out = [qid[x], digit, n.astype(np.int64)]
                    else:
                        x, y = np.nonzero((s >= at_least[:, None]) & (s > own))
                        order = np.lexsort((cid[y], -s[x, y], x))
                        x, y = x[order], y[order]
                        first = np.searchsorted(x, x, side="left")
                        best = np.arange(len(x)) - first < k
                        x, y = x[best], y[best]
                        out = [qid[x], cid[y], s[x, y]]
                    yield pa.RecordBatch.from_arrays([pa.array(o, type=pa.int64()) for o in out], cols)

        return joined.select("dim", "ids", "v", "low", "cids", "cv").mapInArrow(run, schema)

    for level in range(levels - 1, -1, -1):
        width_bits = level * DIGIT_BITS
        hist = pairs(state, width_bits, "hist").groupBy("id", "bin").agg(F.sum("n").alias("n"))
        above = F.sum("n").over(Window.partitionBy("id").orderBy(F.desc("bin")))
        found = hist.withColumn("upto", above).where(F.col("upto") >= k).groupBy("id").agg(F.max("bin").alias("bin"))
        # a query with fewer than k candidates keeps its lower end, and so all of them
        state = state.join(found, "id", "left").select("id", (F.col("low") + F.coalesce("bin", F.lit(0)) * (1 << width_bits)).alias("low"))
        state = stage(state, "topk-state")
    kept = pairs(state, 0, "keep")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    ranked = kept.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("vec_id").alias(id_col), "score")
