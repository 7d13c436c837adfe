"""Hard-negative mining by coordinate pruning in the manner of LEMP (operator 11).

Vectors become integers; a score is an inner product. The index cuts the vectors, the longest first, into buckets of vectors of
like length; a bucket holds for each coordinate the list of its rows sorted by that coordinate of their unit vectors. An
anchor looks for its k best scores inside windows of scores. With the least score that still counts, and the bucket's
greatest length, goes a least cosine; buckets too short for it are passed over, and of the others only rows can
count whose value lies, on each of the anchor's focus coordinates (its largest ones), within the range that this cosine
leaves. The rows in all of these ranges, cut out of the sorted lists, are the candidates; they are scored exactly.

Two searches follow each other: the positives, the best rows of the anchor's label, over buckets of one label each; then the negatives
of each positive, the best rows of other labels with scores in the positive's window, over buckets of all labels.
Each begins with one bucket per anchor, whose k-th best score bounds the search through the rest from below.
Anchors meet buckets in blocks, by an equi-join on a stratum of the buckets; a bucket and an anchor return at most k rows.
Nothing is broadcast: Spark judges a table by its files, and blocks that go to each stratum are many times theirs, so joins are by
shuffle whatever the files' size.

Defined results: rows whose id or label is null, or whose vector is null, empty or holds null or non-finite components, take no part,
nor do those whose scaled squared length reaches 2**60; of repeated ids the row with the smallest label, then vector, counts; vectors
of another length than the anchor's are no partners; labels are whole numbers; positives of negative score have no negatives, as
their window is empty; fewer partners than asked for are all returned; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from edgelens.llm.common import integer_vectors
from edgelens.runtime import importable, stage

SCALE, POSITIVES, NEGATIVES = 256, 5, 3
#: Per cent of the positive's score that a negative's has at least and at most.
LEAST, MOST = 50, 95
FOCUS = 5
BUCKET_ROWS, ANCHOR_ROWS, BLOCK_BYTES = 4096, 256, 1 << 21
#: A bucket ends where squared lengths fall below this share of its first, once it has an eighth of its rows.
LIKE_LENGTH = 0.8
LARGEST = float(1 << 60)
EXACT_FLOAT = 1 << 53
FAR = (1 << 62) - 1
SALTS = 32


@dataclass
class Bucket:
    """Rows of like length with the sorted list of each coordinate."""

    ids: np.ndarray
    labels: np.ndarray
    v: np.ndarray
    order: np.ndarray  # coordinate x rows

    def __post_init__(self) -> None:
        x = self.v.astype(np.float64)
        norms = np.sqrt((x * x).sum(1))
        self.longest = float(norms.max(initial=0))
        self.unit = x / np.maximum(norms, 1)[:, None]
        self.largest = float(np.abs(x).max(initial=0))


def sorted_lists(v: np.ndarray) -> np.ndarray:
    """For each coordinate the rows by its value in their unit vectors."""
    x = v.astype(np.float64)
    x /= np.maximum(np.sqrt((x * x).sum(1)), 1)[:, None]
    return np.argsort(x, axis=0, kind="stable").T.astype(np.uint16)


def feasible(q: float, cosine: float) -> tuple[float, float]:
    """The values of a coordinate of the unit vectors that have at least this cosine with one whose value there is q."""
    reach = np.sqrt(max(0.0, (1 - cosine * cosine) * (1 - q * q)))
    low = -1.0 if q <= -cosine else q * cosine - reach
    high = 1.0 if q >= cosine else q * cosine + reach
    return low - 1e-9, high + 1e-9


def candidates(b: Bucket, q: np.ndarray, least: np.ndarray, focus: int) -> np.ndarray:
    """(anchors x rows) which rows can have a score of at least `least` with each anchor."""
    out = np.zeros((len(q), len(b.ids)), dtype=bool)
    x = q.astype(np.float64)
    norms = np.sqrt((x * x).sum(1))
    for i in range(len(q)):
        if least[i] <= 0:
            out[i] = True
            continue
        cosine = float(least[i]) / max(norms[i] * b.longest, 1e-300)
        if cosine > 1 + 1e-9:
            continue
        unit, cosine = x[i] / norms[i], min(cosine, 1.0)
        hits = np.zeros(len(b.ids), dtype=np.uint8)
        axes = np.argsort(-np.abs(unit), kind="stable")[:focus]
        for f in axes:
            low, high = feasible(unit[f], cosine)
            rows = b.order[f]
            a, z = np.searchsorted(b.unit[:, f], [low, high], sorter=rows)
            hits[rows[a:z]] += 1
        out[i] = hits == len(axes)
    return out


def scored(b: Bucket, q: np.ndarray, may: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of the candidates."""
    a, r = np.nonzero(may)
    if not len(a):
        return a, r, np.zeros(0, dtype=np.int64)
    exact = (float(np.abs(q).max(initial=0)) + 1) * (b.largest + 1) * q.shape[1] < EXACT_FLOAT
    if exact and len(a) > 0.1 * may.size:  # a matrix product is cheaper than picking out so many
        return a, r, (q.astype(np.float64) @ b.v.T.astype(np.float64))[a, r].astype(np.int64)
    return a, r, np.concatenate([(q[a[i : i + 65536]] * b.v[r[i : i + 65536]]).sum(1) for i in range(0, len(a), 65536)])


@dataclass
class Anchors:
    """Anchors with their windows of scores, padded to the same number by empty ones."""

    ids: np.ndarray
    labels: np.ndarray
    v: np.ndarray
    tag: np.ndarray  # anchors x windows
    low: np.ndarray
    high: np.ndarray

    def best_in(self, b: Bucket, k: int, other: bool, focus: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, window, row, score): each window's k best rows of the bucket, the best first."""
        usable = self.low <= self.high
        least = np.where(usable, self.low, FAR).min(1)
        a, r, s = scored(b, self.v, candidates(b, self.v, least, focus))
        right = (b.labels[r] != self.labels[a] if other else b.labels[r] == self.labels[a]) & (b.ids[r] != self.ids[a]) & (s >= least[a])
        a, r, s = a[right], r[right], s[right]
        out = []
        for w in range(self.low.shape[1]):
            inside = (s >= self.low[a, w]) & (s <= self.high[a, w])
            x, y, z = a[inside], r[inside], s[inside]
            order = np.lexsort((b.ids[y], -z, x))
            x, y, z = x[order], y[order], z[order]
            first = np.arange(len(x)) - np.searchsorted(x, x, side="left") < k
            out.append((x[first], np.full(first.sum(), w), y[first], z[first]))
        return tuple(np.concatenate(c) for c in zip(*out))

    def raised(self, b: Bucket, k: int, other: bool, focus: int) -> np.ndarray:
        """The windows' lower ends, raised to the bucket's k-th best score where it has so many."""
        a, w, _, s = self.best_in(b, k, other, focus)
        low = self.low.copy()
        key = a * low.shape[1] + w
        order = np.lexsort((-s, key))
        at, start, n = np.unique(key[order], return_index=True, return_counts=True)
        full = n >= k
        kth = s[order][start[full] + k - 1]
        flat = low.reshape(-1)
        flat[at[full]] = np.maximum(flat[at[full]], kth)
        return low


def ints(x) -> bytes:
    return np.ascontiguousarray(x, dtype=np.int64).tobytes()


def bucket_from(r: dict) -> Bucket:
    v = np.frombuffer(r["bv"], dtype=np.int64).reshape(-1, r["dim"])
    return Bucket(np.frombuffer(r["bids"], dtype=np.int64), np.frombuffer(r["blabels"], dtype=np.int64), v, np.frombuffer(r["border"], dtype=np.uint16).reshape(r["dim"], -1))


def anchors_from(r: dict) -> Anchors:
    ids = np.frombuffer(r["ids"], dtype=np.int64)
    tag, low, high = (np.frombuffer(r[c], dtype=np.int64).reshape(len(ids), -1) for c in ("tag", "low", "high"))
    return Anchors(ids, np.frombuffer(r["labels"], dtype=np.int64), np.frombuffer(r["v"], dtype=np.int64).reshape(len(ids), -1), tag, low, high)


def usable_rows(vectors: DataFrame, id_col: str, label_col: str, vec_col: str, scale: int) -> DataFrame:
    """(id, label, v, norm, dim), one row an id."""
    rows = integer_vectors(vectors, vec_col, scale, LARGEST).select(F.col(f"`{id_col}`").cast("long").alias("id"), F.struct(F.col(f"`{label_col}`").cast("long").alias("label"), F.col("__v").alias("v")).alias("x"))
    rows = rows.where(F.col("id").isNotNull() & F.col("x.label").isNotNull()).groupBy("id").agg(F.min("x").alias("x")).select("id", "x.label", "x.v")
    return rows.withColumn("norm", F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c)).withColumn("dim", F.size("v"))


def index(rows: DataFrame, by: Column, n_rows: int) -> DataFrame:
    """Buckets (g, dim, stratum, bucket, longest, bids, blabels, bv, border) of rows that agree in by, g."""
    parts = max(1, min(n_rows // (2 * BUCKET_ROWS) + 1, 1 << 20))
    strata = max(1, min(n_rows // BUCKET_ROWS + 1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    names = ["g", "dim", "longest", "bids", "blabels", "bv", "border"]

    def flush(part: list) -> pa.RecordBatch:
        (g, dim), ids, labels, v = part[0][:2], [p[2] for p in part], [p[3] for p in part], np.stack([p[5] for p in part])
        cols = [[g], [dim], [part[0][4]], [ints(ids)], [ints(labels)], [ints(v)], [sorted_lists(v).tobytes()]]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.float64()), *[pa.array(c, pa.binary()) for c in cols[3:]]], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part: list = []
        for b in batches:
            flat, off = b.column(5).values.to_numpy(), b.column(5).offsets.to_numpy()
            for i, (g, dim, own, label, norm) in enumerate(zip(*[c.to_pylist() for c in b.columns[:5]])):
                size = max(1, min(BUCKET_ROWS, BLOCK_BYTES // (8 * dim)))
                if part and (part[0][:2] != (g, dim) or len(part) >= size or len(part) >= size // 8 and norm < LIKE_LENGTH * part[0][4]):
                    yield flush(part)
                    part = []
                part.append((g, dim, own, label, norm, flat[off[i] : off[i + 1]]))
        if part:
            yield flush(part)

    order = ["g", "dim", F.desc("norm"), "id"]
    dealt = rows.withColumn("g", by.cast("long")).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    buckets = dealt.select("g", "dim", "id", "label", "norm", "v").mapInArrow(run, "g long, dim int, longest double, bids binary, blabels binary, bv binary, border binary")
    return stage(buckets.withColumn("bucket", F.xxhash64("g", "dim", "bids")).withColumn("stratum", F.pmod("bucket", F.lit(strata))), "negatives-index")


def packed(anchors: DataFrame) -> DataFrame:
    """Blocks (g, dim, ids, labels, v, tag, low, high) of anchors (g, dim, id, label, v, windows)."""
    names = ["g", "dim", "ids", "labels", "v", "tag", "low", "high"]

    def flush(key: tuple, part: list) -> pa.RecordBatch:
        wide = max(len(p[3]) for p in part)
        tag, low, high = np.zeros((len(part), wide), np.int64), np.ones((len(part), wide), np.int64), np.zeros((len(part), wide), np.int64)
        for i, p in enumerate(part):
            for j, w in enumerate(p[3]):
                tag[i, j], low[i, j], high[i, j] = w["tag"], w["low"], w["high"]
        cols = [ints([p[0] for p in part]), ints([p[1] for p in part]), ints(np.stack([p[2] for p in part])), ints(tag), ints(low), ints(high)]
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int32()), *[pa.array([c], pa.binary()) for c in cols]], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[tuple, list] = {}
        held = 0
        for b in batches:
            flat, off = b.column(4).values.to_numpy(), b.column(4).offsets.to_numpy()
            for i, (g, dim, own, label, wins) in enumerate(zip(*[b.column(c).to_pylist() for c in (0, 1, 2, 3, 5)])):
                part = parts.setdefault((g, dim), [])
                part.append((own, label, flat[off[i] : off[i + 1]], wins))
                held += 1
                if len(part) >= max(1, min(ANCHOR_ROWS, BLOCK_BYTES // (8 * dim))):
                    held -= len(part)
                    yield flush((g, dim), parts.pop((g, dim)))
                if held >= 64 * ANCHOR_ROWS:  # anchors of very many labels
                    for key in list(parts):
                        yield flush(key, parts.pop(key))
                    held = 0
        for key, part in parts.items():
            yield flush(key, part)

    return anchors.select("g", "dim", "id", "label", "v", "windows").mapInArrow(run, "g long, dim int, ids binary, labels binary, v binary, tag binary, low binary, high binary")


def shuffled(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """left joined with right by sorting both, never by a broadcast."""
    return left.join(right.hint("merge"), keys)


def search(anchors: DataFrame, buckets: DataFrame, k: int, other: bool, focus: int) -> DataFrame:
    """(id, tag, partner, score): the k best partners in each window of each anchor."""
    own = ["g", "dim", "ids", "labels", "v", "tag", "low", "high"]
    content = ["bids", "blabels", "bv", "border"]
    strata = buckets.groupBy("g", "dim", "stratum").agg(F.max_by("bucket", F.struct("longest", "bucket")).alias("seed"))
    strata = strata.groupBy("g", "dim").agg(F.array_sort(F.collect_list(F.struct("stratum", "seed"))).alias("strata"))  # at most as many as shuffle partitions
    strata = strata.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    blocks = packed(anchors).withColumn("hash", F.xxhash64("ids")).withColumn("salt", F.pmod("hash", F.lit(SALTS)).cast("int"))
    blocks = shuffled(blocks, strata, ["g", "dim", "salt"])
    seed = F.element_at("strata", (F.pmod(F.shiftright("hash", 8), F.size("strata")) + 1).cast("int"))["seed"]
    seeded = shuffled(blocks.withColumn("bucket", seed), buckets.select("bucket", *content), ["bucket"])
    state = f"{', '.join(f'{c} {t}' for c, t in zip(own, ['long', 'int', *['binary'] * 6]))}, strata array<long>"

    def raise_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            low = [ints(anchors_from(r).raised(bucket_from(r), k, other, focus)) for r in b.select([*own, *content]).to_pylist()]
            cols = [pa.array(low, pa.binary()) if c == "low" else b.column(c) for c in [*own, "strata"]]
            yield pa.RecordBatch.from_arrays(cols, [*own, "strata"])

    bounded = seeded.select(*own, F.transform("strata", lambda s: s["stratum"]).alias("strata"), *content).mapInArrow(raise_, state)
    bounded = stage(bounded, "negatives-anchors").withColumn("stratum", F.explode("strata")).drop("strata")
    pairs = shuffled(bounded, buckets.select("g", "dim", "stratum", *content), ["g", "dim", "stratum"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                a, bucket = anchors_from(r), bucket_from(r)
                x, w, y, s = a.best_in(bucket, k, other, focus)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (a.ids[x], a.tag[x, w], bucket.ids[y], s)], ["id", "tag", "partner", "score"])

    hits = pairs.select(*own, *content).mapInArrow(find, "id long, tag long, partner long, score long")
    rank = F.row_number().over(Window.partitionBy("id", "tag").orderBy(F.desc("score"), "partner"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST, scale: int = SCALE, focus: int = FOCUS,
    id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows for which the condition
    is_anchor on the column id holds; scores from least to most per cent of the positive's make a negative."""
    spark = vectors.sparkSession
    importable(spark)
    rows = stage(usable_rows(vectors, id_col, label_col, vec_col, scale), "negatives-rows")
    n = rows.count()
    anchors = rows.where(is_anchor).select("id", "label", "dim", "v")
    window = lambda tag, low, high: F.struct(tag.cast("long").alias("tag"), low.cast("long").alias("low"), high.cast("long").alias("high"))
    any_score = anchors.withColumn("g", F.col("label")).withColumn("windows", F.array(window(F.lit(0), F.lit(-FAR), F.lit(FAR))))
    found = search(any_score, index(rows, F.col("label"), n), positives, False, focus)
    found = stage(found.select("id", F.col("partner").alias("positive_id"), F.col("score").alias("positive_score")), "negatives-positives")
    p = F.col("positive_score")
    whole, rest = F.expr("positive_score div 100"), p % 100  # products that stay within 64 bits
    low = whole * least + F.ceil(rest * least / F.lit(100)).cast("long")
    high = whole * most + F.floor(rest * most / F.lit(100)).cast("long")
    wanted = found.where(p >= 0).groupBy("id").agg(F.collect_list(window(F.col("positive_id"), low, high)).alias("windows"))  # `positives` at most
    second = shuffled(anchors, wanted, ["id"]).withColumn("g", F.lit(0).cast("long"))
    hits = search(second, index(rows, F.lit(0), n), negatives, True, focus)
    hits = hits.select("id", F.col("tag").alias("positive_id"), "rank", F.col("partner").alias("negative_id"), F.col("score").alias("negative_score"))
    out = shuffled(hits, found, ["id", "positive_id"])
    return out.select(F.col("id").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score")
