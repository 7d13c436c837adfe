"""Document fingerprints: a homomorphic hash of a document's multiset of paragraphs (operator 6).

Each paragraph (between line feeds) is hashed to a wide vector; a document's fingerprint is the sum of its
paragraphs' vectors, lane by lane, modulo 2**32. Sums do not depend on order, and a paragraph is
inserted or deleted by adding or subtracting its vector. The first EXACT lanes are uniform (SHAKE-128 of
the paragraph): equal fingerprints mean equal multisets of paragraphs, but for chance 2**-1024. The other
SKETCH lanes add +1 or -1 for each 16-byte gram in the paragraph, or for the whole paragraph if shorter;
the cosine of two sketches estimates the cosine of the documents' gram counts within about
1 / sqrt(SKETCH).

Defined results: null text is the empty text, one empty paragraph; equal texts have equal fingerprints;
repeated rows are neighbours ordered by text; a sole document is its own next; tables without rows give
no rows; texts of any length are hashed whole.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from edgelens.runtime import importable

EXACT, SKETCH = 32, 256
GRAM = 16
# Fixed odd multipliers of the gram hash.
STEPS = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
FINAL = np.uint64(0xFF51AFD7ED558CCD)


def vector(text: str) -> np.ndarray:
    """The sum of the vectors of the text's paragraphs: EXACT + SKETCH unsigned 32-bit lanes."""
    raw = text.encode("utf-8", "surrogatepass")
    paragraphs = raw.split(b"\n")
    digests = b"".join([hashlib.shake_128(p).digest(4 * EXACT) for p in paragraphs])
    exact = np.frombuffer(digests, dtype="<u4").reshape(-1, EXACT).sum(axis=0, dtype=np.uint32)
    b = np.frombuffer(raw, dtype=np.uint8)
    hashes = [np.zeros(0, dtype=np.uint64)]
    if len(b) >= GRAM:
        x, width = b.astype(np.uint64), 1
        for k in STEPS:
            x = x[:-width] * k + x[width:]
            width *= 2
        if len(paragraphs) > 1:
            breaks = np.cumsum(np.concatenate([[0], b == 10]))
            x = x[breaks[GRAM:] == breaks[:-GRAM]]
        hashes.append(x)
    short = [p for p in paragraphs if 0 < len(p) < GRAM]
    if short:
        hashes.append(np.array([int.from_bytes(hashlib.blake2b(p, digest_size=8).digest(), "little") for p in short], dtype=np.uint64))
    x = np.concatenate(hashes)
    x = (x ^ x >> np.uint64(32)) * FINAL
    count = np.bincount((x >> np.uint64(55)).astype(np.int64), minlength=2 * SKETCH)
    return np.concatenate([exact, (count[::2] - count[1::2]).astype(np.uint32)])


def replaced(whole: np.ndarray, removed: str, inserted: str) -> np.ndarray:
    """The fingerprint after taking out and putting in whole paragraphs."""
    return whole - vector(removed) + vector(inserted)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Between 0 and 1; 1 for equal fingerprints."""
    if np.array_equal(a, b):
        return 1.0
    x, y = a[EXACT:].view(np.int32).astype(np.float64), b[EXACT:].view(np.int32).astype(np.float64)
    norm = np.sqrt((x @ x) * (y @ y))
    return float(min(1.0, max(0.0, x @ y / norm))) if norm else 0.0


def text_of(v: np.ndarray) -> str:
    return base64.b64encode(v.astype("<u4").tobytes()).decode()


def edited_pair(text: str, after: str, whole: np.ndarray) -> tuple[str, np.ndarray]:
    """The text with its last half replaced by the next text's start, and its fingerprint, which is
    updated from the text's own by the paragraphs that changed."""
    half = len(text) // 2
    cut = len(text) - half
    edited = text[:cut] + after[:half]
    start = text.rfind("\n", 0, cut) + 1
    return edited, replaced(whole, text[start:], edited[start:])


def neighbour_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    Documents are dealt out once, by ranges of their id; the first document of each range is also sent
    to the range before it (of the first range, to the last), so each sees its successor.
    """
    spark = docs.sparkSession
    importable(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # one number per range on the driver
    wanted = [i / parts for i in range(1, parts)]
    bounds = rows.where("id is not null").stat.approxQuantile("id", wanted, 0.2 / parts) if wanted else []
    bounds = np.array(sorted(set(bounds)), dtype=np.int64)

    @F.pandas_udf("long")
    def bucket_of(ids: pd.Series) -> pd.Series:
        known = ids.fillna(np.iinfo(np.int64).min).astype(np.int64)
        return pd.Series(np.searchsorted(bounds, known.to_numpy(), side="right"))

    placed = rows.withColumn("bucket", bucket_of("id"))
    firsts = sorted((r["bucket"], r["first"]) for r in rows.select("id").withColumn("bucket", bucket_of("id")).groupBy("bucket").agg(F.min(F.coalesce("id", F.lit(-(1 << 63)))).alias("first")).collect())
    if not firsts:
        firsts = [(0, 0)]
    before = {b: firsts[i - 1][0] for i, (b, _) in enumerate(firsts)}
    first = F.lit([dict(firsts).get(b) for b in range(len(bounds) + 1)]).cast("array<long>")
    back = F.lit([before.get(b) for b in range(len(bounds) + 1)]).cast("array<long>")
    is_first = F.coalesce("id", F.lit(-(1 << 63))) == F.get(first, F.col("bucket").cast("int"))
    here = F.struct(F.col("bucket").alias("to"), F.lit(0).alias("ahead"))
    copies = F.when(is_first, F.array(here, F.struct(F.get(back, F.col("bucket").cast("int")).alias("to"), F.lit(1).alias("ahead")))).otherwise(F.array(here))
    dealt = (
        placed.select("id", "text", F.explode(copies).alias("c"))
        .select(F.col("c.to").alias("to"), F.col("c.ahead").alias("ahead"), "id", "text")
        .repartitionById(len(bounds) + 1, F.col("to").cast("int"))
        .sortWithinPartitions("to", "ahead", "id", "text")
    )
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches):
        held = None  # (range, id, text, fingerprint), until its successor comes
        for batch in batches:
            out = []
            for to, ahead, i, text in zip(*[c for c in batch.columns[:3]], batch.column(3)):
                to, ahead, i, text = to.as_py(), ahead.as_py(), i.as_py(), text.as_py()
                v = vector(text) if held is None or not (ahead and held[0] != to) else None
                if held is not None and held[0] == to:
                    edited, w = edited_pair(held[2], text, held[3])
                    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                    out.append((held[1], len(held[2]), digest, text_of(held[3]), text_of(w), likeness(held[3], w), likeness(held[3], v)))
                held = None if ahead else (to, i, text, v)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)

    schema = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return dealt.mapInArrow(run, schema).withColumnRenamed("id", id_col)
