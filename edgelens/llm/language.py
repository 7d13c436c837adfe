"""Language identification by nearest centroid (operator 5).

A text is a vector of hashed byte bigrams and trigrams of its lower-cased letters, weighted log(1 + tf) * idf
and normalised. idf counts all labelled training rows. Each language has up to CENTROIDS centroids, from
spherical k-means over at most SAMPLE_PER_LANGUAGE training rows, those with the smallest hash of their id; repeated rows
are one there.
A text takes the language of the centroid with the highest cosine, which is its score. It is rejected
if that cosine is under REJECT times the first percentile of the sampled texts of that language.

The model is at most MAX_LANGUAGES * CENTROIDS vectors of DIMENSIONS floats and is sent to the tasks.

Defined results: null text and text without a letter is `und`, score 0, rejected; rows with a null label
teach nothing; without training rows everything is `und`; equal cosines go to the smaller label; repeated
rows are judged alike and null ids are ids; a column that is called as a new one is replaced; no rows give no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

from edgelens.llm.common import append_columns, row_key
from edgelens.runtime import importable, stage

BIGRAM_BITS, TRIGRAM_BITS = 11, 12
DIMENSIONS = (1 << BIGRAM_BITS) + (1 << TRIGRAM_BITS)
SAMPLE_PER_LANGUAGE = 256
MAX_LANGUAGES = 256
CENTROIDS = 4
REJECT = 0.5
ROWS = 512
LETTER = regex.compile(r"\p{L}")
#: Bytes as features see them: ASCII other than letters is one blank.
FOLD = np.array([b if b > 127 or chr(b).isalpha() else 32 for b in range(256)], dtype=np.uint8)


def grams(text: str) -> np.ndarray:
    """Counts of the hashed grams of a whole text."""
    b = FOLD[np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), dtype=np.uint8)].astype(np.uint32)
    b = np.concatenate([[np.uint32(32)], b, [np.uint32(32)]]).astype(np.uint32)
    two = b[:-1] << np.uint32(8) | b[1:]
    three = two[:-1] << np.uint32(8) | b[2:]
    mix = np.uint32(2654435761)
    return np.concatenate([
        np.bincount(two * mix >> np.uint32(32 - BIGRAM_BITS), minlength=1 << BIGRAM_BITS),
        np.bincount(three * mix >> np.uint32(32 - TRIGRAM_BITS), minlength=1 << TRIGRAM_BITS),
    ])


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF rows."""
    v = np.log1p(counts, dtype=np.float32) * idf
    norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
    return v / np.where(norm > 0, norm, 1)


def cluster(v: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids of spherical k-means; starts from the first row and each time the row farthest away."""
    picked = [0]
    near = v @ v[0]
    while len(picked) < min(k, len(v)):
        picked.append(int(near.argmin()))
        near = np.maximum(near, v @ v[picked[-1]])
    c = v[picked]
    for _ in range(rounds):
        own = (v @ c.T).argmax(axis=1)
        c = np.stack([v[own == i].sum(axis=0) if (own == i).any() else c[i] for i in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    return c


def document_frequencies(train: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """In how many rows each feature occurs, and the rows; every task adds up its own first."""

    def run(batches):
        df, n = np.zeros(DIMENSIONS, dtype=np.int64), 0
        for b in batches:
            for t in b.column(0):
                df += grams(t.as_py() or "") > 0
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([df.tolist()], type=pa.list_(pa.int64())), pa.array([n])], ["df", "n"])

    parts = train.select(text_col).mapInArrow(run, "df array<long>, n long")
    rows = stage(parts.select(F.posexplode(F.concat("df", F.array("n"))).alias("i", "n")).groupBy("i").agg(F.sum("n").alias("n")), "idf")
    total = np.zeros(DIMENSIONS + 1, dtype=np.int64)
    for r in rows.collect():  # DIMENSIONS + 1 rows
        total[r["i"]] = r["n"]
    return total[:-1], int(total[-1])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict | None:
    """The model from labelled rows; None if there are none."""
    importable(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(lang_col).alias("lang")).where("lang is not null")
    df, n = document_frequencies(rows, "text")
    if not n:
        return None
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    rows = rows.withColumn("key", row_key("id", "text"))
    first = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id", "key")
    keys = rows.select("key", "id", "lang").distinct().withColumn("k", F.row_number().over(first)).where(F.col("k") <= SAMPLE_PER_LANGUAGE)
    keys = stage(keys.select("key", "lang"), "language-sample")
    if keys.select("lang").distinct().count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    # at most MAX_LANGUAGES * SAMPLE_PER_LANGUAGE keys, and one row of each however often it is repeated
    sample = rows.join(F.broadcast(keys), ["key", "lang"], "left_semi").dropDuplicates(["key", "lang"])

    def counter():
        def run(texts: pa.Array):
            return [pa.array([grams(t.as_py()).astype(np.int32).tobytes() if LETTER.search(t.as_py()) else None for t in texts], type=pa.binary())]

        return run

    # the texts, of any length, are counted where they are; a language's group holds vectors only
    counted = append_columns(sample, ["text"], [("counts", "binary")], counter).where("counts is not null").select("id", "lang", "counts")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["id", "counts"])
        v = vectors(np.stack([np.frombuffer(c, dtype=np.int32) for c in pdf["counts"]]), idf)
        c = cluster(v, CENTROIDS)
        floor = REJECT * float(np.quantile((v @ c.T).max(axis=1), 0.01))
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "centroids": [c.astype(np.float32).tobytes()], "floor": [floor]})

    fitted = sorted(counted.groupBy("lang").applyInPandas(fit, "lang string, centroids binary, floor double").collect(), key=lambda r: r["lang"])
    if not fitted:
        return None
    each = [np.frombuffer(r["centroids"], dtype=np.float32).reshape(-1, DIMENSIONS) for r in fitted]
    return {
        "idf": idf, "centroids": np.concatenate(each), "owner": np.repeat(np.arange(len(each)), [len(x) for x in each]),
        "langs": [r["lang"] for r in fitted], "floors": np.array([r["floor"] for r in fitted]),
    }


def predict(docs: DataFrame, model: dict | None, text_col: str = "text") -> DataFrame:
    """docs with lang_pred, score (cosine) and rejected."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def maker():
        m = sent.value

        def run(texts: pa.Array):
            langs, scores = np.full(len(texts), "und", dtype=object), np.zeros(len(texts))
            rejected = np.ones(len(texts), dtype=bool)
            for i in range(0, len(texts) if m else 0, ROWS):
                part = [t.as_py() or "" for t in texts[i : i + ROWS]]
                rows = np.array([k for k, t in enumerate(part) if LETTER.search(t)], dtype=np.int64)
                if not len(rows):
                    continue
                cosine = vectors(np.stack([grams(part[k]) for k in rows]), m["idf"]) @ m["centroids"].T
                best = cosine.argmax(axis=1)
                own = m["owner"][best]
                top = np.clip(cosine[np.arange(len(rows)), best], 0, 1).astype(np.float64)
                langs[i + rows] = np.array(m["langs"], dtype=object)[own]
                scores[i + rows] = top
                rejected[i + rows] = top < m["floors"][own]
            return [pa.array(langs, type=pa.string()), pa.array(scores), pa.array(rejected)]

        return run

    return append_columns(docs, [text_col], [("lang_pred", "string"), ("score", "double"), ("rejected", "boolean")], maker)
