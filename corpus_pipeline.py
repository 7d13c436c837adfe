"""A training corpus from documents: five stages, each a DataFrame written and read by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from edgelens.llm import bpe, language, linededup, mixing, simhash
from edgelens.llm.common import row_key
from edgelens.llm.queries import MIX_SEED, MIX_WEIGHTS
from edgelens.runtime import stage, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: The near-duplicate stage: word shingles and their least Jaccard similarity.
SHINGLE_WORDS, SIMILARITY = 5, 0.8


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled rows and drops what the classifier rejects: null text, text without
    letters, text far from every centroid. Repeated rows are judged alike; where no row is labelled, or the
    table is empty, nothing can be told and no row stays."""
    judged = language.predict(docs.select(*COLUMNS), language.train(docs))
    return judged.where(~F.col("rejected")).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out later repeated runs of lines; n_chars follows the text. No row goes: a null text stays null, a text of
    repeated lines only becomes empty, repeated rows with one id are edited alike, no rows give no rows."""
    out = linededup.dedup_lines(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one document stays, that with the smallest id, then hash of id and text;
    null ids come last. Other documents stay whatever their ids; rows with equal id and text are one document.
    Texts without words, null and empty ones too, are copies of each other; no rows give no rows."""
    groups = simhash.similar_groups(docs, words=SHINGLE_WORDS, similarity=SIMILARITY)
    order = F.struct(F.col("id").isNull(), "id", "key")
    first = groups.groupBy("root").agg(F.min_by("key", order).alias("key")).select("key")
    keyed = docs.select(*COLUMNS, row_key("doc_id", "text").alias("key"))
    return keyed.join(first, "key", "left_semi").dropDuplicates(["key"]).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's weight asks for. Null sources are one source of weight 1, rows of
    null or repeated ids draw each for themselves, no rows give no rows."""
    return mixing.mix(docs.select(*COLUMNS), MIX_WEIGHTS, seed=MIX_SEED).select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds token_ids, n_tokens and the digest of the text decoded from the ids; null and empty texts have no ids."""
    coded = bpe.encode_decode(docs.select(*COLUMNS), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select(*COLUMNS, "token_ids", F.size("token_ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("mix", mix_sources),
    ("tokenize", tokenize),
]

#: Several stages have no SQL; the tests hold each stage's rows against a brute-force version on its own input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, f in STAGES[:-1]:
        docs = stage(f(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
