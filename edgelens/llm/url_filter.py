"""URL filters: a blocked Bloom filter lets possible hits through to an exact hash join (operator 10).

A rule is a canonical host suffix and a path prefix. A URL has one candidate key for each host suffix
and each path length that occurs among the rules. The filter is an array of blocks of four 64-bit
words; a key sets or tests one bit of each word of one block, so a test touches one block. Keys that
pass are joined with the rules by equality, which removes the filter's false positives.

The filter's size follows from the number of rules. Its blocks are a table and the test is an equi-join on the
block number, by broadcast up to MAX_FILTER_BLOCKS (16 MiB of words). Of a host only suffixes with at most as many
labels as the longest rule's are candidates, so that a long host costs no more than its length.

Defined results: null URLs and URLs without "://" have empty host and path and the default verdict;
of fitting rules the longest (host and path together) wins, then block, then the largest by name;
repeated rules count once; rules that fit nothing change nothing; repeated URLs are judged alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

KEYS_PER_BLOCK = 16
MAX_FILTER_BLOCKS = 1 << 19
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """From after the first :// up to / ? # or the end, A-Z in lower case."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the host's end up to ? # or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _bits(key: Column) -> list[Column]:
    """One bit in each of the four words of a key's block."""
    h = F.xxhash64(key, F.lit(1))
    return [
        F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
        for i in range(4)
    ]


def bloom_blocks(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, words array<long>) of the keys."""
    bits = _bits(F.col(key))
    return (
        keys.select(F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block"), *[b.alias(f"w{i}") for i, b in enumerate(bits)])
        .groupBy("block")
        .agg(F.array(*[F.bit_or(f"w{i}") for i in range(4)]).alias("words"))
    )


def maybe_listed(rows: DataFrame, key: str, rules: DataFrame, n_rules: int) -> DataFrame:
    """The rows whose key is in the rules' key column, and a few others."""
    blocks = max(1, -(-n_rules // KEYS_PER_BLOCK))
    table = bloom_blocks(rules, key, blocks)
    tests = _bits(F.col(key))

    def passes(words: Column) -> Column:
        out = F.lit(True)
        for i, b in enumerate(tests):
            out = out & (words[i].bitwiseAND(b) != 0)
        return out

    table = table.withColumnRenamed("block", "__block")
    table = F.broadcast(table) if blocks <= MAX_FILTER_BLOCKS else table
    joined = rows.withColumn("__block", F.pmod(F.xxhash64(key), F.lit(blocks))).join(table, "__block")
    return joined.where(passes(F.col("words"))).drop("__block", "words")


def judge(
    urls: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow"
) -> DataFrame:
    """(id, host, path, rule, verdict) of every URL. rules: (host, path, verdict), canonical.

    The lengths of the rules' paths are gathered on the driver; their number is bounded by the longest
    path, not by the number of rules.
    """
    rules = rules.select(
        F.concat_ws("\n", "host", "path").alias("__key"), F.concat("host", "path").alias("rule"),
        F.length(F.concat("host", "path")).alias("__len"), F.col("verdict").alias("__verdict"),
    ).dropDuplicates()
    facts = rules.agg(
        F.count("*").alias("n"), F.collect_set(F.length(F.substring_index("__key", "\n", -1))).alias("lengths"),
        F.max(F.size(F.split(F.substring_index("__key", "\n", 1), r"\."))).alias("labels"),
    ).first()
    base = urls.select(F.col(id_col).alias("__id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    if not facts["n"]:
        return base.select(F.col("__id").alias(id_col), "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(labels), F.lit(facts["labels"]))), lambda n: F.array_join(F.slice(labels, F.size(labels) - n + 1, n), ".")
    )
    prefixes = F.filter(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sorted(facts["lengths"])]), lambda p: p.isNotNull())
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat_ws("\n", s, p))))
    # the candidates need the URL's distinct (host, path) only: repeated URLs are looked up once
    distinct = base.where(F.col("host") != "").select("host", "path").distinct()
    candidates = distinct.select("host", "path", F.explode(F.array_distinct(keys)).alias("__key"))
    hits = maybe_listed(candidates, "__key", rules, facts["n"]).join(rules, "__key")
    blocked = F.when(F.col("__verdict") == "block", 1).otherwise(0)
    best = hits.groupBy("host", "path").agg(
        F.max_by(F.struct("rule", "__verdict"), F.struct(F.col("__len"), blocked, F.col("rule"))).alias("__best")
    )
    return base.join(best, ["host", "path"], "left").select(
        F.col("__id").alias(id_col), "host", "path", F.col("__best.rule").alias("rule"),
        F.coalesce("__best.__verdict", F.lit(default)).alias("verdict"),
    )
