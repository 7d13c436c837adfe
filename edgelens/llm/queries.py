"""The queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from edgelens.llm import bpe, chat, codes, fingerprint, language, linededup, mixing, negatives, simhash, substrings, tokenfile, topk, url_filter
from edgelens.llm.common import hot_limit, join_hot
from edgelens.runtime import stage, table


def op1_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the text decoded from them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return coded.select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and conversation -1, formatted and read back from the formatted string."""
    probe = "</s>[INST] ok [/INST]"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(
        spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text"))
    )
    out = chat.format_chats(chat.linear_messages(turns))
    out = out.withColumn("turns", chat.parse_turns(F.col("formatted")))
    out = out.withColumn("loss", chat.loss_text(F.col("turns"), F.col("loss_spans")))
    nl = F.lit("\n")
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], nl, t["text"], nl)), "")
    return out.select(
        F.col("conv").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP3_SQL = r"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), u as (
  select *, case role when 'user' then 4 when 'assistant' then 3 when 'system' then 3
      else 5 + length(role) + length(role) - length(replace(replace(replace(replace(role, '\', ''), '[', ''), '<', ''), ']', '')) end as tag,
    length(text) + length(text) - length(replace(replace(replace(text, '\', ''), '[', ''), '<', '')) as body
  from t
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(7 + sum(2 * tag + body + 7) as bigint) as formatted_chars
from u group by conv_id
"""


#: Target weights of the mixing query and stage: the hot source is held to a tenth of an even share.
MIX_WEIGHTS = {"src0": 0.5, "src1": 2.0}
MIX_SEED = 17


def op9_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as often as its source's weight asks for."""
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs, MIX_WEIGHTS, seed=MIX_SEED).select("doc_id", "source", "copy", "n_chars", "text")


OP9_SQL = f"""
with recursive s as (
  select coalesce('+' || source, '-') as src, count(*) as n,
    case coalesce(source, '') when 'src1' then 2.0::double when 'src0' then 0.5::double else 1.0::double end as w
  from documents group by 1, 3
), r as (
  select src, w * (select sum(n)::double from s) / (select sum(w) from s) / n as rate from s
), c(src, k, p, cdf) as (
  select src, 0, exp(-rate), exp(-rate) from r
  union all
  select c.src, c.k + 1, c.p * r.rate / (c.k + 1), c.cdf + c.p * r.rate / (c.k + 1)
  from c join r using (src) where c.k < ceil(r.rate + 10 * sqrt(r.rate) + 20)
), d as (
  select doc_id, source, n_chars, text, coalesce('+' || source, '-') as src,
    ('0x' || md5('{MIX_SEED}|' || coalesce(doc_id::varchar, '') || '|' || coalesce(source, ''))[1:13])::bigint::double / 4503599627370496.0 as u
  from documents
), counted as (
  select d.doc_id, d.source, d.n_chars, d.text, count(*) filter (c.cdf <= d.u) as copies
  from d join c using (src) group by d.doc_id, d.source, d.n_chars, d.text
)
select doc_id, source, unnest(range(copies))::int as copy, n_chars, text from counted where copies > 0
"""

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op10_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL against the rules."""
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


OP10_SQL = r"""
with u as (
  select page_id,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') as path
  from pages
), r(h, p, v) as (
  values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), m as (
  select page_id, max_by(h || p, length(h || p)) as rule, max_by(v, length(h || p)) as v
  from u join r on (u.host = r.h or ends_with(u.host, '.' || r.h)) and starts_with(u.path, r.p) group by page_id
)
select u.page_id, u.host, u.path, m.rule, coalesce(m.v, 'allow') as verdict from u left join m using (page_id)
"""


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of all vectors for each whose id is divisible by 20."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


OP2_SQL = """
with v as (
  select vec_id, [floor(64 * x::double)::bigint for x in embedding] as q from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len([x for x in embedding if x is not null and isfinite(x)]) = len(embedding)
), s as (
  select a.vec_id as query_id, b.vec_id, list_sum([z[1] * z[2] for z in list_zip(a.q, b.q)])::bigint as score
  from v a join v b on a.vec_id % 20 = 0 and a.vec_id <> b.vec_id
)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
from s qualify rank <= 20
"""


def op4_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written to the block file and read back."""
    path = tokenfile.new_path(spark)
    tokenfile.write(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path)
    return tokenfile.digests(spark, path)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its later repeated runs of lines."""
    return linededup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines_removed", "text")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learned from the rows whose crc32(doc_id) mod 5 is not 0."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.crc32(F.col("doc_id").cast("string")) % 5 == 0)
    model = language.train(docs.where(~F.coalesce("held_out", F.lit(True))))
    return language.predict(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op6_multiset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, and that of its edited text."""
    return fingerprint.neighbour_fingerprints(table(spark, sf_dir, "documents"))


def op8_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and component."""
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of five positives of every row whose id is divisible by 50."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return negatives.hard_negatives(vectors, F.col("id") % 50 == 0)


OP11_SQL = """
with v as materialized (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, [floor(256 * x::double)::bigint for x in embedding] as q from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(embedding) > 0
    and len([x for x in embedding if x is not null and isfinite(x)]) = len(embedding)
), s as materialized (
  select a.vec_id as anchor_id, b.vec_id, a.label = b.label as alike, list_sum([z[1] * z[2] for z in list_zip(a.q, b.q)])::bigint as score
  from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id
), p as (
  select anchor_id, vec_id as positive_id, score as positive_score from s where alike
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select p.anchor_id, positive_id, row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id)::int as rank, vec_id as negative_id, positive_score, score as negative_score
from p join s on p.anchor_id = s.anchor_id and not alike and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
qualify rank <= 3
"""


def op12_ball_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's code and error, and the error of all vectors with its label."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    coded, books = codes.compress(vectors, ["vec_id", "label"])
    coded = stage(coded.withColumn("key", F.coalesce(F.concat(F.lit("+"), F.col("label").cast("string")), F.lit("-"))), "codes")
    totals = stage(coded.groupBy("key").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")), "code-errors")
    out = join_hot(coded, totals, ["key"], "n", hot_limit(coded.count()))
    code = F.array_join(F.transform("code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return out.select("vec_id", code.alias("code"), "error", "label_error", F.lit(codes.digest(books)).alias("codebooks_sha256"))


def _op12_sql() -> str:
    """The four rounds as CTEs: codebooks c0 to c4, parts' entries a0 to a4."""
    floors = "(x - ((x % n) + n) % n) // n"  # rounds down for either sign
    out = """
with recursive v as materialized (
  select row_number() over (order by vec_id nulls last, embedding) as i, vec_id, label, [floor(1024 * x::double)::bigint for x in embedding] as q from embeddings
  where embedding is not null and len(embedding) > 0 and len([x for x in embedding if x is not null and isfinite(x)]) = len(embedding)
), w as materialized (
  select i, p, q[1 + p * (len(q) // 4) : (p + 1) * (len(q) // 4)] as x from v, range(4) t(p)
), c0 as materialized (
  select p, i - 1 as e, x from w where i <= 256
)"""
    for r in range(5):
        out += f""", a{r} as materialized (
  select i, p, min({{'d': d, 'e': e}}) as best from (
    select i, w.p, e, list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(w.x, c.x)])::bigint as d from w join c{r} c on w.p = c.p
  ) group by i, p
)"""
        if r < 4:
            out += f""", m{r} as materialized (
  select p, e, list({floors} order by k) as x from (
    select w.p, a.best.e as e, k, sum(w.x[k])::bigint as x, count(*) as n
    from w join a{r} a on w.i = a.i and w.p = a.p, unnest(range(1, len(w.x) + 1)) t(k) group by w.p, a.best.e, k
  ) group by p, e
), c{r + 1} as materialized (
  select c.p, c.e, coalesce(m.x, c.x) as x from c{r} c left join m{r} m on c.p = m.p and c.e = m.e
)"""
    return out + """, coded as (
  select i, string_agg(lpad(lower(to_hex(best.e)), 2, '0'), '' order by p) as code, sum(best.d)::bigint as error from a4 group by i
)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
  (select sha256(string_agg(array_to_string(x, ','), ',' order by p, e)) from c4) as codebooks_sha256
from v join coded using (i)
"""


OP12_SQL = _op12_sql()


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of windows that a smaller doc_id has."""
    out = substrings.dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_bpe_codec, op2_topk_search, op3_chat_format, op4_token_file, op5_language, op6_multiset_fingerprint, op7_line_dedup, op8_simhash_groups, op9_poisson_mix, op10_url_verdicts, op11_hard_negatives, op12_ball_kmeans, op13_substring_dedup,
    )}


def oracle_sql() -> dict[str, str]:
    return {"op2_topk_search": OP2_SQL, "op3_chat_format": OP3_SQL, "op9_poisson_mix": OP9_SQL, "op10_url_verdicts": OP10_SQL, "op11_hard_negatives": OP11_SQL, "op12_ball_kmeans": OP12_SQL}
