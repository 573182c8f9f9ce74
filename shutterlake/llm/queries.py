"""The queries of this subpackage and their DuckDB equivalents."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shutterlake.llm import (
    align,
    ann,
    bpe,
    chat,
    embed_dedup,
    langid,
    licenses,
    lm,
    mixing,
    simhash,
    toxicity,
    variants,
    warc,
)
from shutterlake.llm.common import crc_remainder, ensure_shared, shared_path

Query = Callable[[SparkSession, str], DataFrame]
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ensure_shared(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, folder, "embeddings"))


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.groups(table(spark, folder, "documents"), "doc_id", "text")
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Learns from the labelled documents outside the held-out fold and grades all documents."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = crc_remainder("doc_id", 5) == 1
    model = toxicity.learn(docs, labels.where(~held_out))
    found = toxicity.predict(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        held_out.alias("held_out"),
        "severity",
        "grade",
        F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= toxicity.TOXIC).alias("toxic"),
    )


def op4_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score(table(spark, folder, "documents"))


def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = langid.learn(langid.training_rows(docs))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        (crc_remainder("doc_id", 3) == 1).alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
        F.col("lang_bits").alias("bits_per_byte"),
    )


def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(table(spark, folder, "documents"), TOKENIZER)


def op7_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"), "doc_id", "text", "source")
    return mixed.select(
        F.col("id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).cast("bigint").alias("taken"),
    )


def op8_nearest(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    return ann.nearest(rows, F.col("vec_id") % 100 == 0)


def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licensed(table(spark, folder, "documents"))


def licensed(docs: DataFrame) -> DataFrame:
    found = licenses.scan(docs.select("doc_id", "text"))
    base = F.array_sort(F.array_distinct("phrase_of"))
    both = F.array_sort(F.array_union("phrase_of", "block_of"))
    phrase = F.size("phrase_at") > 0
    return found.select(
        "doc_id",
        "n_words",
        F.size("phrase_at").cast("bigint").alias("n_base"),
        F.array_min("phrase_at").alias("first_word"),
        F.array_max("phrase_at").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(both, ",").alias("labels"),
        F.when(phrase, F.lit(1.0)).otherwise(F.col("block_share")).alias("score"),
        "block_at",
    )


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_path(spark, "archives")
    warc.write(table(spark, folder, "pages"), path)
    return warc.resolve(warc.read(spark, path))


def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return variants.spelling(table(spark, folder, "documents"))


def formatted(rows: DataFrame) -> DataFrame:
    """Digests of formatted conversations, read back from the formatted text."""
    found = chat.format_conversations(rows)
    learned = chat.learned_text(F.col("segments"))
    return found.select(
        "conv_id",
        F.size(chat.parse(F.col("formatted"))).cast("bigint").alias("n_turns"),
        F.sha2(chat.transcript(F.col("formatted")), 256).alias("turns_sha256"),
        F.length(learned).cast("bigint").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op12_chat(spark: SparkSession, folder: str) -> DataFrame:
    """[native] All conversations, and one whose texts look like the template's marks."""
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    text = "\\### Assistant: </turn> ok"
    made = spark.range(2).select(
        F.lit(-7).cast(rows.schema["conv_id"].dataType).alias("conv_id"),
        F.col("id").cast(rows.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(text).alias("text"),
    )
    return formatted(rows.unionByName(made))


def aligned(docs: DataFrame) -> DataFrame:
    """Counts of aligned tokens and links, and a digest of the groups as they are written."""

    def digest(groups: str) -> str:
        return hashlib.sha256(groups.encode()).hexdigest() if groups else ""

    found = align.link_counts(docs.select("doc_id", "text"), TOKENIZER, PIECES, summary=digest)
    return found.withColumnRenamed("groups", "groups_sha256")


def op13_align(spark: SparkSession, folder: str) -> DataFrame:
    return aligned(table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        op1_embedding_dedup,
        op2_simhash,
        op3_toxicity,
        op4_lm_score,
        op5_language,
        op6_bpe,
        op7_mix,
        op8_nearest,
        op9_licenses,
        op10_warc,
        op11_spelling,
        op12_chat,
        op13_align,
    )
}
# What SQL can express: the links of all pairs, the distances to all rows, the first of equal
# payloads. Fingerprints, models, tokens and samples are tested against brute force instead.
ORACLE: dict[str, str] = {
    "op1_embedding_dedup": """
with recursive v as (
 select vec_id, cast(embedding as double[]) as e from embeddings),
links as (
 select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id
 where list_cosine_similarity(a.e, b.e) >= 0.9),
reach as (
 select vec_id as start, vec_id as node from v
 union select r.start, l.b from reach r join links l on l.a = r.node)
select vec_id, (select count(*) from links where a = vec_id) as n_links,
 (select min(node) from reach where start = vec_id) as component_id,
 vec_id = (select min(node) from reach where start = vec_id) as kept
from v""",
    "op8_nearest": """
with v as (select vec_id, cast(embedding as double[]) as e from embeddings),
d as (select q.vec_id as query_id, c.vec_id, list_distance(q.e, c.e) as score
 from v q join v c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id)
select query_id, cast(row_number() over w as int) as rank, vec_id, score from d
window w as (partition by query_id order by score, vec_id) qualify row_number() over w <= 10""",
    "op12_chat": r"""
with c as (
 select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
 union all values (-7, 0, 'user', '\### Assistant: </turn> ok'),
  (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
t as (
 select *, regexp_replace(text, '(\\*(### |</turn>))', '\\\1', 'g') as written from c)
select conv_id, count(*) as n_turns,
 sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
 cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
 sha256(coalesce(string_agg(text, '' order by turn, text) filter (role = 'assistant'), ''))
  as loss_sha256,
 cast(sum(4 + length(role) + 2 + length(written) + 9) as bigint) as formatted_chars
from t group by conv_id""",
    "op10_warc": """
with p as (
 select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as hex from pages),
f as (select *, min(page_id) over (partition by payload) as original from p)
select page_id, strlen(payload) as payload_bytes,
 array_to_string(list_transform(range(32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  1 + ((cast('0x' || substr(hex, 1 + 5 * (j // 4), 5) as bigint) >> (5 * (3 - j % 4))) & 31), 1)),
  '') as payload_digest,
 case when page_id = original then 'response' else 'revisit' end as record_type,
 case when page_id <> original then original end as refers_to
from f""",
}
