"""Cleaning of a document corpus in five stages, each one operator of ``shutterlake.llm``.

Every stage gets the documents that the stage before has kept, takes ``(spark, docs, sf_dir)``,
and returns the columns of ``documents``; the last returns the token ids instead. ``run``
writes each stage as Parquet to the shared folder and gives the next one what it reads back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shutterlake.llm import bpe, langid, mixing, simhash, toxicity
from shutterlake.llm.common import WRITTEN, discard, ensure_shared, remove, shared_path
from shutterlake.llm.queries import TOKENIZER


def _clash(name: str, added: tuple[str, ...]) -> bool:
    """Whether Spark takes a column for one that an operator adds; it does not look at case."""
    return name.lower() in {a.lower() for a in added}


def _apart(docs: DataFrame, added: tuple[str, ...]) -> DataFrame:
    """``docs`` with columns renamed that an operator would replace."""
    return docs.withColumnsRenamed({c: f"_own_{c}" for c in docs.columns if _clash(c, added)})


def _as_before(found: DataFrame, docs: DataFrame, added: tuple[str, ...]) -> DataFrame:
    """The columns of ``docs``, under their names."""
    return found.select(
        *[F.col(f"_own_{c}" if _clash(c, added) else c).alias(c) for c in docs.columns]
    )


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: no text, or no letter in it.

    A corpus from which no language can be learned loses the same documents and no others.
    """
    ensure_shared(spark)
    model = langid.learn(langid.training_rows(docs))
    if not model.languages:
        found = langid.lettered(_apart(docs, ("has_letter",)))
        return _as_before(found.where("has_letter"), docs, ("has_letter",))
    found = langid.predict(_apart(docs, langid.ADDED), model)
    known = found.where(F.col("lang_pred") != langid.UNDETERMINED)
    return _as_before(known, docs, langid.ADDED)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the ordinal model grades as toxic."""
    ensure_shared(spark)
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    found = toxicity.predict(_apart(docs, toxicity.ADDED), model)
    return _as_before(found.where(F.col("toxic_score") < toxicity.TOXIC), docs, toxicity.ADDED)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, the one with the smallest id.

    A document without an id stays only if no document of its group has one. Of repeated rows
    one stays.
    """
    ensure_shared(spark)
    keep = simhash.representatives(simhash.groups(docs, "doc_id", "text"))
    keep = keep.withColumnsRenamed({"id": "_id", "text_key": "_kept"})
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_kept"))
    rows = docs.withColumn("_key", F.xxhash64("text")).join(keep, same, "left_semi")
    return rows.dropDuplicates(["doc_id", "_key"]).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents so that sources come near their targets; a copy is a row of its own."""
    ensure_shared(spark)
    mixed = mixing.mix(docs, "doc_id", "text", "source")
    copies = mixed.where("copies > 0").select(
        F.col("id").alias("_id"),
        F.col("source").alias("_mixed_source"),
        F.col("key").alias("_mixed"),
        F.col("number").alias("_mixed_number"),
        F.col("copies").alias("_copies"),
    )
    # repeated rows are numbered alike on both sides
    alike = Window.partitionBy("doc_id", "source", "_key").orderBy(F.lit(0))
    rows = docs.withColumn("_key", mixing.row_key("doc_id", "text"))
    taken = rows.withColumn("_number", F.row_number().over(alike)).join(
        copies,
        F.col("doc_id").eqNullSafe(F.col("_id"))
        & F.col("source").eqNullSafe(F.col("_mixed_source"))
        & (F.col("_key") == F.col("_mixed"))
        & (F.col("_number") == F.col("_mixed_number")),
    )
    return taken.withColumn("_copy", F.explode(F.expr("sequence(1, _copies)"))).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text."""
    ensure_shared(spark)
    rows = bpe.round_trip(docs.select("doc_id", "source", "text"), TOKENIZER)
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return rows.select("doc_id", "source", "ids", F.size("ids").alias("n_tokens"), same.alias("exact"))


STAGES = [
    ("language", languages),
    ("toxicity", clean),
    ("simhash", distinct),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: The stages rest on models that SQL can not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage needed is removed once it is written, and so is the
    table of the stage before; the last stage's table stays for the result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        path, made = shared_path(spark, f"stage-{name}"), len(WRITTEN)
        stage(spark, docs, sf_dir).write.parquet(path)
        discard(spark, made)
        if before is not None:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
