"""A training corpus from raw documents: five stages, each of which works on all that the one before has kept.

All stages but the last return the columns of their input, whatever those are called. Null texts count as empty; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluice.llm import exact, mixing, simhash, subword, toxicity
from sluice.llm.common import Workspace, bucket_of, fresh, table, text_of


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon learned from ``labels`` (less a fifth of the ids) scores at 0.5 or more go.

    A null or empty text has no match and stays; repeated rows stay or go together. Without labels of both kinds there is no lexicon, and nothing goes
    unless all labelled documents are toxic.
    """
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels"), bucket_of("doc_id", 5) != 0)
    return toxicity.drop_toxic(docs, lexicon)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (null being empty), the row with the largest doc_id stays, null ids being smaller than all others.

    Of rows that are repeated with that id one stays: that with the least hash of all its columns.
    """
    ws = Workspace(spark, "stage7")
    key, doc, sha, nth = fresh(docs, "key", "kept_id", "kept_sha", "nth")
    kept = exact.exact_dedup(docs, ws).where("kept").groupBy(F.col("doc_id").alias(doc), F.col("text_sha256").alias(sha)).agg(F.count("*").alias(nth))
    kept = ws.save(kept, "kept")
    left = docs.withColumn(key, F.sha2(text_of(), 256))
    left = left.join(kept, (F.col(key) == F.col(sha)) & F.col("doc_id").cast("long").eqNullSafe(F.col(doc)), "left_semi")
    if kept.where(F.col(nth) > 1).head(1):
        order = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in docs.columns])
        left = left.withColumn(nth, F.row_number().over(W.partitionBy("doc_id", key).orderBy(order))).where(F.col(nth) == 1).drop(nth)
    return left.drop(key)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints are linked, directly or through others, the one with the smallest doc_id stays; null ids come after all others.

    Rows are told apart by id and text, so unlike texts under one id are unlike documents. Empty and null texts are linked with each other.
    """
    ws = Workspace(spark, "stage8")
    key, kept = fresh(docs, "row_key", "kept_row")
    row = F.xxhash64("doc_id", text_of())
    ids = docs.select(row.alias("doc_id"), F.col("doc_id").cast("long").alias("id"), "text")
    parts = simhash.simhash_dedup(ids, ws).select(F.col("doc_id").alias("row"), F.col("component_id").alias("part"))
    least = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "row")).alias("least")
    first = ids.select(F.col("doc_id").alias("row"), "id").join(parts, "row").groupBy("part").agg(least).select(F.col("least.row").alias(kept))
    first = ws.save(first, "first")
    return docs.withColumn(key, row).join(first, F.col(key) == F.col(kept), "left_semi").drop(key)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes its words, rounded: none, one or two rows. Texts without words take none."""
    ws = Workspace(spark, "stage2")
    row, times, time = fresh(docs, "row_key", "times", "time")
    key = F.xxhash64("doc_id", "text")
    taken = mixing.mix(docs.select(key.alias("doc_id"), "source", "text"), ws)
    rounded = F.round(F.col("taken") / F.col("size")).cast("int")
    found = taken.where("size > 0").select(F.col("doc_id").alias(row), rounded.alias(times)).where(F.col(times) > 0).groupBy(row).agg(F.max(times).alias(times))
    again = docs.withColumn(row, key).join(ws.save(found, "times"), row)
    return again.withColumn(time, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*[F.col(f"`{c}`") for c in docs.columns])


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_ids, ids_sha256, round_trip, ids of every row, repeated ones too; an empty text has no ids."""
    return subword.encode(docs)


STAGES = [("toxicity", drop_toxic), ("exact dedup", exact_dedup), ("simhash near-dedup", near_dedup), ("mixing", mix_sources), ("sentencepiece", tokenize)]

#: SQL has neither the learned lexicon, nor SimHash's XXH64, nor the vocabulary's segmentation; the tests hold the stages against plain ones.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again: the rows of ``tokenize``.

    Null and empty texts, ties, repeated rows and extra columns are treated as each stage says; an empty table gives no rows. A folder is dropped as
    soon as the stage after it is written; that of the last stage stays, as the returned DataFrame reads it.
    """
    ws = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = ws.save(stage(spark, docs, sf_dir), f"stage{k}", "zstd")
        if k:
            ws.drop(f"stage{k - 1}")
    return docs
