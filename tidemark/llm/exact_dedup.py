"""Exact duplicates: group by a 128-bit content hash, keep the smallest id, compare bytes inside groups.

Only DataFrame functions. Texts are equal when identical after each run of ASCII white space
became one space; a null text counts as empty. The byte comparison is the first aggregate: it
groups by hash *and* text, so two texts that share a hash stay apart. It combines within each
input task, so a text that a third of all rows share is shuffled once per task. What moves after
that has no texts. Should two different texts agree in MD5 and SHA-256 at once, the query fails.

A null id comes after every other id. Wholly repeated rows (same id, same text) all carry the same
verdict in ``duplicate_groups``; ``deduplicate`` returns one of them. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _hash(text: Column) -> Column:
    return F.unhex(F.md5(text))


def text_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per distinct text: content hash, SHA-256, smallest id, number of rows."""
    texts = docs.select(F.col(doc_id).alias("_id"), normalised(F.col(text)).alias("_text"))
    compared = texts.groupBy(_hash(F.col("_text")).alias("content_hash"), "_text").agg(
        F.min("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = compared.groupBy("content_hash", F.sha2(F.col("_text"), 256).alias("text_sha256")).agg(
        F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"), F.count(F.lit(1)).alias("_texts"))
    collided = F.raise_error(F.lit("different texts with equal MD5 and SHA-256")).cast("long")
    return groups.withColumn("group_size", F.when(F.col("_texts") > 1, collided).otherwise(F.col("group_size"))).drop("_texts")


def duplicate_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    words = normalised(F.col(text))
    rows = docs.select(F.col(doc_id).alias("doc_id"), _hash(words).alias("content_hash"), F.sha2(words, 256).alias("text_sha256"))
    return rows.join(text_groups(docs, doc_id, text), ["content_hash", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    keep = text_groups(docs, doc_id, text).select("content_hash", "keep_id")
    rows = docs.select(_hash(normalised(F.col(text))).alias("hash"), F.col(doc_id).alias("id"), F.struct(*docs.columns).alias("row"))
    left = rows.join(keep, (F.col("hash") == F.col("content_hash")) & F.col("id").eqNullSafe(F.col("keep_id")), "left_semi")
    first = Window.partitionBy("hash", "id").orderBy(F.lit(0))
    return left.withColumn("n", F.row_number().over(first)).where("n = 1").select("row.*")
