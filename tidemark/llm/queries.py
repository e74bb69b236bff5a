"""The registered queries: each applies its operator, with production parameters, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    byte_pairs,
    centroids,
    exact_dedup,
    hard_negatives,
    jaccard_join,
    language_id,
    mixing,
    neighbours,
    packing,
    private_data,
    sharding,
    substring_dedup,
    url_filter,
)
from tidemark.llm.answers import RULES
from tidemark.llm.scratch import parquet

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def register(f):
        QUERIES[name] = f
        return f
    return register


@query("op1_url_filter")
def _(spark, sf_dir):
    pages, labels = parquet(spark, sf_dir, "pages"), parquet(spark, sf_dir, "labels")
    # A page shows the document whose id is in its path, and has that document's label.
    shown = pages.select("page_id", F.try_to_number(
        F.nullif(F.regexp_extract("url", r"://[^/?#]*/[a-z]+/([0-9]{1,15})", 1), F.lit("")), F.lit("999999999999999")).cast("long").alias("doc_id"))
    outcomes = shown.join(labels.where("quality is not null"), "doc_id").select("page_id", F.col("quality").alias("good"))
    return url_filter.judge_urls(pages, outcomes, RULES).select("page_id", "host", "path", "rule", "verdict", "labelled", "good")


@query("op2_mixing")
def _(spark, sf_dir):
    return mixing.mix_sources(parquet(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op5_sharding")
def _(spark, sf_dir):
    placed = sharding.shard_documents(parquet(spark, sf_dir, "documents"), 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query("op6_exact_dedup")
def _(spark, sf_dir):
    return exact_dedup.duplicate_groups(parquet(spark, sf_dir, "documents"))


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op8_language_id")
def _(spark, sf_dir):
    docs = parquet(spark, sf_dir, "documents")
    model = language_id.fit_documents(docs, tokenizer_file("piece_bpe_32k.model"))
    return language_id.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op10_packing")
def _(spark, sf_dir):
    return packing.pack_documents(parquet(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


@query("op9_substring_dedup")
def _(spark, sf_dir):
    return substring_dedup.later_windows(parquet(spark, sf_dir, "documents"), 13).drop("kept_text")


@query("op3_private_data")
def _(spark, sf_dir):
    docs = parquet(spark, sf_dir, "documents")
    return private_data.private_spans(docs, private_data.fit(docs)).drop("redacted")


@query("op4_nearest_neighbours")
def _(spark, sf_dir):
    vectors = parquet(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    asked = vectors.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    return neighbours.Index(vectors).search(asked, 20)


@query("op7_jaccard_join")
def _(spark, sf_dir):
    return jaccard_join.near_duplicates(parquet(spark, sf_dir, "documents"))


@query("op11_byte_pairs")
def _(spark, sf_dir):
    docs = parquet(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_pairs.digests(byte_pairs.encode(docs, tokenizer_file("byte_bpe_50k.json"), decoded="decoded"))


@query("op12_hard_negatives")
def _(spark, sf_dir):
    vectors, every = parquet(spark, sf_dir, "embeddings"), F.col("vec_id")
    label = F.when(every % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.Miner(vectors, every % 100 == 0, label).mine()


@query("op13_centroids")
def _(spark, sf_dir):
    rows, c = centroids.cluster(parquet(spark, sf_dir, "embeddings"))
    return rows.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", centroids.digest(c).alias("centroid_sha256"))
