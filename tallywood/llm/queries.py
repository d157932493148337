"""Registered queries of this subpackage: thin calls of the operators on the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywood.llm import language_spans, oracles, toxicity, wavelet_shards
from tallywood.llm.byte_shards import shard_by_bytes
from tallywood.llm.byte_bpe import digest_table
from tallywood.llm.common import fold, materialize, read_table
from tallywood.llm.decontamination import contaminated
from tallywood.llm.hadamard_clusters import cluster
from tallywood.llm.lm_difference import cross_entropy_difference
from tallywood.llm.partenum import similarity_components
from tallywood.llm.quartile_digest import edited_digests
from tallywood.llm.simhash_tiles import near_duplicates
from tallywood.llm.site_lines import drop_boilerplate, host_of, page_text
from tallywood.llm.whitening import whiten
from tallywood.session import apply_settings, fresh_dir


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return digest_table(docs, path, public_tokenizers.PATTERN)


def byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(read_table(spark, sf_dir, "documents"), 16).withColumns(
        {"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}
    )


def quartile_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_digests(read_table(spark, sf_dir, "documents"))


def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").withColumn("held_out", fold("doc_id", 4) == 2)
    model = language_spans.fit(docs.where(~F.col("held_out")))
    return language_spans.predict(docs, model, keep=("held_out",))


def wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "shards")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    wavelet_shards.write_shards(read_table(spark, sf_dir, "documents"), path, tokenizer, end_id=2)
    return wavelet_shards.documents(spark, path)


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").withColumn("held_out", fold("doc_id", 5) == 0)
    labels = read_table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)
    model = toxicity.fit(docs, labels)
    return toxicity.score(docs, model, keep=("doc_id", "held_out"))


def site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    pages = pages.select("page_id", host_of(F.col("url")).alias("host"), page_text(F.col("html")).alias("text"))
    return drop_boilerplate(materialize(pages), "host", "text")  # read twice, taken out of the HTML once


def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_components(read_table(spark, sf_dir, "documents"), width=3, percent=90)


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def lm_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Likeness to the documents of good quality rather than to all others."""
    good = read_table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    scored = cross_entropy_difference(read_table(spark, sf_dir, "documents"), good)
    losses = ("target_loss", "background_loss", "difference")
    return scored.select("doc_id", "n_tokens", *[F.round(c, 6).alias(c) for c in losses])


def simhash_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(apply_settings(spark), sf_dir, "documents"))


def whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_table(apply_settings(spark), sf_dir, "embeddings"))


def hadamard_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(read_table(apply_settings(spark), sf_dir, "embeddings"))


# Name: query and its SQL, or None where SQL cannot express it.
QUERIES = {
    "op1_spaced_seeds": (decontamination, oracles.DECONTAMINATION),
    "op2_wavelet_shards": (wavelet, None),
    "op3_toxicity_trees": (toxic, None),
    "op4_ngram_jaccard": (ngram_jaccard, oracles.NGRAM_JACCARD),
    "op5_byte_bpe_prefixes": (byte_bpe, None),
    "op6_byte_shards": (byte_shards, None),
    "op7_quartile_digest": (quartile_digest, None),
    "op8_site_lines": (site_lines, oracles.SITE_LINES),
    "op9_language_spans": (language, None),
    "op10_lm_difference": (lm_difference, oracles.LM_DIFFERENCE),
    "op11_simhash_tiles": (simhash_tiles, None),
    "op12_jacobi_davidson": (whitening, None),
    "op13_hadamard_clusters": (hadamard_clusters, oracles.HADAMARD_CLUSTERS),
}
