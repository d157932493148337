"""Corpus cleaning in stages: documents in, digests of the encoded documents that stay out.

Every stage works on the whole of what the one before it has kept, which it finds written as
Parquet; all but the last return the columns of ``documents``. A stage that starts again after a
failure reads the same rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywood.llm import language_spans
from tallywood.llm.byte_bpe import digest_table
from tallywood.llm.common import materialize, read_table, without
from tallywood.llm.decontamination import contaminated
from tallywood.llm.partenum import similarity_components
from tallywood.llm.site_lines import drop_boilerplate

# Near copies: the words of a shingle, and the least similarity of their sets in percent.
WIDTH, PERCENT = 5, 80
# A line goes from more than this share of the documents of its source on, three at least, a group
# of copies counted as one. This is the parameter of the stage to set for a corpus: a line that
# stands on one of 500 otherwise unrelated documents is not a document's own.
LINE_RATIO = 0.002
# A document goes if the language found for it explains less of its letters than this.
LEAST_SCORE = 0.3
# Items of the benchmark with fewer words are no passages: documents hold these by chance.
LEAST_ITEM = 4


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language: those without letters and those that fit none go.

    The languages are learned from the rows that have one; a missing language is filled in.
    """
    columns, names = docs.columns, ("__lang", "__score", "__spans")
    model = language_spans.fit(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language_spans.predict(docs, model, keep=tuple(columns), names=names)
    kept = found.where((F.col("__lang") != language_spans.UNDETERMINED) & (F.col("__score") >= LEAST_SCORE))
    return kept.withColumn("lang", F.coalesce("lang", "__lang")).select(*columns)


def grouped(pages: DataFrame) -> DataFrame:
    """Pages with ``__group``, the same for exact and near copies."""
    pages = pages.withColumn("__key", F.xxhash64("text"))
    found = similarity_components(pages, width=WIDTH, percent=PERCENT, id_column="__key")
    groups = found.groupBy("__key").agg(F.min("component_id").alias("__group"))
    return pages.drop("text").join(groups, "__key")


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many documents of their source have.

    A group of exact and near copies counts as one document, so the lines of a text do not become
    boilerplate because the text was copied; what is boilerplate goes from all members alike. A
    document that consists of such lines stays whole.
    """
    cleaned = drop_boilerplate(docs, "source", "text", LINE_RATIO, keep_whole=True, grouped=grouped)
    changed = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def rows_of(docs: DataFrame) -> DataFrame:
    """The documents with ``__row``, a key of id and text: one for rows that are equal in both."""
    return docs.withColumn("__row", F.xxhash64("doc_id", "text"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, that of the least id; rows without an id come last.

    Two texts are near copies if their sets of five-word shingles have a Jaccard similarity of
    0.8 or more. A row goes for its own text only, whatever other texts its id has. Texts without
    words stay, but of equal rows with an id one stays.
    """
    rows = rows_of(docs)
    found = similarity_components(rows, width=WIDTH, percent=PERCENT, id_column="__row")
    found = found.groupBy("__row").agg(F.min("component_id").alias("component"), F.max("n_shingles").alias("size"), F.count("*").alias("n"))
    found = found.join(rows.select("__row", "doc_id").distinct(), "__row")
    found = materialize(found.withColumn("place", F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "__row")))
    first = found.groupBy("component").agg(F.min("place").alias("first"))
    copies = found.join(first, "component").where("place.__row <> first.__row")
    kept = without(rows, copies, "__row")
    repeated = materialize(found.where("n > 1 AND (size > 0 OR doc_id IS NOT NULL)").select("__row"))
    again = kept.join(repeated, "__row", "left_semi").dropDuplicates(["__row"])
    return without(kept, repeated, "__row").unionByName(again).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark; a row goes for its own text only.

    Items of fewer than ``LEAST_ITEM`` words are left out.
    """
    rows = rows_of(docs)
    found = contaminated(rows, read_table(spark, sf_dir, "benchmark"), "__row", least_item=LEAST_ITEM)
    return without(rows, found, "__row").select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and hashes of the encoded and of the decoded text of every document."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return digest_table(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("language ID", known_language),
    ("line dedup", without_boilerplate),
    ("n-gram Jaccard join", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("byte-level BPE", encoded),
]

# The first and the last stage have no SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
