"""A corpus pipeline of five operators; each stage is written as Parquet and read again as the next one's documents.

Every stage takes any table with doc_id, text and source, and keeps its other columns, whatever their names. An empty
table gives an empty result. Very long texts are read whole, one at a time, in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import exact_dedup, line_quality, mixing, packing, simhash
from tidewell.llm._common import ready, spread, table
from tidewell.scratch import discard, settled

#: SQL can't express SimHash, weighted fair queueing or packing; tests compare run() with a brute-force version.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the quality rules go; boilerplate lines of the others go.

    Null and empty texts have no words, so they go. Null sources are one host. Repeated rows share a verdict.
    """
    ready(spark)
    return line_quality.clean(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts (white space apart) the one with the least doc_id stays; null doc_ids come last, and of
    rows that tie in doc_id and text one stays. Null counts as an empty text."""
    ready(spark)
    return exact_dedup.dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the least doc_id stays; null doc_ids come last, and of rows
    that tie one stays. Texts without a word have fingerprint zero and are linked like any other."""
    ready(spark)
    return simhash.dedup(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice. Null sources are a source, the last one; texts
    without a word count nothing and go with the stream they stand in. Repeated rows are taken as often as their group is."""
    ready(spark)
    return mixing.take(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens. Null counts as an empty text, which is one end id; documents with
    one doc_id stay documents of their own."""
    ready(spark)
    return packing.pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("quality rules", quality), ("exact dedup", exact), ("near dedup", near), ("mixing", mix), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order. What a stage has read, and what it needed meanwhile, is removed once its result is written."""
    docs = spread(table(spark, sf_dir, "documents"))
    for name, stage in STAGES:
        before, docs = docs, settled(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), name.replace(" ", "_"))
        discard(before)
    return docs
