"""From raw documents to packed training sequences, in five stages over whole tables.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and read again as the next stage's ``docs``.
All but the last return the columns of ``documents``; each stage's own cases (nulls, empty texts, repeated rows) are those of its operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import mixing, near_text, packing, repeats, toxicity
from tidemark.llm.common import settle
from tidemark.llm.queries import table, tokenizer_file


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return toxicity.remove_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked at a similarity of 0.8 over five-word shingles, the one with the smallest id stays."""
    return near_text.drop_near_text(docs, percent=80, width=5)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes or more that occur twice are cut out of the texts; ``n_chars`` follows."""
    return repeats.remove_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are sampled, or repeated up to three times, to their targets; a document taken twice is two rows."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048: one row for each piece with its place."""
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"), end_id=0, capacity=2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("repeated_passages", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Models, sketches and tokenizers cannot be said in SQL; tests/llm holds every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
