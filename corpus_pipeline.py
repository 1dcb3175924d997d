"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.common import small_batches, stored
from headway.llm.exact_copies import without_copies
from headway.llm.language import fit, predicted
from headway.llm.mixing import mixed
from headway.llm.near_copies import near_copies
from headway.llm.packing import pack
from headway.llm.queries import held_out, table, word_vocabulary


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with confidence; texts without a letter go."""
    small_batches(spark)
    model = fit(docs.where(~F.coalesce(held_out(), F.lit(False))))
    found = docs.select(F.struct(*docs.columns).alias("doc"), predicted(F.col("text"), model).alias("found"))
    return found.where((F.col("found.lang") != "und") & ~F.col("found.rejected")).select("doc.*")


def one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return without_copies(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near copies (five words, similarity 0.8); of several
    texts with that id, or without any, one."""
    names = docs.columns
    found = near_copies(docs.select(F.struct(*names).alias("doc"), "doc_id", "text"), width=5, percent=80)
    return found.where("first").select("doc.*")


def weighted_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of its source takes it."""
    return mixed(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in sequences of 2,048 tokens."""
    made = pack(docs, word_vocabulary(), end_id=1)
    return made.select("doc_id", "start", "length", "doc_tokens", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset", "ids")


STAGES = [
    ("language", known_language),
    ("exact_copies", one_of_copies),
    ("near_copies", one_of_near_copies),
    ("mix", weighted_sources),
    ("pack", packed_sequences),
]

# The tokens and the learned languages have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
