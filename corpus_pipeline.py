"""The corpus pipeline: quality classifier, exact dedup, near-duplicate join, mixing, packing.

Each stage takes the documents that its predecessor kept and returns documents, but
for the last, which returns the packed pieces. A caller may write each stage's
result and read it again; run() does so in the session's shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexflume.llm._common import columns_of, documents, frozen, shielded
from lexflume.llm.exact_dedup import drop_exact_copies
from lexflume.llm.jaccard_join import drop_similar
from lexflume.llm.mixing import mix
from lexflume.llm.packing import pack
from lexflume.llm.quality_classifier import quality_classifier
from lexflume.llm.queries import vocabulary
from lexflume.session import ship


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fits the classifier on docs and keeps what it doesn't reject.

    Null and empty texts, and texts too short for votes, are scored like any other.
    Rows that repeat, and rows with null keys, are each judged by their text. A very
    long text is split into words by itself. Columns named like the classifier's
    results come back as they were. An empty table gives no rows.
    """
    ship(spark)
    plain, back = shielded(docs, ("posterior", "score", "kept"))
    return quality_classifier(plain).where("kept").select(back)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal without white space: the longest, then the smallest id.

    Null and empty texts are one group. Of rows that repeat whole one stays; a null id
    comes last. All columns come back whatever their names. An empty table gives no rows.
    """
    return drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group linked by shingle sets of similarity 0.75 and more.

    Rows without words or with a null id link with nothing and stay, as do rows that
    share the smallest id. All columns come back whatever their names. An empty table
    gives no rows.
    """
    ship(spark)
    return drop_similar(docs).select(columns_of(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate draws, in random order.

    Null sources are one source; rows that share an id (null too) draw alike; texts
    don't matter. Columns named like the mixture's results come back as they were. An
    empty table gives no rows.
    """
    plain, back = shielded(docs, ("copy", "shuffle_key"))
    return mix(plain).select(back)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens in sequences: doc_id, source and the place of each piece.

    One document may come several times, and each time is packed on its own, null ids
    too. A null or empty text is one token, a long one several pieces. Other columns
    aren't carried. An empty table gives no rows.
    """
    ship(spark)
    return pack(docs.select("doc_id", "text", "source"), vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", reject_low_quality),
    ("exact dedup", drop_copies),
    ("n-gram jaccard join", drop_near_copies),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: SQL can express neither the fitted classifier nor the packing; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = frozen(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
