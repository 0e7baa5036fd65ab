"""From documents to training sequences: the stages of the corpus pipeline.

Each stage works on every document that the one before it kept, and returns the
documents' own columns; the last returns the packed pieces.  A stage's result is
written before the next stage is called: what a stage has written on its way is
removed when the next one starts.

In all stages an empty table gives an empty one, columns of any name are carried, and
rows that repeat are rows of their own unless a stage removes copies.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.llm import line_dedup, near_dups, packing, quality, suffixes
from seriesmill.llm.queries import WORD_JSON, table
from seriesmill.session import noted, remove, ship_package, work_path

# Intermediate tables of the stage before.
_left: list[str] = []


def _stage(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A stage that first removes what the stage before it has left, and notes what it leaves itself."""

    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        while _left:
            remove(spark, _left.pop())
        with noted(_left):
            return function(spark, docs, sf_dir)

    return run


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie in the perplexity band of their language.

    Null and empty texts fail the base rules; a null language is one of its own; equal
    texts of a language share their fate; texts are scored whole, however long.
    """
    return quality.kept_documents(docs)


@_stage
def deduped_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier line matches.

    Earlier is by ``doc_id``, null first, then by a hash of the text and by line; rows of
    equal id and text count as one document.  A null text stays null, and a document
    that loses all its lines stays with an empty text.
    """
    kept = line_dedup.dedup_lines(docs)
    return kept.select(*(kept[c] if c == "text" else F.col("row")[c].alias(c) for c in docs.columns))


@_stage
def near_deduped(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the least ``doc_id``.

    Equal texts are one group, null and empty ones together; texts without words are
    alike only if equal.
    """
    return near_dups.one_of_each(docs)


@_stage
def passages_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without bytes that a repeated 400-byte string covers.

    All occurrences go, the first one too; a null text is empty and shorter texts keep
    all.  Bytes that are no whole character after a cut are left out.
    """
    return suffixes.dedup_passages(docs)


@_stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 4096 tokens.

    A null or empty text is its end token alone; a longer document is cut into pieces.
    """
    return packing.pack_documents(docs, WORD_JSON)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", deduped_lines),
    ("near dedup", near_deduped),
    ("suffix-array dedup", passages_removed),
    ("packing", packed),
]

#: No stage but the line cut can be said in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, f"stage-{name.replace(' ', '-')}")
        stage(spark, rows, sf_dir).write.parquet(path)
        rows = spark.read.parquet(path)
    return rows
