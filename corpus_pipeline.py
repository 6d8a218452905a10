"""A cleaning pipeline over the documents table: quality rules, exact dedup, SimHash near-dedup, suffix-array dedup, packing.

Each stage works on all that the one before kept, takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again. All but the last return the columns of documents and any others that the table has; the last gives the packed
pieces with their ids. Null texts are empty, null ids and sources stay null, repeated rows are copies; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docframe.llm import bpe
from docframe.llm.common import documents, materialize
from docframe.llm.exact_dedup import exact_dedup, keep_first
from docframe.llm.packing import pack
from docframe.llm.quality import apply_quality, quality
from docframe.llm.simhash import keep_one, simhash_components
from docframe.llm.suffix_dedup import remove_repeated


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines above their host's limit go from the others."""
    return apply_quality(docs, quality(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays; rows without an id are the smallest, null texts are empty ones."""
    return keep_first(docs, exact_dedup(docs, keep="largest"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays."""
    return keep_one(docs, simhash_components(docs))


def suffixes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of strings that repeat go, at every place; n_chars follows the text."""
    return remove_repeated(docs).withColumn("n_chars", F.length("text").cast("long"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed token sequences, with their ids."""
    return pack(docs, bpe.vocabulary_path(), with_ids=True)


STAGES = [("quality", quality_rules), ("exact_dedup", exact), ("simhash", near), ("suffix_dedup", suffixes), ("packing", packing)]

#: Components, suffixes and tokens are beyond SQL: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, in order, over documents."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
