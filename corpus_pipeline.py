"""A corpus pipeline of training-data operators: each stage takes and returns the documents that are left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulselake.llm import line_dedup, minhash, packing, suffix_dedup, toxicity
from pulselake.llm.runtime import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows with a toxicity score below 0.5; the model is learned from the labelled documents of ``sf_dir``.

    A null or empty text is clean; repeated rows are scored alike; without labels of both kinds all rows stay; an
    empty table gives no rows; other columns pass through, whatever their names.
    """
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, without the lines that repeat, or nearly repeat, an earlier line (by doc_id, nulls last, then line number).

    Null texts stay null, a text of which all lines go is empty; rows that share a doc_id count as one document; an empty table
    gives no rows; other columns pass through, whatever their names.
    """
    return with_length(line_dedup.without_repeated_lines(docs))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (shingles of five words, similarity 0.8), the one with the smallest doc_id.

    Texts without words (null too) stay; rows that agree in doc_id and text share one decision, rows that share a doc_id alone have their
    own; a row without doc_id goes if its group has one with; an empty table gives no rows; other
    columns pass through, whatever their names.
    """
    return minhash.without_near_duplicates(docs, width=5, percent=80)


def dedup_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, without the byte strings that repeat elsewhere; characters that a cut splits go with it.

    Null texts stay null; repeated rows are texts of their own, so both lose what they share; an empty table gives
    no rows; other columns pass through, whatever their names.
    """
    return with_length(suffix_dedup.without_repeats(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents that are left.

    A null or empty text is its end id alone; null ids and sources and repeated rows are packed like any other; an
    empty table gives no rows; other columns are not read.
    """
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


def with_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


STAGES = [("toxicity", drop_toxic), ("line_dedup", dedup_lines), ("minhash_near_dedup", dedup_documents), ("suffix_array_dedup", dedup_passages), ("packing", pack)]

#: The learned and the packing stages have no SQL form; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
