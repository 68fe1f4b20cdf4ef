"""Corpus pipeline: filter, de-duplicate, decontaminate and pack ``documents``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
stage's documents. All stages but the last return the columns of ``documents``.

Quality judges row by row, by id, language and text. A row without an id passes the
filters it cannot be matched in: it is judged by quality like any other, keeps its
lines, is never a near copy and never a leak. Repeated rows of one id, language and text
share every verdict; an empty table gives no rows; a null or empty text stays, or goes, as
each operator states. Extra columns pass through the stages under any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import decontaminate, line_dedup, packing, quality, simhash
from marketlens.llm.common import keep, table, unused


def keep_good_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is above their language's threshold go."""
    judged = quality.judge(docs, table(spark, sf_dir, "labels"), with_digest=True)
    own, lang, sha = unused(docs, "_id", "_lang", "_sha")
    gone = judged.where("NOT keep").select(
        F.col("id").alias(own), F.col("lang").alias(lang), F.col("text_sha256").alias(sha)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(own)) & F.col("lang").eqNullSafe(F.col(lang)) & (quality.text_digest() == F.col(sha))
    return docs.join(gone, same, "left_anti")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of an earlier document go; ``n_chars`` follows the text."""
    return line_dedup.dedup_lines(docs, counts=None).withColumn("n_chars", F.char_length("text").cast("long"))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate class the document with the smallest id stays."""
    [own] = unused(docs, "_gone")
    copies = simhash.near_duplicates(docs).where("id > component").select(F.col("id").alias(own)).distinct()
    return docs.join(copies, F.col("doc_id") == F.col(own), "left_anti")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go; an item of a few words is no passage."""
    [own] = unused(docs, "_gone")
    found = decontaminate.leaks(docs, table(spark, sf_dir, "benchmark"), short_items=False).select(F.col("id").alias(own)).distinct()
    return docs.join(found, F.col("doc_id") == F.col(own), "left_anti")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece: its document, place in it, sequence and offset."""
    return packing.packing_digest(docs)


STAGES = [
    ("quality classifier", keep_good_text),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", keep_one_of_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("best-fit packing", pack_sequences),
]

# Models, fingerprints and tokenisers cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, on ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
