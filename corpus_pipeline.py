"""From raw documents to packed training sequences.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``. All but the last return the columns of ``documents``.

1. language: documents whose language cannot be told go; a missing ``lang`` is
   filled in, a label that another language contradicts surely is replaced.
2. near_duplicates: one document of each SimHash group stays.
3. repeats: passages of 35 and more words stay where they occur first.
4. mixture: documents are repeated so that sources reach their target weights;
   every document stays at least once.
5. packing: token sequences of at most 1024 ids.

Defined cases: an empty table stays empty through all stages; texts that are
null, empty or without a letter go in stage 1; null ids are ids of their own and
come last where documents are ordered; a null language is filled in; null
sources are one source; rows repeated as a whole stay once (stage 2); ties go to
the smaller id, then by hashes of text and row; texts may have any length; extra
columns come back unchanged until packing drops them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lapse.llm import langid, mixing, packing, simhash, substring
from lapse.operators.materialize import land
from lapse.sources.tables import read_table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.settle_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs, simhash.SHINGLE_WORDS, simhash.MAX_BITS)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("mixture", mixture),
    ("packing", pack),
]

# Fits, fingerprints and a tokenizer: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
