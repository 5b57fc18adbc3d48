"""The corpus pipeline: every stage reads what its predecessor wrote.

documents -> toxic documents out -> one document of each near-duplicate group
-> later copies of long byte strings out -> sources mixed to target weights
-> byte-pair ids.  Each stage works on all rows that it is given and, but for
the last, returns the columns of ``documents``.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import bpe, mixing, simhash, suffixes, toxicity
from carelake.llm.common import prepare, table

VOCABULARY = "byte_bpe_50k.tiktoken"


def screen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the toxicity classifier does not reject."""
    prepare(spark)
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by SimHash."""
    prepare(spark)
    return simhash.keep_one(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without later copies of strings of 200 bytes or more."""
    prepare(spark)
    return suffixes.dedup(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, each as often as the mix of sources takes it."""
    prepare(spark)
    return mixing.mix_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_tokens and the digests of ids and decoded text."""
    prepare(spark)
    rows = docs.select("doc_id", "lang", "source", "text")
    return bpe.round_trip(rows, public_tokenizers.path(VOCABULARY)).drop("decoded")


STAGES = [("toxicity", screen), ("simhash", near_duplicates), ("suffix_array", substrings),
          ("mixing", mix), ("byte_bpe", tokenize)]

#: Learned scores, XXH64 fingerprints and byte-pair ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage.  Between stages the rows are written to the
    shared checkpoint folder and read again, as a driver of STAGES does."""
    from uuid import uuid4

    from carelake.plans.session import ensure_checkpoint_dir
    docs, root = table(spark, sf_dir, "documents"), f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid4().hex}"
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs.write.parquet(f"{root}/{name}")
            docs = spark.read.parquet(f"{root}/{name}")
    return docs
